"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a text are rates: words of a learned lexicon in two strengths, the strongest such word, lexicon words
near a second person, capitals, punctuation, obfuscated words, and lexicon words that show only after obfuscation is
undone. The lexicon holds hashes of words and of their first bytes (forms of one stem), with the log odds of a toxic
document given the word.

The classifier is fitted on a bounded sample of labelled rows, ``MOST_LABELLED`` (a documented parameter), drawn by hash
and split in three by hash: one part gives the trees, one the calibration. The third and all labelled rows outside the
sample give the lexicon. Every text is scored whole.

Null and empty texts have all rates 0 and get the score of such a text. Null labels are not learned from; of several
labels for one id the largest counts. Without labels of both kinds every text gets the share of toxic labels, or 0, and
``drop_toxic`` drops nothing.

Up to MOST_BROADCAST labels are sent to the documents, which stay where they are read; more are joined by a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.shared import on_own_columns, written
from tickbars.llm.words import Words, ranges, slices, words_of

MOST_LABELLED = 20_000
LEXICON_SIZE = 4_000
MOST_BROADCAST = 1 << 20
LEAST_DOCUMENTS = 4
MEDIUM, STRONG = 1.5, 3.5
NEAR = 5
TREES, DEPTH = 20, 4
STEMS = (4, 5, 6)
THRESHOLD = 0.3
FEATURES = (
    "strong medium strongest odds near_person revealed obfuscated capitals shouted punctuation exclaimed log_words"
).split()

#: Words of the second person in four languages.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros vuestro"
).split()
#: Characters that stand for letters.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

_ALL = np.arange(256)
_LETTER = (_ALL >= 0x80) | ((_ALL >= 65) & (_ALL <= 90)) | ((_ALL >= 97) & (_ALL <= 122))
_UPPER = (_ALL >= 65) & (_ALL <= 90)
_DIGIT = (_ALL >= 48) & (_ALL <= 57)
_SPACE = (_ALL <= 0x20)
_PUNCTUATION = ~(_LETTER | _DIGIT | _SPACE)
#: Bytes of a word: letters, digits, and marks that stand for letters inside one.
_IN_WORD = _LETTER | _DIGIT | np.isin(_ALL, np.frombuffer(b"@$*|'", np.uint8))
_PLAIN = _ALL.astype(np.uint8)
_PLAIN[_UPPER] += 32
_REVEALED = _PLAIN.copy()
for _from, _to in LOOK_ALIKES.items():
    _REVEALED[ord(_from)] = ord(_to)


@dataclass
class Lexicon:
    """Ordered hashes of words and stems with their log odds."""

    hashes: np.ndarray
    odds: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes))
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, self.odds[at], 0.0)


def _units(words: Words, data: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words and of their stems; a stem of the whole word is the word."""
    units = [words.hashes_of(data)]
    for n in STEMS:
        stem = Words(data, words.offsets, words.starts, np.minimum(words.ends, words.starts + n), words.first)
        units.append(stem.hashes_of(data) ^ np.uint64(n))
    return units


_SECOND = np.sort(words_of(pa.array([" ".join(SECOND_PERSON)]), _IN_WORD).hashes_of(
    np.frombuffer(" ".join(SECOND_PERSON).encode(), np.uint8)))


def _split(column: pa.Array) -> Words:
    return words_of(column, _IN_WORD)


def counts_by_label(docs: DataFrame) -> DataFrame:
    """Rows (unit, toxic documents, other documents) of a frame (text, toxic)."""

    def counted(batches):
        for batch in batches:
            for part in slices(batch):
                words = _split(part.column("text"))
                toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
                text = np.tile(words.text, 1 + len(STEMS))
                unit, at = np.unique(np.concatenate(_units(words, _PLAIN[words.data])), return_inverse=True)
                # Each unit once per text: both as one number, in order of the texts.
                pair = np.unique(text * np.int64(len(unit)) + at)
                text, at = pair // max(len(unit), 1), pair % max(len(unit), 1)
                bad = np.bincount(at, weights=toxic[text], minlength=len(unit)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(unit.view(np.int64)),
                        pa.array(bad),
                        pa.array(np.bincount(at, minlength=len(unit)) - bad),
                    ],
                    ["unit", "bad", "good"],
                )

    counts = docs.select("text", "toxic").mapInArrow(counted, "unit long, bad long, good long")
    return counts.groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learned_lexicon(docs: DataFrame) -> Lexicon:
    totals = docs.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = totals.bad or 0, totals.good or 0
    odds = F.log((F.col("bad") + 0.5) / (bad - F.col("bad") + 0.5)) - F.log(
        (F.col("good") + 0.5) / (good - F.col("good") + 0.5)
    )
    rows = (
        counts_by_label(docs)
        .where(F.col("bad") >= LEAST_DOCUMENTS)
        .select("unit", odds.alias("odds"))
        .where(F.col("odds") > MEDIUM)
        .orderBy(F.desc("odds"), "unit")
        .limit(LEXICON_SIZE)
        .toPandas()
    )
    hashes = rows["unit"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], rows["odds"].to_numpy(dtype=float)[order])


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of FEATURES per text."""
    words = _split(column)
    plain, revealed = _PLAIN[words.data], _REVEALED[words.data]
    bytes_before = lambda what: np.concatenate(([0], np.cumsum(what[words.data])))
    in_words = {name: bytes_before(what) for name, what in (("digit", _DIGIT | _PUNCTUATION), ("upper", _UPPER))}
    per_word = {name: total[words.ends] - total[words.starts] for name, total in in_words.items()}
    length = words.ends - words.starts
    odds = np.maximum.reduce([lexicon.of(x) for x in _units(words, plain)])
    # Letters replaced inside a word: some but not all of its bytes are digits or marks.
    disguised = (per_word["digit"] > 0) & (per_word["digit"] < length)
    after = odds.copy()
    at = np.flatnonzero(disguised)
    if len(at):
        some = Words(words.data, words.offsets, words.starts[at], words.ends[at], words.first)
        after[at] = np.maximum.reduce([lexicon.of(x) for x in _units(some, revealed)])
    person = np.flatnonzero(np.isin(words.hashes_of(plain), _SECOND))
    near = np.zeros(len(length) + 1, np.int64)
    np.add.at(near, np.maximum(person - NEAR, words.first[words.text[person]]), 1)
    np.add.at(near, np.minimum(person + NEAR + 1, words.last[person]), -1)
    near = np.cumsum(near)[:-1] > 0
    best = np.maximum(odds, after)
    shouted = (per_word["upper"] == length) & (length > 2)
    n = np.maximum(words.counts, 1)
    total = lambda what: words.per_text(what) / n
    text_bytes = np.maximum(np.diff(words.offsets), 1)

    def rate(what: np.ndarray) -> np.ndarray:
        before = bytes_before(what)
        return (before[words.offsets[1:]] - before[words.offsets[:-1]]) / text_bytes

    strongest = np.zeros(len(column))
    has = np.flatnonzero(words.counts)
    if len(has):
        strongest[has] = np.maximum.reduceat(best, words.first[has])
    hits = best >= STRONG
    return np.stack(
        [
            total(hits),
            total((best >= MEDIUM) & ~hits),
            strongest,
            np.log1p(words.per_text(np.where(hits, best, 0.0))),
            total(hits & near),
            total((after >= STRONG) & (odds < STRONG)),
            total(disguised),
            rate(_UPPER),
            total(shouted),
            rate(_PUNCTUATION),
            rate(_ALL == 33),
            np.log1p(words.counts),
        ],
        axis=1,
    )


def with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "features") -> DataFrame:
    known = docs.sparkSession.sparkContext.broadcast(lexicon)

    def added(batches):
        for batch in batches:
            for part in slices(batch, text):
                found = features(part.column(text), known.value)
                offsets = np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(added, schema)


@dataclass
class Model:
    lexicon: Lexicon
    share: float
    trees: object = None
    #: Step points of the calibration: raw probabilities and what they stand for.
    raw: list[float] = field(default_factory=list)
    calibrated: list[float] = field(default_factory=list)


def fit(labelled: DataFrame) -> Model:
    """Learn from a frame (id, text, toxic). The trees and their calibration take six tenths of about MOST_LABELLED of its
    rows, drawn by a hash of the id; the lexicon takes all other rows."""
    n = labelled.count()
    draw = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(1 << 30))
    drawn = F.coalesce(draw < int((1 << 30) * min(1.0, MOST_LABELLED / max(n, 1))), F.lit(False))
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10))
    toxic = F.col("toxic").cast("int").alias("toxic")
    sample = written(labelled.where(drawn).select("text", toxic, part.alias("part")), "labelled")
    share = sample.agg(F.avg("toxic").alias("share")).first().share or 0.0
    lexicon = learned_lexicon(
        sample.where("part < 4").select("text", "toxic").unionByName(labelled.where(~drawn).select("text", toxic))
    )
    rest = written(
        with_features(sample.where("part >= 4").select("part", "text", "toxic"), lexicon).select(
            "part", F.col("toxic").cast("double").alias("label"), "features"
        ),
        "features",
    ).withColumn("features", array_to_vector("features"))
    trees_part, last_part = rest.where("part < 8"), rest.where("part >= 8")
    if any(part.select("label").distinct().count() < 2 for part in (trees_part, last_part)):
        return Model(lexicon, share)
    # The sample is bounded; one partition spares every round of boosting a shuffle.
    kept = trees_part.coalesce(1).persist()
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(kept)
    kept.unpersist()
    raw = trees.transform(last_part).select("label", _raw().alias("features"))
    steps = IsotonicRegression().fit(raw)
    return Model(lexicon, share, trees, list(steps.boundaries), list(steps.predictions))


def _raw() -> Column:
    return vector_to_array("probability")[1]


def _calibrated(raw: Column, model: Model) -> Column:
    """Linear between the step points, as isotonic regression predicts. One flat list of cases, however many points."""
    value = F.when(raw <= model.raw[0], F.lit(model.calibrated[0]))
    points = list(zip(model.raw, model.calibrated, strict=True))
    for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False):
        value = value.when(raw < x1, F.lit(y0) if x1 == x0 else y0 + (raw - x0) * ((y1 - y0) / (x1 - x0)))
    return value.otherwise(F.lit(model.calibrated[-1]))


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """The rows with a score from 0 to 1, which replaces a column of its name."""
    return on_own_columns(docs, [text], [name], lambda rows: _scored(rows, model, text, name))


def _scored(docs: DataFrame, model: Model, text: str, name: str) -> DataFrame:
    if model.trees is None:
        return docs.withColumn(name, F.lit(float(model.share)))
    vectors = with_features(docs, model.lexicon, text, "__features").withColumn(
        "__vector", array_to_vector("__features")
    )
    trees = model.trees.copy()
    trees.setFeaturesCol("__vector").setPredictionCol("__prediction").setRawPredictionCol("__raw")
    trees.setProbabilityCol("__probability")
    scored = trees.transform(vectors)
    raw = vector_to_array("__probability")[1]
    score = F.least(F.greatest(_calibrated(raw, model), F.lit(0.0)), F.lit(1.0))
    return scored.select(*docs.columns, score.alias(name))


def labelled(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text, toxic) of the documents that have a label."""
    known = labels.where("toxic is not null").groupBy(F.col(id).alias("id")).agg(F.max("toxic").alias("toxic"))
    if known.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(known, "id")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows below the threshold, with their columns; all rows if the labels could not teach what is toxic."""
    if model.trees is None:
        return docs
    return with_scores(docs, model, text, "__score").where(F.col("__score") < threshold).drop("__score")
