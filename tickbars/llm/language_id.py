"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters (letters lower-cased, everything else a space) are hashed into ``BUCKETS``. A text's
vector is the share of its n-grams in each bucket times the bucket's inverse document frequency, so a prediction is one
mean of weights over all n-grams of the whole text. Document frequencies cover all training documents; the weights are
fitted on at most ``SAMPLE`` of them (a documented parameter, spread over the languages by a hash of the id) with
follow-the-regularised-leader and elastic-net penalties, which leave most weights zero. A temperature fitted on sampled
documents that the weights never saw turns the outputs into calibrated probabilities.

The weights (BUCKETS times languages, at most ``MOST_LANGUAGES``) are what is broadcast: a bound that no data moves. More
labelled languages are an error.

Null texts and texts without a letter are ``und`` with score 0. Without any labelled document every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.shared import on_own_columns, written
from tickbars.llm.words import mixed, slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE = 1_500
MOST_LANGUAGES = 256
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
#: Shares of n-grams are small numbers; this puts the vectors near unit length.
SCALE = 10.0
UNKNOWN = "und"

_LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and where each text begins; what is no letter is a space."""
    column = pc.utf8_lower(pc.fill_null(column, ""))
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    text = "".join(column.to_pylist())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_LETTERS[points], points, 32), np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram from each character on."""
    value = np.zeros(max(len(points) - order + 1, 0), np.uint64)
    for i in range(order):
        value = value * np.uint64(0x110001) + points[i : len(points) - order + 1 + i]
    return (mixed(value + np.uint64(order << 60)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def grams(column: pa.Array):
    """Per order the buckets of all n-grams and the bounds of each text's n-grams among them."""
    points, first = characters(column)
    blank = points == 32
    for order in ORDERS:
        found = buckets(points, order)
        # Not across texts, and not of spaces alone.
        inside = np.ones(len(found), bool)
        for i in range(1, order):
            edge = first[1:-1] - i
            inside[edge[(edge >= 0) & (edge < len(found))]] = False
        empty = blank[: len(found)].copy()
        for i in range(1, order):
            empty &= blank[i : len(found) + i]
        keep = inside & ~empty
        before = np.concatenate(([0], np.cumsum(keep)))
        yield found[keep], before[np.minimum(first, len(found))]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts have each bucket, and the number of texts; tasks count before anything is sent."""

    def counted(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                parts = list(grams(part.column("text")))
                for i in range(part.num_rows):
                    seen = np.zeros(BUCKETS, bool)
                    for found, bounds in parts:
                        seen[found[bounds[i] : bounds[i + 1]]] = True
                    total += seen
                n += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS, dtype=np.int32)), pa.array(np.concatenate(([n], total)))], ["bucket", "n"]
        )

    sums = texts.select("text").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, n = np.zeros(BUCKETS), 0
    for row in sums.collect():  # BUCKETS + 1 rows whatever the input
        if row.bucket < 0:
            n = row.n
        else:
            out[row.bucket] = row.n
    return out, n


@dataclass
class Model:
    languages: list[str]
    #: (languages, BUCKETS), with the inverse document frequencies and the scale worked in.
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0


def vectors(column: pa.Array, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vectors: buckets and values."""
    parts = list(grams(column))
    out = []
    for i in range(len(column)):
        own = np.concatenate([found[bounds[i] : bounds[i + 1]] for found, bounds in parts])
        at, n = np.unique(own, return_counts=True)
        out.append((at, SCALE * idf[at] * n / max(len(own), 1)))
    return out


def trained(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int, seed: int = 3):
    """Weights and bias by FTRL-proximal with elastic net, one example at a time."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at, x = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 1.0)
            w = weights(z[:, at], n[:, at])
            p = _softmax(w @ x)
            p[label[i]] -= 1
            g = p[:, None] * x
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / ALPHA
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    w = weights(z, n)
    return w[:, :-1], w[:, -1]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fitted_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss, by golden sections on its logarithm."""
    if not len(label):
        return 1.0

    def loss(t):
        return -np.mean(np.log(_softmax(logits / np.exp(t))[np.arange(len(label)), label] + 1e-12))

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(labelled: DataFrame) -> Model:
    """Learn from a frame (id, text, lang); rows without a text or a language teach nothing."""
    labelled = labelled.where("lang is not null and text is not null")
    seen = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r.lang: r.n for r in seen.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labelled languages")
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    frequency, total = document_frequencies(labelled)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    each = max(2, SAMPLE // len(languages))
    # Of each language the rows below a hash that leaves somewhat more than are wanted, and of these the lowest: a few
    # rows are ranked, whatever the table holds. Rows that repeat an id count singly, so they cannot add to the number.
    draw = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1 << 30))
    most = {x: int((1 << 30) * min(1.0, (1.5 * each + 20) / n)) for x, n in sizes.items()}
    below = F.create_map(*[F.lit(x) for pair in most.items() for x in pair])[F.col("lang")]
    order = Window.partitionBy("lang").orderBy("draw", "id", "text")
    drawn = labelled.select("id", "lang", "text", draw.alias("draw")).where(F.col("draw") < below)
    sample = drawn.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    known = labelled.sparkSession.sparkContext.broadcast(idf)

    def sparse(batches):
        for batch in batches:
            for part in slices(batch):
                found = vectors(part.column("text"), known.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"),
                        part.column("place"),
                        pa.array([at for at, _ in found], pa.list_(pa.int32())),
                        pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32())),
                    ],
                    ["lang", "place", "at", "x"],
                )

    sample = sample.select("lang", "place", "text").mapInArrow(
        sparse, "lang string, place int, at array<int>, x array<float>"
    )
    rows = written(sample, "sample").orderBy("lang", "place").toPandas()
    label = rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    data = [(np.asarray(at, np.int64), np.asarray(x, float)) for at, x in zip(rows["at"], rows["x"], strict=True)]
    last = (rows["place"].to_numpy() % 5) == 0  # a fifth is kept for the temperature
    learn = np.flatnonzero(~last)
    weights, bias = trained([data[i] for i in learn], label[learn], len(languages))
    rest = np.flatnonzero(last)
    logits = np.array([weights[:, data[i][0]] @ data[i][1] + bias for i in rest]).reshape(len(rest), len(languages))
    return Model(languages, (weights * idf * SCALE).astype(np.float32), bias, fitted_temperature(logits, label[rest]))


def _predicted(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    logits = np.zeros((len(column), len(model.languages)))
    n = np.zeros(len(column))
    for found, bounds in grams(column):
        n += np.diff(bounds)
        for i, weights in enumerate(model.weights):
            sums = np.concatenate(([0.0], np.cumsum(weights[found], dtype=float)))
            logits[:, i] += sums[bounds[1:]] - sums[bounds[:-1]]
    p = _softmax((logits / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
    best = p.argmax(axis=1)
    return best, p[np.arange(len(p)), best]


def with_language(
    docs: DataFrame, model: Model, text: str = "text", name: str = "lang_pred", score: str = "lang_score"
) -> DataFrame:
    """The rows with a learned language and its probability, which replace columns of their names."""
    return on_own_columns(docs, [text], [name, score], lambda rows: _named(rows, model, text, name, score))


def _named(docs: DataFrame, model: Model, text: str, name: str, score: str) -> DataFrame:
    if not model.languages:
        return docs.withColumn(name, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))
    known = docs.sparkSession.sparkContext.broadcast(model)

    def added(batches):
        for batch in batches:
            for part in slices(batch, text):
                best, p = _predicted(part.column(text), known.value)
                lettered = pc.fill_null(pc.match_substring_regex(part.column(text), r"\p{L}"), False)
                names = pa.array(np.array(known.value.languages, object)[best], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pc.if_else(lettered, names, UNKNOWN),
                        pc.if_else(lettered, pa.array(p), 0.0),
                    ],
                    [*part.schema.names, name, score],
                )

    schema = [*docs.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(added, T.StructType(schema))
