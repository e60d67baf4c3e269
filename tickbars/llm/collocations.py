"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends, pieces into words. Nodes are sequences of LONGEST - 1 words, an
edge is a sequence of LONGEST words and joins the node it starts with to the node it ends with. Only edges are counted,
and, where a piece ends, the shorter sequence left there. The count of a shorter sequence follows: it is the flow out of
its node, the sum of the counts of the sequences one word longer that start with it, plus its own ends
(``flows``). A sequence whose whole flow passes through one edge lies on a unary path; ``compacted`` merges it into the
path, so of each path the whole one is left.

1. Pairs of neighbouring words are counted, combined per task and then by shuffle. Those met ``least`` times or more enter
   a bit filter of at most MAX_SLOTS bits (32 MB), which is broadcast.
2. Pieces are cut again between words whose pair the filter does not have: no phrase met ``least`` times goes over such
   a place. From every word on, the longest sequence of up to LONGEST words in its piece is one edge or one end; tasks
   combine equal ones before the shuffle. A fuller filter cuts less, so more rows travel; the counts stay the same.
3. Flows give all counts; phrases met ``least`` times or more are scored at each cut by joins with their parts' counts.

Sequences of one task are combined by 64-bit hashes of their words, all else goes by the words themselves. Arithmetic is
decimal, exact up to 10^35 for ``a * n``.

A null language is ``und``. Null and empty texts have no words; rows that repeat one another all count. Ties go to the
higher count, then to the smaller phrase in byte order. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.exact_dedup import _SEGMENT, packed_probes, probed, slots_for
from tickbars.llm.shared import written
from tickbars.llm.words import Words, mixed, ranges, sequence_hashes, slices, words_of

LONGEST = 5
LEAST = 100
BEST = 2000
UNKNOWN = "und"
SLICE = 1 << 20
#: Words that a task reads before it sends what it has combined.
CHUNK = 1 << 22
#: Parts in which the best phrases of a language are looked for before they meet.
PARTS = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ALL = np.arange(256)
_CUT = np.isin(_ALL, np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8))
_WORD = ~(_CUT | (_ALL == 0x20) | (_ALL == 0x09))
_EXACT = "decimal(38,0)"


def _read(part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a batch (lang, text), whether each is followed by another in its piece, and hashes of their
    languages."""
    words = words_of(part.column("text"), _WORD, lower=True)
    cuts = np.concatenate(([0], np.cumsum(_CUT[words.data])))
    piece = cuts[words.starts]
    followed = np.zeros(len(piece), bool)
    followed[:-1] = (piece[1:] == piece[:-1]) & (words.text[1:] == words.text[:-1])
    lang = pc.dictionary_encode(part.column("lang"))
    codes = words_of(lang.dictionary, np.ones(256, bool))
    of_lang = np.zeros(len(lang.dictionary), np.uint64)
    of_lang[codes.text] = codes.hashes
    return words, followed, of_lang[lang.indices.to_numpy(zero_copy_only=False)][words.text]


def _pairs(words: Words, lang: np.ndarray) -> np.ndarray:
    """The hash of each word and the next in the language of the first; the last has none."""
    return mixed(sequence_hashes(words.hashes, 2)[:-1] ^ lang[:-1] * _MULTIPLIER)


def frequent_pairs(texts: DataFrame, least: int) -> DataFrame:
    """Hashes of the pairs of neighbouring words met ``least`` times or more, given a frame (lang, text)."""

    def sent(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(found), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(found[part].view(np.int64)), pa.array(n[part])], ["hash", "n"])

    def counted(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, followed, lang = _read(part)
                held.append(_pairs(words, lang)[followed[:-1]])
                size += len(held[-1])
                if size >= CHUNK:
                    yield from sent(held)
                    held, size = [], 0
        if size:
            yield from sent(held)

    # Tasks have combined already: rows are dealt by some bits of the hash, and summed once.
    dealt = texts.mapInArrow(counted, "hash long, n long").withColumn("high", F.shiftrightunsigned("hash", 52))
    sums = dealt.repartition("high").groupBy("high", "hash").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= least).select("hash")


def filter_of(hashes: DataFrame, slots: int) -> np.ndarray:
    """A bit filter of the hashes of a one-column frame, as packed bits: each segment is merged in a task of its own."""

    def touched(batches):
        for batch in batches:
            if batch.num_rows:
                yield from packed_probes(batch.column(0).to_numpy(zero_copy_only=False), slots)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(_SEGMENT, bool)
        for column in ("once", "more"):
            for packed in rows[column]:
                bits[np.frombuffer(packed, "<u2")] = True
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    parts = hashes.mapInArrow(touched, "segment int, once binary, more binary")
    found = np.zeros(slots // 8, np.uint8)
    for row in parts.groupBy("segment").applyInPandas(merged, "segment int, bits binary").toLocalIterator():
        low = row.segment * (_SEGMENT // 8)
        found[low : low + _SEGMENT // 8] = np.frombuffer(row.bits, np.uint8)
    return found


def _longest(words: Words, followed: np.ndarray) -> np.ndarray:
    """How many words, up to LONGEST, there are from each word to the end of its piece."""
    n = np.ones(len(followed), np.int64)
    goes_on = followed.copy()
    for step in range(1, LONGEST):
        n += goes_on
        left = max(len(followed) - step, 0)
        goes_on[:left] &= followed[step:]
        goes_on[left:] = False
    return n


def _joined(words: Words, first: np.ndarray, n: np.ndarray) -> pa.Array:
    """The ``n`` words from each of some words on, joined by one space."""
    lengths = words.ends - words.starts
    stops = np.cumsum(lengths + 1)
    data = words.data[np.minimum(ranges(words.starts, lengths + 1), max(len(words.data) - 1, 0))]
    data[stops - 1] = 0x20
    low, high = (stops - lengths - 1)[first], stops[first + n - 1] - 1
    offsets = np.concatenate(([0], np.cumsum(high - low)))
    taken = data[ranges(low, high - low)]
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken)])


def edges_and_ends(texts: DataFrame, bits: np.ndarray, slots: int) -> DataFrame:
    """Rows (lang, k, phrase, n): the edges (k = LONGEST) and the shorter sequences that end their piece."""
    linked = texts.sparkSession.sparkContext.broadcast(bits)

    def combined(held) -> Iterator[pa.RecordBatch]:
        keys, n, k, lang, phrase = (list(x) for x in zip(*held, strict=True))
        _, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(which, np.concatenate(n)).astype(np.int64)
        k, lang, phrase = np.concatenate(k), pa.concat_arrays(lang), pa.concat_arrays(phrase)
        for at in range(0, len(first), 1 << 16):
            part = first[at : at + (1 << 16)]
            columns = [lang.take(pa.array(part)), pa.array(k[part]), phrase.take(pa.array(part)).cast(pa.string()), pa.array(total[at : at + (1 << 16)])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "k", "phrase", "n"])

    def counted(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, followed, lang = _read(part)
                if not len(followed):
                    continue
                at = np.flatnonzero(followed)
                followed[at] = probed(linked.value, _pairs(words, lang)[at], slots)
                k = _longest(words, followed)
                keys = np.zeros(len(k), np.uint64)
                for length in range(1, LONGEST + 1):
                    some = k == length
                    keys[some] = mixed(sequence_hashes(words.hashes, length)[some] ^ lang[some] * _MULTIPLIER + np.uint64(length))
                found, first, n = np.unique(keys, return_index=True, return_counts=True)
                langs = part.column("lang").take(pa.array(words.text[first])).cast(pa.string())
                held.append((found, n, k[first], langs, _joined(words, first, k[first])))
                size += len(k)
                if size >= CHUNK:
                    yield from combined(held)
                    held, size = [], 0
        if held:
            yield from combined(held)

    return texts.mapInArrow(counted, "lang string, k long, phrase string, n long").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def flows(rows: DataFrame) -> list[DataFrame]:
    """Counts (lang, phrase, n) of the sequences of 1 to LONGEST words, from the edges and ends alone: a sequence's count
    is the flow into the sequences one word longer, plus its ends. Each level is combined before its shuffle."""
    level = rows.where(F.col("k") == LONGEST).select("lang", "phrase", "n")
    levels = [level]
    for k in range(LONGEST - 1, 0, -1):
        out = level.select("lang", F.substring_index("phrase", " ", k).alias("phrase"), "n")
        ends = rows.where(F.col("k") == k).select("lang", "phrase", "n")
        level = written(out.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), f"words-{k}")
        levels.append(level)
    return levels[::-1]


def compacted(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Phrases (lang, k, phrase, a) without those that a longer one of the same count contains.

    If any longer phrase has a phrase's count, so has one that is longer by a single word: all of the flow passes through
    that edge. So it is enough to look at each phrase's start and rest, one word shorter.
    """
    longer = phrases.where(F.col("k") > 2)
    start = F.expr("substring_index(phrase, ' ', int(k) - 1)")
    rest = F.expr("substring_index(phrase, ' ', 1 - int(k))")
    inside = longer.select("lang", start.alias("phrase"), "a").unionByName(longer.select("lang", rest.alias("phrase"), "a"))
    return phrases.join(inside.distinct(), ["lang", "phrase", "a"], "left_anti")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases (lang, k, phrase, a) with l, r, n and score of the lowest-scoring cut; of equal scores the first cut.

    ``counts`` (lang, phrase, n) has all parts, ``totals`` (lang, total) a row per language.
    """
    cut = F.explode(F.sequence(F.lit(1), (F.col("k") - 1).cast("int"))).alias("cut")
    cuts = phrases.select("lang", "k", "phrase", "a", cut).withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', cut)"),
            "right": F.expr("substring_index(phrase, ' ', cut - int(k))"),
        }
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    exact = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals.withColumnRenamed("total", "n"), "lang")
    up = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).cast("decimal(34,0)")
    down = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    exact = exact.withColumns({"__up": up.cast(_EXACT), "__down": down.cast(_EXACT)}).withColumn("score", F.expr("__up div __down"))
    lowest = exact.groupBy("lang", "k", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return lowest.select("lang", "k", "phrase", "a", "best.l", "best.r", "n", "best.score")


def best_of(phrases: DataFrame, best: int) -> DataFrame:
    """The first ``best`` phrases of each language with their rank. Each language is first looked through in PARTS parts,
    so that what meets in one task is at most PARTS * best rows."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    dealt = phrases.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= best)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return some.drop("__part", "rank").withColumn("rank", place.cast("long")).where(F.col("rank") <= best)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, best: int = BEST) -> DataFrame:
    """Rows lang, rank, phrase, a, l, r, n, score: the phrases of 2 to LONGEST words of each language whose words occur
    together most often beyond chance."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pairs = written(frequent_pairs(texts, least), "pairs")
    slots = slots_for(pairs.count())
    rows = written(edges_and_ends(texts, filter_of(pairs, slots), slots), "edges")
    levels = flows(rows)
    totals = levels[0].groupBy("lang").agg(F.sum("n").alias("total"))
    many = [level.where(F.col("n") >= least) for level in levels]
    counts = written(reduce(DataFrame.unionByName, [level.withColumn("k", F.lit(k).cast("long")) for k, level in enumerate(many, 1)]), "counts")
    phrases = counts.where(F.col("k") > 1).select("lang", "k", "phrase", F.col("n").alias("a"))
    found = scored(compacted(phrases), counts.select("lang", "phrase", "n"), written(totals, "totals"))
    return best_of(found, best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
