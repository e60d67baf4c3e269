"""Benchmark decontamination by winnowing.

Words are lower-cased runs of ASCII letters, digits and other characters beyond ASCII. Of every ``WINDOW`` words in a row
the minimum hash of their ``GRAM``-word sequences is kept as a fingerprint, on both sides by the same rule, so every
shared span of WINDOW words holds a kept sequence that both sides share. Documents keep only fingerprints the benchmark
has, and each such hit is extended to all windows around it: those that are windows of the benchmark are hits, which
finds every shared span and nothing else. Windows are compared by 64-bit hashes of their word hashes.

An item with fewer than WINDOW words, but with some, is one window of its own length and is its own fingerprint: texts
are looked up for sequences of exactly the lengths that such items have.

The windows of the benchmark are sent to every task if there are at most ``MOST_BROADCAST`` of them (16 bytes each and
the item lists); a larger benchmark is joined by shuffles on fingerprint and window instead, with the same result.

Null texts have no words. A null item id is skipped in the item lists but its words still count as hits. Items repeated
under one id count once. Empty tables: no hits, or no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.shared import on_own_columns
from tickbars.llm.words import ALPHANUMERIC, Words, contains, ranges, segments_min, sequence_hashes, slices, words_of

WINDOW = 13
GRAM = 6
MOST_BROADCAST = 4_000_000
#: A document is contaminated if 1 / SHARE of its words or more are hit.
SHARE = 20
HITS = "n_words long, spans array<struct<low:long,high:long>>, items array<long>"
_EDGE = np.uint64(0xFFFFFFFFFFFFFFFF)


def split(column: pa.Array) -> Words:
    return words_of(column, ALPHANUMERIC, lower=True)


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Kept sequences: the words they start at, and the hashes of all sequences of GRAM words.

    A sequence is kept if it is the minimum of some window inside its text; equal minima are all kept, which keeps the
    choice the same wherever the span stands.
    """
    grams = words.sequences(GRAM)
    per_window = WINDOW - GRAM + 1
    lowest = segments_min(grams, per_window)
    windows = words.can_start(WINDOW)
    # The smallest hash that would be kept at each sequence: the largest window minimum among windows that hold it.
    reach = np.where(windows, lowest, np.uint64(0))
    padded = np.concatenate((np.zeros(per_window - 1, np.uint64), reach))
    limit = _EDGE - segments_min(_EDGE - padded, per_window)[: len(grams)]
    return np.flatnonzero((grams <= limit) & words.can_start(GRAM)), grams


@dataclass
class Windows:
    """The benchmark's windows by length in words: ordered hashes, and the items of each as positions in ``items``."""

    kept: np.ndarray
    hashes: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    items: dict[int, np.ndarray]


def benchmark_windows(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (length, window, item, kept): every window of every item, and fingerprints as rows of length 0."""

    def found(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = split(part.column("text"))
                ids = part.column("id")
                at, grams = fingerprints(words)
                lengths, hashes, texts = [np.zeros(len(at), np.int64)], [grams[at]], [words.text[at]]
                full = np.flatnonzero(words.can_start(WINDOW))
                lengths.append(np.full(len(full), WINDOW))
                hashes.append(words.sequences(WINDOW)[full])
                texts.append(words.text[full])
                for item in np.flatnonzero((words.counts > 0) & (words.counts < WINDOW)):
                    low, high = words.first[item], words.first[item + 1]
                    lengths.append(np.array([high - low]))
                    hashes.append(sequence_hashes(words.hashes[low:high], int(high - low))[:1])
                    texts.append(np.array([item]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(lengths).astype(np.int32)),
                        pa.array(np.concatenate(hashes).view(np.int64)),
                        ids.take(pa.array(np.concatenate(texts))),
                    ],
                    ["length", "window", "item"],
                )

    source = benchmark.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(found, "length int, window long, item long").distinct()


def _collected(windows: DataFrame) -> Windows:
    table = windows.toArrow()
    # Ids stay whole numbers; which of them are null is told beside them.
    length, window = table.column("length").to_numpy(), table.column("window").to_numpy().view(np.uint64)
    item, there = pc.fill_null(table.column("item"), 0).to_numpy(), pc.is_valid(table.column("item")).to_numpy()
    order = np.lexsort((item, ~there, window, length))
    length, window, item, there = length[order], window[order], item[order], there[order]
    hashes, first, items = {}, {}, {}
    for n in np.unique(length[length > 0]).tolist():
        mine = np.flatnonzero(length == n)
        mine = mine[np.argsort(window[mine], kind="stable")]
        hashes[n], begins = np.unique(window[mine], return_index=True)
        known = there[mine]
        first[n] = np.concatenate(([0], np.cumsum(known)))[[*begins.tolist(), len(mine)]]
        items[n] = item[mine][known]
    return Windows(np.unique(window[length == 0]), hashes, first, items)


def candidate_starts(words: Words, kept: np.ndarray) -> np.ndarray:
    """The words at which a full window starts that holds one of the benchmark's fingerprints, ordered."""
    at, grams = fingerprints(words)
    at = at[contains(kept, grams[at])]
    around = ranges(at - (WINDOW - GRAM), np.full(len(at), WINDOW - GRAM + 1))
    around = np.unique(around[around >= 0])
    return around[words.can_start(WINDOW)[around]]


def _spans(starts: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Covered runs of n words, as low and high bounds, of windows that may overlap."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    covered = np.concatenate(([0], (np.cumsum(change)[:n] > 0).astype(np.int8), [0]))
    turns = np.flatnonzero(np.diff(covered))
    return turns[::2], turns[1::2]


def _hits(words: Words, benchmark: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of hit windows; and pairs of text and item."""
    starts, lengths, texts, items = [], [], [], []
    for n, ordered in benchmark.hashes.items():
        at = candidate_starts(words, benchmark.kept) if n == WINDOW else np.flatnonzero(words.can_start(n))
        values = words.sequences(n)[at]
        at, values = (x[contains(ordered, values)] for x in (at, values))
        slot = np.searchsorted(ordered, values)
        # Each window once per text before its items are listed.
        pairs = np.unique(np.stack((words.text[at], slot)), axis=1)
        many = benchmark.first[n][pairs[1] + 1] - benchmark.first[n][pairs[1]]
        texts.append(np.repeat(pairs[0], many))
        items.append(benchmark.items[n][ranges(benchmark.first[n][pairs[1]], many)])
        starts.append(at)
        lengths.append(np.full(len(at), n))
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (starts, lengths, texts, items))


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_words, spans (runs of hit words) and items (ids of items with a window in the text, ordered),
    which replace columns of these names."""
    added = ["n_words", "spans", "items"]
    return on_own_columns(docs, [text], added, lambda rows: _found(rows, benchmark, text))


def _found(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    windows = benchmark_windows(benchmark).persist()
    try:
        if windows.count() > MOST_BROADCAST:
            return _joined_hits(docs, windows, text)
        known = docs.sparkSession.sparkContext.broadcast(_collected(windows))
    finally:
        windows.unpersist()

    def added(batches):
        for batch in batches:
            for part in slices(batch, text):
                yield _with_columns(part, text, known.value)

    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(HITS).fields])
    return docs.mapInArrow(added, schema)


def _with_columns(part: pa.RecordBatch, text: str, benchmark: Windows) -> pa.RecordBatch:
    words = split(part.column(text))
    starts, lengths, texts, items = _hits(words, benchmark)
    lows, highs = _text_spans(words, starts, lengths)
    pairs = np.unique(np.stack((texts, items)), axis=1)
    owner = np.searchsorted(words.first, lows, side="right") - 1
    span_at = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
    item_at = np.searchsorted(pairs[0], np.arange(part.num_rows + 1)).astype(np.int32)
    base = words.first[owner]
    spans = pa.StructArray.from_arrays([pa.array(lows - base), pa.array(highs - base)], ["low", "high"])
    return pa.RecordBatch.from_arrays(
        [
            *part.columns,
            pa.array(words.counts.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(span_at), spans),
            pa.ListArray.from_arrays(pa.array(item_at), pa.array(pairs[1])),
        ],
        [*part.schema.names, "n_words", "spans", "items"],
    )


def _text_spans(words: Words, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covered runs, cut where a text ends: a run may otherwise go on into the next text."""
    n = len(words.starts)
    lows, highs = _spans(starts, lengths, n)
    edges = words.first[1:-1]
    edges = np.unique(edges[(edges > 0) & (edges < n)])
    inner = edges[(np.searchsorted(lows, edges) > 0)]
    at = np.searchsorted(lows, inner) - 1
    inner = inner[(lows[at] < inner) & (inner < highs[at])] if len(lows) else inner[:0]
    return np.sort(np.concatenate((lows, inner))), np.sort(np.concatenate((highs, inner)))


def _merged(batches):
    """Hit windows of each text, in any order, merged to runs: rows (key, spans, items) of rows (key, found, items)."""
    for batch in batches:
        key, found, items = batch.columns
        flat = found.flatten()
        start, stop = (flat.field(name).to_numpy() for name in ("start", "stop"))
        owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(found).to_numpy())
        # Texts one after the other on one line, too far apart to touch.
        apart = int(stop.max(initial=0)) + 2
        order = np.lexsort((start, owner))
        low, high = (start + owner * apart)[order], np.maximum.accumulate((stop + owner * apart)[order])
        begins = np.ones(len(low), bool)
        begins[1:] = low[1:] > high[:-1]
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(low))[: len(first)] - 1
        of = owner[order][first]
        spans = pa.StructArray.from_arrays([pa.array(low[first] - of * apart), pa.array(high[last] - of * apart)], ["low", "high"])
        bounds = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(pa.array(bounds), spans), items], ["__text", "spans", "items"])


def _joined_hits(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """The same without a broadcast. Hits depend on the text alone, so they are found once per text and joined back."""
    key = "__text"
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    lengths = [r.length for r in windows.where("length between 1 and 12").select("length").distinct().collect()]

    def grams(batches):
        """Candidate windows, each with the fingerprint in it that says so; short lengths need none."""
        for batch in batches:
            for part in slices(batch, "text"):
                words = split(part.column("text"))
                at, hashes = fingerprints(words)
                width = WINDOW - GRAM + 1
                starts, kept = ranges(at - (WINDOW - GRAM), np.full(len(at), width)), np.repeat(hashes[at], width)
                good = starts >= 0
                good[good] = words.can_start(WINDOW)[starts[good]]
                starts, kept = starts[good], kept[good]
                rows = [(np.full(len(starts), WINDOW), starts, kept, words.sequences(WINDOW)[starts])]
                for n in lengths:
                    starts = np.flatnonzero(words.can_start(n))
                    rows.append((np.full(len(starts), n), starts, words.sequences(n)[starts], words.sequences(n)[starts]))
                length, starts, kept, window = (np.concatenate(x) for x in zip(*rows, strict=True))
                owner = words.text[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(owner)),
                        pa.array(length.astype(np.int32)),
                        pa.array(starts - words.first[owner]),
                        pa.array(kept.view(np.int64)),
                        pa.array(window.view(np.int64)),
                    ],
                    ["key", "length", "start", "kept", "window"],
                )

    texts = docs.select(digest.alias("key"), F.col(text).alias("text"))
    candidates = texts.mapInArrow(grams, "key binary, length int, start long, kept long, window long")
    kept = windows.where("length = 0").select(F.col("window").alias("kept")).distinct()
    # Common passages make hot keys here; neither join needs the rows of a key together, so Spark may split them.
    full = candidates.where(F.col("length") == WINDOW).join(kept, "kept", "left_semi")
    found = full.unionByName(candidates.where(F.col("length") < WINDOW)).join(windows, ["length", "window"])
    # At most one window of each length from every word of the text.
    hits = found.groupBy(F.col("key").alias(key)).agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("stop"))).alias("found"),
        F.sort_array(F.collect_set("item")).alias("items"),
    )

    hits = hits.mapInArrow(_merged, f"{key} binary, spans array<struct<low:long,high:long>>, items array<long>")
    none = F.array().cast("array<long>")
    n_words = F.regexp_count(F.lower(F.col(text)), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    return (
        docs.withColumn(key, digest)
        .join(hits, key, "left")
        .select(
            *docs.columns,
            F.coalesce(n_words, F.lit(0)).cast("long").alias("n_words"),
            F.coalesce("spans", F.array().cast("array<struct<low:long,high:long>>")).alias("spans"),
            F.coalesce("items", none).alias("items"),
        )
    )


def n_hit():
    """Hit words, of rows with spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])


def contaminated():
    return (n_hit() > 0) & (n_hit() * SHARE >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are not contaminated, with their columns."""
    clean = lambda rows: _found(rows, benchmark, text).where(~contaminated())
    return on_own_columns(docs, [text], [], clean)


def report(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, n_words, n_hit, n_items, items_sha256 (of the ids as sorted texts), contaminated."""

    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return with_hits(docs.select(id, text), benchmark, text).select(
        id,
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
