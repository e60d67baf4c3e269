"""Substring dedup: windows of words that also start in an earlier document are removed, by super-k-mer partitioning.

Every window of ``WINDOW`` words has a minimiser, the smallest hash of its ``MER``-word sequences. Consecutive windows
with the same minimiser travel together as one packed string (a super-k-mer) to the bucket of that minimiser, so equal
windows always meet. There the windows are sorted, equal ones counted exactly (by word identity, not by hash), and each
one whose smallest document comes before its own marks its words. Marks go back to their documents.

What keeps this bounded when texts repeat a lot:
* Word sequences that are very frequent rank last as minimisers, so a common phrase in many contexts gathers no bucket.
  They are found by each task sending its heavy hitters; at most ``2 * SHARE`` can reach the threshold.
* A minimiser that a Bloom filter of bounded size has seen in one document only cannot hold a repeated window: its
  super-k-mers stay at home. Past the size at which that filter fills up, all travel, and the result is the same.
* Equal super-k-mers of one slice of documents travel once, for the smallest document; the others are marked on the spot.

Null and empty texts have no words. Documents are compared by id: rows that repeat an id never remove from each other; a
null id comes after all others. Windows are judged on the input, not on what is left. Other columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.exact_dedup import packed_probes, merged_slots, probed, slots_for
from tickbars.llm.shared import on_own_columns, written
from tickbars.llm.words import Words, contains, mixed, ranges, segments_min, slices, words_of

WINDOW = 13
MER = 5
SHARE = 2_000
LEAST_HOT = 64
WORDS_PER_BUCKET = 100_000
SLICE = 2 << 20
_LAST_ID = (1 << 63) - 1
_TOP = np.uint64(1 << 63)
_FLUSH = 1 << 22


def minimisers(words: Words, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows' starts and their minimisers; hot sequences rank after all others."""
    mers = words.sequences(MER) >> np.uint64(1)
    if len(hot):
        mers = np.where(contains(hot, mers), mers | _TOP, mers)
    at = np.flatnonzero(words.can_start(WINDOW))
    return at, segments_min(mers, WINDOW - MER + 1)[at]


def _hot_sequences(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Sequences of MER words with more than about 1 / SHARE of all, ordered; and the number of all words."""

    def heavy(batches):
        def flush(held):
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(LEAST_HOT, counts.sum() // SHARE)
            hashes = np.concatenate((found[many].view(np.int64), [0]))
            n = np.concatenate((counts[many], [counts.sum()]))
            kind = np.concatenate((np.ones(int(many.sum()), bool), [False]))
            return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(hashes), pa.array(n)], ["hot", "mer", "n"])

        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = words_of(part.column("text"))
                held.append((words.sequences(MER) >> np.uint64(1))[words.can_start(MER)])
                n += len(held[-1])
                if n >= _FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    sums = texts.mapInArrow(heavy, "hot boolean, mer long, n long").groupBy("hot", "mer").agg(F.sum("n").alias("n"))
    sums = written(sums, "heavy")
    total = sums.where("not hot").agg(F.sum("n").alias("n")).first().n or 0
    # Every sum counts real occurrences, so no more than 2 * SHARE sequences can pass.
    hot = sums.where("hot").where(F.col("n") >= max(LEAST_HOT, total // (2 * SHARE))).select("mer").toPandas()
    return np.sort(hot["mer"].to_numpy().astype(np.int64).view(np.uint64)), total


def _shared_minimisers(texts: DataFrame, hot, total: int) -> tuple[np.ndarray, int]:
    """A filter of the minimisers that more than one document may have."""
    slots = slots_for(total // 5)

    def touched(batches):
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = words_of(part.column("text"))
                at, least = minimisers(words, hot.value)
                # Once per document: copies of a minimiser inside one do not make it shared.
                turn = np.ones(len(at), bool)
                turn[1:] = (least[1:] != least[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])
                held.append(np.unique(np.stack((words.text[at[turn]].astype(np.uint64), least[turn])), axis=1)[1])
                n += len(held[-1])
                if n >= _FLUSH:
                    yield from packed_probes(mixed(np.concatenate(held)), slots)
                    held, n = [], 0
        if held:
            yield from packed_probes(mixed(np.concatenate(held)), slots)

    return merged_slots(texts.mapInArrow(touched, "segment int, once binary, more binary"), slots), slots


def packed(words: Words, lows: np.ndarray, highs: np.ndarray) -> pa.Array:
    """Runs of words as strings, each word followed by one space."""
    lengths = highs - lows
    index = ranges(lows, lengths)
    sizes = words.ends[index] - words.starts[index] + 1
    data = np.append(words.data, np.uint8(32))[ranges(words.starts[index], sizes)]
    stops = np.cumsum(sizes)
    data[stops - 1] = 32
    per_run = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(lengths)))]
    return pa.Array.from_buffers(
        pa.large_binary(), len(lows), [None, pa.py_buffer(per_run.astype(np.int64)), pa.py_buffer(data)]
    )


def _travelling(texts: DataFrame, hot, shared, slots: int, buckets: int) -> DataFrame:
    """Super-k-mers (bucket, id, key, low, high, packed), and marks made on the spot, which have no string."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield _super_kmers(part, hot.value, shared.value, slots, buckets)

    return texts.mapInArrow(rows, "bucket long, id long, key long, low long, high long, packed binary")


def _super_kmers(part: pa.RecordBatch, hot: np.ndarray, shared: np.ndarray, slots: int, buckets: int):
    words = words_of(part.column("text"))
    ids = part.column("id").to_numpy()
    keys = part.column("key").to_numpy()
    at, least = minimisers(words, hot)
    text = words.text[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    low, high = at[begin], at[np.append(begin[1:], len(at)) - 1] + WINDOW if len(at) else at[begin]
    least, text = least[begin], text[begin]
    go = probed(shared, mixed(least), slots)
    low, high, least, text = low[go], high[go], least[go], text[go]
    strings = packed(words, low, high)
    # Equal strings of this slice: the smallest document's travels.
    codes = strings.dictionary_encode().indices.to_numpy()
    order = np.lexsort((low, ids[text], codes))
    first = np.ones(len(order), bool)
    first[1:] = codes[order[1:]] != codes[order[:-1]]
    leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))] if len(order) else order
    marked = np.zeros(len(order), bool)
    marked[order] = ids[text[order]] > ids[text[leader]]
    away = ~marked  # the smallest document's, wherever they stand in it
    bucket = np.where(away, mixed(least) % np.uint64(buckets), mixed(ids[text].view(np.uint64)) % np.uint64(buckets))
    base = words.first[text]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket.astype(np.int64)),
            pa.array(ids[text]),
            pa.array(keys[text]),
            pa.array((low - base)),
            pa.array((high - base)),
            strings.take(pa.array(np.arange(len(away)), mask=~away)).cast(pa.binary()),
        ],
        ["bucket", "id", "key", "low", "high", "packed"],
    )


def repeated_windows(strings: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """Of packed strings with their documents: the string and the word at which a window starts that also starts in a
    smaller document. Windows are grouped by hash first; groups of several are then told apart word by word."""
    words = words_of(strings)
    at = np.flatnonzero(words.can_start(WINDOW))
    hashes = words.sequences(WINDOW)[at]
    ordered = np.sort(hashes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    at = at[contains(twice, hashes)]
    if not len(at):
        return at, at, words
    needed = np.unique(ranges(at, np.full(len(at), WINDOW)))
    sizes = words.ends[needed] - words.starts[needed]
    each = pa.Array.from_buffers(
        pa.large_binary(),
        len(needed),
        [
            None,
            pa.py_buffer(np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)),
            pa.py_buffer(words.data[ranges(words.starts[needed], sizes)]),
        ],
    )
    code = np.zeros(len(words.starts), np.int32)
    code[needed] = each.dictionary_encode().indices.to_numpy()
    windows = np.ascontiguousarray(code[at[:, None] + np.arange(WINDOW)])
    _, group = np.unique(windows.view(np.dtype((np.void, windows.itemsize * WINDOW))).ravel(), return_inverse=True)
    own = ids[words.text[at]]
    least = np.full(group.max() + 1, _LAST_ID)
    np.minimum.at(least, group, own)
    at = at[own > least[group]]
    return words.text[at], at - words.first[words.text[at]], words


def _marks(table: pa.Table) -> pa.Table:
    """The runs of words that a bucket marks: (id, key, low, high)."""
    table = table.combine_chunks()
    done = table.filter(pa.compute.is_null(table["packed"])).select(["id", "key", "low", "high"])
    inside = table.filter(pa.compute.is_valid(table["packed"]))
    if not inside.num_rows:
        return done
    ids, low = inside["id"].to_numpy(), inside["low"].to_numpy()
    strings = inside["packed"].combine_chunks()
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.chunk(0)
    row, start, _ = repeated_windows(strings, ids)
    begin = np.ones(len(row), bool)
    begin[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    found = pa.table(
        {
            "id": ids[row[first]],
            "key": inside["key"].to_numpy()[row[first]],
            "low": low[row[first]] + start[first],
            "high": low[row[first]] + start[last] + WINDOW,
        }
    )
    return pa.concat_tables([done, found])


def remove_repeated(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with n_words, n_removed and kept_text (the words that stay, joined by one space), which replace columns
    of these names."""
    added = ["n_words", "n_removed", "kept_text"]
    return on_own_columns(docs, [id, text], added, lambda rows: _removed(rows, id, text))


def _removed(docs: DataFrame, id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    key, own = F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.coalesce(F.col(id).cast("long"), F.lit(_LAST_ID))
    texts = docs.where(F.length(text) > 0).select(own.alias("id"), key.alias("key"), F.col(text).alias("text"))
    hot, total = _hot_sequences(texts.select("text"))
    hot = spark.sparkContext.broadcast(hot)
    bits, slots = _shared_minimisers(texts.select("text"), hot, total)
    shared = spark.sparkContext.broadcast(bits)
    buckets = max(64, total // WORDS_PER_BUCKET)
    marks = (
        _travelling(texts, hot, shared, slots, buckets)
        .groupBy("bucket")
        .applyInArrow(_marks, "id long, key long, low long, high long")
        .groupBy("id", "key")
        .agg(F.collect_set(F.struct("low", "high")).alias("__marks"))
        .withColumnsRenamed({"id": "__id", "key": "__key"})
    )
    rows = docs.withColumn("__id", own).withColumn("__key", key).join(marks, ["__id", "__key"], "left")

    def kept(batches):
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield _kept(part, text)

    schema = T.StructType(
        [*docs.schema.fields, *T._parse_datatype_string("n_words long, n_removed long, kept_text string").fields]
    )
    return rows.select(*docs.columns, "__marks").mapInArrow(kept, schema)


def _kept(part: pa.RecordBatch, text: str) -> pa.RecordBatch:
    words = words_of(part.column(text))
    marks = part.column("__marks")
    many = pa.compute.fill_null(pa.compute.list_value_length(marks), 0).to_numpy()
    flat = marks.flatten()
    base = np.repeat(words.first[:-1], many)
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, flat.field("low").to_numpy() + base, 1)
    np.add.at(change, flat.field("high").to_numpy() + base, -1)
    stays = np.cumsum(change)[:-1] == 0
    index = np.flatnonzero(stays)
    counts = words.per_text(stays)
    sizes = words.ends[index] - words.starts[index] + 1
    data = np.append(words.data, np.uint8(32))[ranges(words.starts[index], sizes)]
    stops = np.cumsum(sizes)
    data[stops - 1] = 32
    # No space after a text's last word.
    edges = np.cumsum(counts)
    lasts = np.unique(edges[counts > 0])
    trimmed = np.ones(len(data), bool)
    trimmed[stops[lasts - 1] - 1] = False
    bounds = np.concatenate(([0], np.cumsum(trimmed)))[np.concatenate(([0], stops))[np.concatenate(([0], edges))]]
    strings = pa.Array.from_buffers(
        pa.large_string(), part.num_rows, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[trimmed])]
    ).cast(pa.string())
    names = [n for n in part.schema.names if n != "__marks"]
    return pa.RecordBatch.from_arrays(
        [
            *(part.column(n) for n in names),
            pa.array(words.counts.astype(np.int64)),
            pa.array((words.counts - counts).astype(np.int64)),
            strings,
        ],
        [*names, "n_words", "n_removed", "kept_text"],
    )
