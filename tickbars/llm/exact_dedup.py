"""Exact dedup with two passes of Bloom filtering.

Pass one hashes every text and counts each hash's probes in a Bloom filter of saturating counters (none, once, more). A
text may be repeated only if all of its probes were counted more than once. Pass two tests every row against the
filter: rows that cannot be repeated pass straight through, only the others shuffle, as SHA-256 digests and ids.

The filter has 16 slots a row up to ``MAX_SLOTS``; tasks send the slots they touched (two bytes each), the filter itself
is one bit a slot, so what is broadcast never exceeds MAX_SLOTS / 8 bytes = 32 MB. Beyond that a fuller filter only lets
more rows shuffle; the result is the same.

Null texts count as empty. Equal means equal SHA-256 digests of the UTF-8 bytes. Of equal texts the row with the largest
id stays; a null id is smaller than any other. Rows that repeat both text and id are marked alike, and ``drop_copies``
lets one of them stay. An empty table gives an empty result. Other columns are carried, never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import joined_to_groups, lower_hex, on_own_columns, written

MAX_SLOTS = 1 << 28
_SEGMENT = 1 << 16
_FLUSH_ROWS = 1 << 20
_HASH, _DIGEST, _MAYBE = "__hash", "__digest", "__maybe"


def slots_for(rows: int) -> int:
    """A power of two, 16 slots a row at least, within bounds."""
    return min(MAX_SLOTS, max(_SEGMENT, 1 << (16 * max(rows, 1) - 1).bit_length()))


def _probes(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(slots - 1)
    hashes = hashes.view(np.uint64)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(34)) & mask).astype(np.int64)


def packed_probes(hashes: np.ndarray, slots: int) -> Iterator[pa.RecordBatch]:
    """The slots that some hashes touch, by segment: those touched once and those touched more often."""
    found, counts = np.unique(np.concatenate(_probes(hashes, slots)), return_counts=True)
    cuts = np.flatnonzero(np.diff(found // _SEGMENT)) + 1
    rows = []
    for at, n in zip(np.split(found, cuts), np.split(counts, cuts), strict=True):
        low = (at % _SEGMENT).astype("<u2")
        rows.append((int(at[0] // _SEGMENT) if len(at) else 0, low[n == 1].tobytes(), low[n > 1].tobytes()))
    for i in range(0, len(rows), 1000):
        segment, once, more = zip(*rows[i : i + 1000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(segment, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
            ["segment", "once", "more"],
        )


def merged_slots(parts: DataFrame, slots: int) -> np.ndarray:
    """The slots touched more than once over all parts, as packed bits: slots / 8 bytes."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(_SEGMENT, np.int64)
        for column, weight in (("once", 1), ("more", 2)):
            for packed in rows[column]:
                counts[np.frombuffer(packed, "<u2")] += weight
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bits": [np.packbits(counts > 1).tobytes()]})

    bits = np.zeros(slots // 8, np.uint8)
    for row in parts.groupBy("segment").applyInPandas(merged, "segment int, bits binary").toLocalIterator():
        low = row.segment * (_SEGMENT // 8)
        bits[low : low + _SEGMENT // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def probed(bits: np.ndarray, hashes: np.ndarray, slots: int) -> np.ndarray:
    """Whether all probes of each hash were touched more than once."""
    found = np.ones(len(hashes), bool)
    for at in _probes(hashes, slots):
        found &= (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
    return found


def repeated_slots(hashes: DataFrame, slots: int) -> np.ndarray:
    """The slots that the hashes of a one-column frame hit more than once, as packed bits."""

    def touched(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False))
                n += batch.num_rows
            if n >= _FLUSH_ROWS:
                yield from packed_probes(np.concatenate(held), slots)
                held, n = [], 0
        if held:
            yield from packed_probes(np.concatenate(held), slots)

    return merged_slots(hashes.mapInArrow(touched, "segment int, once binary, more binary"), slots)


def _digests(docs: DataFrame, text: str) -> tuple[DataFrame, int]:
    """The rows with their digest and whether another row may have the same; and their number."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.withColumn(_HASH, F.xxhash64(content))
    rows = docs.count()
    slots = slots_for(rows)
    repeated = spark.sparkContext.broadcast(repeated_slots(hashed.select(_HASH), slots))

    @F.pandas_udf("boolean")
    def maybe_repeated(values: pd.Series) -> pd.Series:
        return pd.Series(probed(repeated.value, values.to_numpy(), slots))

    return (
        hashed.withColumn(_DIGEST, F.unhex(F.sha2(content, 256))).withColumn(_MAYBE, maybe_repeated(_HASH)).drop(_HASH),
        rows,
    )


def _groups(repeated: DataFrame, id: str) -> DataFrame:
    """One row per digest among the possibly repeated; equal digests combine in the task before the shuffle."""
    return repeated.groupBy(_DIGEST).agg(F.max(id).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def mark_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256."""
    marked, total = _digests(docs.select(id, text), text)
    marked = written(marked.select(id, _DIGEST, _MAYBE), "digests")
    single = marked.where(~F.col(_MAYBE)).select(
        id, _DIGEST, F.col(id).alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    repeated = marked.where(_MAYBE).select(id, _DIGEST)
    several = joined_to_groups(repeated, _groups(repeated, id), [_DIGEST], "group_size", total)
    return single.unionByName(several).select(
        id,
        "keep_id",
        "group_size",
        F.col(id).eqNullSafe(F.col("keep_id")).alias("kept"),
        lower_hex(F.col(_DIGEST)).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Of rows equal in text and id one stays."""
    return on_own_columns(docs, [id, text], [], lambda rows: _dropped(rows, id, text))


def _dropped(docs: DataFrame, id: str, text: str) -> DataFrame:
    marked, total = _digests(docs, text)
    repeated = marked.where(_MAYBE).drop(_MAYBE)
    groups = written(_groups(repeated.select(id, _DIGEST), id), "groups")
    stay = joined_to_groups(repeated, groups, [_DIGEST], "group_size", total).where(
        F.col(id).eqNullSafe(F.col("keep_id"))
    )
    several = stay.dropDuplicates([_DIGEST]).select(*docs.columns)
    return marked.where(~F.col(_MAYBE)).select(*docs.columns).unionByName(several)
