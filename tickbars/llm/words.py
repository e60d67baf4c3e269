"""Whole texts as numpy arrays of words: boundaries, word hashes and hashes of word sequences.

Everything works on the UTF-8 bytes of an Arrow string column, so a batch costs a few passes over its bytes and no Python
object per word. Texts are handled in slices of about ``SLICE_BYTES``; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_ALL = np.arange(256)
#: Words between white space: ``[^\x20\x09-\x0D]+``.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Words of ASCII letters and digits and all other characters: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
ALPHANUMERIC = (_ALL >= 0x80) | np.isin(_ALL, np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8))
#: Bytes with A-Z lower-cased.
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _random(n: int, seed: int) -> np.ndarray:
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * _MULTIPLIER)


_BYTE_VALUES = _random(256, 1 << 40)
_POSITION_VALUES = _random(1 << 12, 1 << 41) | np.uint64(1)


def _positions(n: int) -> np.ndarray:
    global _POSITION_VALUES
    if n > len(_POSITION_VALUES):
        _POSITION_VALUES = _random(2 * n, 1 << 41) | np.uint64(1)
    return _POSITION_VALUES


@dataclass
class Words:
    """The words of some texts: word i is ``data[starts[i]:ends[i]]``, text d has words ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @cached_property
    def last(self) -> np.ndarray:
        """The end of the text that each word is in, as a word number."""
        return np.repeat(self.first[1:], self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words' bytes: a sum of byte value times position value, then mixed."""
        return self.hashes_of(self.data)

    def hashes_of(self, data: np.ndarray) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        at = np.cumsum(lengths) - lengths
        position = np.arange(lengths.sum()) - np.repeat(at, lengths)
        source = position + np.repeat(self.starts, lengths)
        terms = _BYTE_VALUES[data[source]] * _positions(int(lengths.max()) + 1)[position]
        return mixed(np.add.reduceat(terms, at) + lengths.astype(np.uint64))

    def can_start(self, n: int) -> np.ndarray:
        """Whether n words of one text start at each word."""
        return np.arange(len(self.starts)) + n <= self.last

    def sequences(self, n: int) -> np.ndarray:
        """The hash of the n words from each word on; where ``can_start`` is false the value means nothing."""
        return sequence_hashes(self.hashes, n)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """The sum over each text of values given per word."""
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.first[1:]] - total[self.first[:-1]]


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(hashes), np.uint64)
    for i in range(n):
        out *= _MULTIPLIER
        out[: max(len(hashes) - i, 0)] += hashes[i:]
    return mixed(out)


def words_of(column: pa.Array, word_bytes: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Split an Arrow string column; null is a text without words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, offsets, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths + 64) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(low, high - low)


def contains(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def ranges(lows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``low, low + 1, ...`` of the given lengths, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(lows - before, lengths)


def segments_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values, by doubling; as long as ``values``, the tail is padded."""
    best, have = values, 1
    pad = np.uint64(0xFFFFFFFFFFFFFFFF)
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best, np.concatenate((best[step:], np.full(min(step, len(best)), pad))))
        have += step
    return best
