"""Token counts of a sentencepiece BPE model, counted once per distinct pre-token.

The model merges neighbouring symbols only into pieces it has. If no piece holds a space mark behind another character,
no merge crosses the start of a run of spaces; if a character is in no longer piece, no merge crosses its sides. Texts
are cut there, into pre-tokens: a run of spaces or of such barrier characters with what follows it. A text's tokens are
then exactly those of its pre-tokens. ``Vocabulary`` derives the cuts from the model and refuses one that gives none.

1. Tasks combine their pre-tokens; a shuffle gives every distinct one its frequency, and the library its tokens, once.
2. Pre-tokens met at least ``least`` times are broadcast, as hashes and counts: ``least`` is the smallest power of two,
   from 2 on, that at most ``MOST_BROADCAST`` of them reach, whatever the corpus. A hash that two distinct pre-tokens of
   the corpus share is left out, so a lookup by hash is exact.
3. A task multiplies a document's frequencies of these with their counts. Other pre-tokens, each met fewer than ``least``
   times, travel as rows (row, pre-token, frequency) to a join with the counts. No ids are made anywhere.

Null and empty texts have no tokens. Rows that repeat an id are counted on their own. An empty table gives no rows. Other
columns are not looked at, those asked for are carried.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.shared import on_own_columns, written
from tickbars.llm.words import Words, contains, ranges, slices

#: At most so many pre-tokens are broadcast, with 12 bytes each.
MOST_BROADCAST = 1 << 21
LIMIT = 4096
MARK = "▁"
SLICE = 2 << 20
#: Pre-tokens that a task combines before it sends them.
CHUNK = 1 << 22
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)


@dataclass
class Vocabulary:
    """A model's bytes and the ASCII characters (``barriers``) that no merge takes in."""

    model: bytes
    barriers: np.ndarray

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        numbers = range(library.get_piece_size())
        pieces = [library.id_to_piece(i) for i in numbers if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        probe = "  a  b ﬁ½Å　\t▁ "
        if library.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts before it cuts them")
        if sum(library.is_byte(i) for i in numbers) != 256:
            raise ValueError("the model has no byte pieces: neighbouring unknown characters would be one token")
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("the model has pieces with a space inside: texts cannot be cut at spaces")
        if MARK not in pieces:
            raise ValueError("the model has no piece for a space")
        inside = {c for piece in pieces if len(piece) > 1 for c in piece}
        barriers = np.array([i < 128 and chr(i) not in inside and chr(i) != " " for i in range(256)])
        return cls(model, barriers)

    def pre_tokens(self, column: pa.Array) -> Words:
        """The pre-tokens of some texts, as byte ranges; a text that is not empty starts with the space put before it."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        texts = pc.fill_null(column, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], 0x20)
        offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
        space, barrier = data == 0x20, self.barriers[data]
        begins = np.zeros(len(data), bool)
        ends_space = space.copy()
        marks = data[:-2] == _MARK_BYTES[0]
        marks &= (data[1:-1] == _MARK_BYTES[1]) & (data[2:] == _MARK_BYTES[2])
        space[:-2] |= marks
        ends_space[2:] |= marks
        begins[1:] = (space[1:] & ~ends_space[:-1]) | (barrier[1:] & ~barrier[:-1])
        begins[offsets[:-1][filled]] = True
        starts = np.flatnonzero(begins)
        return Words(data, offsets, starts, np.append(starts[1:], len(data)) if len(starts) else starts, np.searchsorted(starts, offsets))

    def counts(self, pre_tokens: Iterable[str], library: sentencepiece.SentencePieceProcessor) -> np.ndarray:
        """The tokens of each pre-token. The library puts a space before every text: it stands for a leading space; before
        a barrier it stays a token of its own, which does not count."""
        plain = [pre_token.replace(MARK, " ") for pre_token in pre_tokens]
        spaced = np.array([text.startswith(" ") for text in plain], bool)
        alone = np.array([text == " " for text in plain], bool)
        ids = library.encode([text[1:] if text.startswith(" ") else text for text in plain], num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, len(plain))
        return np.where(alone, 1, np.where(spaced, lengths, lengths - 1))


def _library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _strings(words: Words, which: np.ndarray) -> pa.Array:
    """Some pre-tokens as an Arrow column."""
    lengths = words.ends[which] - words.starts[which]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    data = words.data[ranges(words.starts[which], lengths)]
    return pa.Array.from_buffers(pa.large_string(), len(which), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def distinct_pre_tokens(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (token, n) of a frame (text): every distinct pre-token and how often the texts have it."""

    def combined(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        hashes, n, tokens = (list(x) for x in zip(*held, strict=True))
        hashes, n, tokens = np.concatenate(hashes), np.concatenate(n), pa.concat_arrays(tokens)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(which, n).astype(np.int64)
        for at in range(0, len(first), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([tokens.take(pa.array(first[part])).cast(pa.string()), pa.array(total[part])], ["token", "n"])

    def counted(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = vocabulary.pre_tokens(part.column("text"))
                found, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                held.append((found, n, _strings(words, first)))
                size += len(words.starts)
                if size >= CHUNK:
                    yield from combined(held)
                    held, size = [], 0
        if held:
            yield from combined(held)

    return texts.mapInArrow(counted, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def with_counts(distinct: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (token, n) with the tokens of each pre-token and its hash."""

    def counted(batches):
        library = _library(vocabulary.model)
        for batch in batches:
            for part in slices(batch, "token", SLICE):
                token = part.column("token")
                whole = pc.cast(token, pa.large_string())
                _, offsets, data = whole.buffers()
                offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
                words = Words(np.frombuffer(data, np.uint8), offsets, offsets[:-1], offsets[1:], np.arange(len(whole) + 1))
                columns = [token, part.column("n"), pa.array(words.hashes.view(np.int64)), pa.array(vocabulary.counts(token.to_pylist(), library))]
                yield pa.RecordBatch.from_arrays(columns, ["token", "n", "hash", "pieces"])

    return distinct.mapInArrow(counted, "token string, n long, hash long, pieces long")


@dataclass
class Frequent:
    """Ordered hashes of the frequent pre-tokens and the tokens of each."""

    least: int
    hashes: np.ndarray
    pieces: np.ndarray
    #: Hashes that two pre-tokens share, one of them frequent.
    shared: list[int]


def frequent(counts: DataFrame, most: int = MOST_BROADCAST) -> Frequent:
    """Those met ``least`` times or more, without hashes that two pre-tokens share. Those met once are never among them,
    whatever the size of the corpus."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().where("level > 0").collect()
    left, least = sum(row["count"] for row in sizes), 2
    for row in sorted(sizes):
        if left <= most:
            break
        left, least = left - row["count"], 2 << row["level"]
    table = counts.where(F.col("n") >= least).select("hash", "pieces").toArrow()
    hashes = table.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, pieces = hashes[order], table.column("pieces").to_numpy()[order].astype(np.int32)
    known = counts.sparkSession.sparkContext.broadcast(hashes)

    def also_there(batches):
        for batch in batches:
            rare = batch.column("hash").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(rare[contains(known.value, rare.view(np.uint64))])], ["hash"])

    rare = counts.where(F.col("n") < least).select("hash").mapInArrow(also_there, "hash long").distinct().toArrow()
    known.unpersist()
    shared = np.union1d(rare.column("hash").to_numpy().view(np.uint64), hashes[1:][hashes[1:] == hashes[:-1]])
    single = ~contains(shared, hashes)
    return Frequent(least, hashes[single], pieces[single], shared.view(np.int64).tolist())


def count_tokens(docs: DataFrame, model: bytes, carry: list[str], text: str = "text", limit: int = LIMIT, most: int = MOST_BROADCAST) -> DataFrame:
    """The carried columns of every row with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``model`` is the content of the model file, ``most`` the number of pre-tokens that may be broadcast. A carried column
    that is named like an added one is replaced by it. Texts themselves are not carried: the rows are written on the way.
    """
    if text in carry:
        raise ValueError("texts are not carried")
    added = ["n_bytes", "n_tokens", "over_limit"]
    counted = on_own_columns(docs.select(*dict.fromkeys([*carry, text])), [text], added, lambda rows: _counted(rows, model, text, limit, most))
    return counted.select(*[name for name in carry if name not in added], *added)


def _counted(docs: DataFrame, model: bytes, text: str, limit: int, most: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = Vocabulary.of(model)
    counts = written(with_counts(distinct_pre_tokens(docs.select(F.col(text).alias("text")), vocabulary), vocabulary), "pre-tokens")
    known = spark.sparkContext.broadcast(frequent(counts, most))
    carried = [field for field in docs.schema.fields if field.name != text]
    own = ["__row", "n_bytes", "known", "token", "freq"]
    keep = [field.name for field in carried]

    def summed(batches):
        table = known.value
        for batch in batches:
            for part in slices(batch, "__text", SLICE):
                words = vocabulary.pre_tokens(part.column("__text"))
                found, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
                at = np.searchsorted(table.hashes, found)
                at[at == len(table.hashes)] = 0
                there = table.hashes[at] == found if len(table.hashes) else np.zeros(len(found), bool)
                pieces = np.where(there, table.pieces[at], 0) if len(table.hashes) else np.zeros(len(found), np.int64)
                size = pc.fill_null(pc.binary_length(part.column("__text")), 0).cast(pa.int64())
                nothing = [pa.nulls(part.num_rows, pa.string()), pa.nulls(part.num_rows, pa.int64())]
                yield part.select(keep + ["__row"]), [size, pa.array(words.per_text(pieces[which]).astype(np.int64)), *nothing]
                rest = np.flatnonzero(~there[which])
                if len(rest):
                    # One row per document and pre-token: its frequency there.
                    pair, n = np.unique(words.text[rest] * len(found) + which[rest], return_counts=True)
                    rows, token = pa.array(pair // len(found)), _strings(words, first[pair % len(found)]).cast(pa.string())
                    blank = [pa.nulls(len(n), part.schema.field(name).type) for name in keep]
                    whole = pa.RecordBatch.from_arrays([*blank, part.column("__row").take(rows)], keep + ["__row"])
                    yield whole, [pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64()), token, pa.array(n)]

    def rows(batches):
        for left, right in summed(batches):
            yield pa.RecordBatch.from_arrays([*left.columns, *right], keep + own)

    schema = T.StructType([*carried, *[T.StructField(name, T.StringType() if name == "token" else T.LongType()) for name in own]])
    source = docs.select(*keep, F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text"))
    parts = written(source.mapInArrow(rows, schema), "counted")
    # Beside the rare ones, those of a hash that two share: none, but for a collision of 64 bits.
    rare = counts.where((F.col("n") < known.value.least) | F.col("hash").isin(known.value.shared)).select("token", "pieces")
    rest = parts.where(F.col("token").isNotNull()).select("__row", "token", "freq").join(rare, "token")
    rest = rest.groupBy("__row").agg(F.sum(F.col("freq") * F.col("pieces")).alias("rest"))
    total = F.col("known") + F.coalesce("rest", F.lit(0))
    whole = parts.where(F.col("token").isNull()).join(rest, "__row", "left").withColumn("n_tokens", total)
    return whole.withColumn("over_limit", F.col("n_tokens") > limit).select(*keep, F.lit(None).cast("string").alias(text), "n_bytes", "n_tokens", "over_limit")

