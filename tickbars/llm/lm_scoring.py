"""Language-model scoring with a log-frequency Bloom filter.

Counts of word pairs and words are gathered from the whole corpus by shuffle. Each count c is stored on a logarithmic
scale: level = 1 + floor(2 * log2(c / least)), by entering the sequence once for every level from 1 on into one Bloom
filter. A lookup probes level after level until one is missing and reads the count back as the lower bound of the last
one found. ``least`` is the smallest power of two with which there are at most ENTRIES entries, so the filter that is
broadcast never exceeds ENTRIES * BITS bits (175 MB), whatever the corpus; it is sized for the entries that there are.
All bits of a sequence are in one segment, which its hash's highest bits name. Counts are dealt by these bits too, so the
tasks that build the filter send each segment about once.

No sequence is left out: where ``least`` is above 1, those not found above level 1 (rarer, unseen, or false positives of
one level) leave their probability open, and their exact counts are joined to it.

A token's probability is Bayesian smoothed: (count(u, w) + PRIOR * p(w)) / (count(u) + PRIOR), p(w) = (count(w) + 1) /
(tokens + types + 1). Counts of frequent words (at least ``tokens / FREQUENT``, so at most FREQUENT of them) are exact and
broadcast beside the filter. Read back counts of pairs and words are lower bounds and of the word before are upper
bounds, so that a text's probabilities add up to one at most, but for the filter's rare false positives.

``base`` is exact for all words: those frequent by broadcast, all others by a join of their occurrences with the counts.
Words are compared by 64-bit hashes.

Null and empty texts have one token, the end. Rows that repeat an id are scored on their own. An empty corpus counts
nothing; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.llm.exact_dedup import _SEGMENT
from tickbars.llm.shared import written
from tickbars.llm.words import Words, mixed, slices, words_of

#: The most entries of the filter that is broadcast; sequences that do not fit are looked up by joins.
ENTRIES = 100_000_000
FREQUENT = 1 << 21
BITS = 14
PROBES = 6
PRIOR = 3000.0
#: Stand for the begin and the end of a text; no word hashes are assumed to equal them.
BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543211)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BIT, _SEVEN = np.array([128, 64, 32, 16, 8, 4, 2, 1], np.uint8), np.uint64(7)
SLICE = 2 << 20
#: Tokens that a task counts before it sends them, and sequences that it enters at once.
CHUNK = 1 << 22


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with one end per text, the token before each (or the begin), and the first token of each text."""
    texts = len(words.first) - 1
    first = words.first + np.arange(texts + 1)
    token = np.full(len(words.hashes) + texts, END)
    place = np.arange(len(words.hashes)) + words.text
    token[place] = words.hashes
    before = np.concatenate(([BEGIN], token[:-1]))[: len(token)]
    before[first[:-1]] = BEGIN
    return token, before, first


def pair_hashes(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(before * _MULTIPLIER + token)


def _counted(texts: DataFrame) -> DataFrame:
    """Rows (pair, hash, n) of all words and all pairs of a frame (text), from one reading of it."""

    def sent(held, pair):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(found), 1 << 16):
            part = slice(at, at + (1 << 16))
            columns = [pa.repeat(pair, len(found[part])), pa.array(found[part].view(np.int64)), pa.array(n[part])]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "hash", "n"])

    def counted(batches):
        words, pairs, size = [], [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                token, before, _ = tokens(words_of(part.column("text"), lower=True))
                words.append(token)
                pairs.append(pair_hashes(before, token))
                size += len(token)
                if size >= CHUNK:
                    yield from sent(words, False)
                    yield from sent(pairs, True)
                    words, pairs, size = [], [], 0
        if size:
            yield from sent(words, False)
            yield from sent(pairs, True)

    dealt = texts.mapInArrow(counted, "pair boolean, hash long, n long").withColumn("high", F.shiftrightunsigned("hash", 52))
    return dealt.repartition("high").groupBy("high", "pair", "hash").agg(F.sum("n").alias("n")).drop("high")


def levels(counts: np.ndarray, least: float) -> np.ndarray:
    return 1 + np.floor(2 * np.log2(counts / least) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray, least: float) -> np.ndarray:
    """The smallest count of a level; 0 for level 0."""
    return np.where(level > 0, np.ceil(least * 2.0 ** ((level - 1) / 2) - 1e-9), 0.0)


def segment_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The segment that has all bits of a sequence, in the order of the hashes."""
    return (hashes >> np.uint64(32)) * np.uint64(size // _SEGMENT) >> np.uint64(32)


def places(hashes: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of entries (hash, level) begin and how far apart they are, by double hashing: probe i looks at bit
    (first + i * step) of the segment, modulo its size."""
    first = mixed(hashes + np.uint64(0x632BE59BD9B4E019) * np.asarray(level, np.uint64))
    low = np.uint64(_SEGMENT - 1)
    return first & low, (first >> np.uint64(32) | np.uint64(1)) & low


@dataclass
class Model:
    tokens: int
    types: int
    least: int
    size: int
    bits: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    prior: float = PRIOR

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """The highest level up to which every level is in the filter."""
        out = np.zeros(len(hashes), np.int64)
        low, eighth = np.uint64(_SEGMENT - 1), np.uint64(3)
        left, begin = np.arange(len(hashes)), segment_of(hashes, self.size) * np.uint64(_SEGMENT // 8)
        level = 1
        while len(left):
            at, step = places(hashes, level)
            for probe in range(PROBES):
                there = (self.bits[begin + (at >> eighth)] & _BIT[at & _SEVEN]) != 0
                # Most probes of one level agree, so rows are only dropped where some have failed.
                if not there.all():
                    left, hashes, begin, at, step = left[there], hashes[there], begin[there], at[there], step[there]
                if probe + 1 < PROBES:
                    at = (at + step) & low
            out[left] = level
            level += 1
        return out

    def is_open(self, level: np.ndarray) -> np.ndarray:
        """Which levels leave the count to a join."""
        return (level <= 1) & (self.least > 1)

    def word_counts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower and upper bounds of the words' counts, which are exact and which are left to a join."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        exact = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        low = np.zeros(len(hashes))
        if exact.any():
            low[exact] = self.counts[at[exact]]
        high = low.copy()
        rest = np.flatnonzero(~exact)
        level = self.level(hashes[rest])
        low[rest] = count_of(level, self.least)
        high[rest] = count_of(level + 1, self.least)
        left = np.zeros(len(hashes), bool)
        left[rest] = self.is_open(level)
        return low, high, exact, left


def _filter_bits(entries: DataFrame, least: float, size: int) -> np.ndarray:
    """The filter of all entries (hash, n): tasks fill segments, the driver merges them."""

    def filled(held):
        hashes = np.concatenate([h for h, _ in held])
        order = np.argsort(hashes)
        hashes, n = hashes[order], np.concatenate([n for _, n in held])[order]
        segment = segment_of(hashes, size)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1, [len(hashes)]))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            many = levels(n[low:high].astype(float), least)
            owner = np.repeat(hashes[low:high], many)
            level = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
            flags = np.zeros(_SEGMENT, bool)
            place, step = places(owner, level)
            for _ in range(PROBES):
                flags[place] = True
                place = (place + step) & np.uint64(_SEGMENT - 1)
            at = np.flatnonzero(flags)
            few = 2 * len(at) < _SEGMENT // 8
            bits = at.astype("<u2").tobytes() if few else np.packbits(flags).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(segment[low])], pa.int32()), pa.array([few]), pa.array([bits], pa.binary())],
                ["segment", "few", "bits"],
            )

    def touched(batches):
        held, some = [], 0
        for batch in batches:
            held.append((batch.column("hash").to_numpy().view(np.uint64), batch.column("n").to_numpy()))
            some += batch.num_rows
            if some >= CHUNK:
                yield from filled(held)
                held, some = [], 0
        if some:
            yield from filled(held)

    bits = np.zeros(size // 8, np.uint8)
    # Written, as the driver reads one task's rows after the other.
    for row in written(entries.select("hash", "n").mapInArrow(touched, "segment int, few boolean, bits binary"), "filter").toLocalIterator():
        low = row.segment * (_SEGMENT // 8)
        own = bits[low : low + _SEGMENT // 8]
        if row.few:
            flags = np.zeros(_SEGMENT, bool)
            flags[np.frombuffer(row.bits, "<u2")] = True
            own |= np.packbits(flags)
        else:
            own |= np.frombuffer(row.bits, np.uint8)
    return bits


def least_of(octaves: dict[int, int]) -> tuple[int, int]:
    """The least count in the filter and the number of entries, given the sequences by floor(2 * log2(count))."""
    least, low = 1, 0
    while True:
        entries = sum(n * (1 + k - low) for k, n in octaves.items() if k >= low)
        if entries <= ENTRIES:
            return least, entries
        least, low = 2 * least, low + 2


def fit(corpus: DataFrame, text: str = "text") -> tuple[Model, DataFrame]:
    """The model of all texts of the corpus, and exact counts (hash, n, pair): all words', and those of the pairs whose
    count cannot be read from the filter."""
    texts = corpus.select(F.col(text).alias("text"))
    both = written(_counted(texts), "counts", "pair")
    counts, pairs = both.where("not pair").select("hash", "n"), both.where("pair").select("hash", "n")
    total = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    n, types = total.tokens or 0, total.types
    often = max(1, -(-n // FREQUENT))
    frequent = counts.where(F.col("n") >= often).toPandas()  # FREQUENT rows at most
    hashes = frequent["hash"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    stored = pairs.unionByName(counts.where(F.col("n") < often))
    octave = F.floor(2 * F.log2("n") + 1e-9).alias("octave")
    least, entries = least_of({r.octave: r.n for r in stored.groupBy(octave).agg(F.count(F.lit(1)).alias("n")).collect()})
    size = max(1, -(-entries * BITS // _SEGMENT)) * _SEGMENT
    bits = _filter_bits(stored.where(F.col("n") >= least), least, size)
    model = Model(n, types, least, size, bits, hashes[order], frequent["n"].to_numpy().astype(np.int64)[order])
    exact = counts.withColumn("pair", F.lit(False))
    if least > 1:
        above = int(count_of(np.array([2]), least)[0])
        exact = exact.unionByName(pairs.where(F.col("n") < above).withColumn("pair", F.lit(True)))
    return model, exact


#: Open are the tokens whose probability lacks a count: those at hand, and the hashes to look the others up by. For a
#: count at hand the hash is the pair's, as a frequent word would be a hot key.
OPEN = "pair:long,before:long,token:long,together:double,history:double,low:double,n:int"
PARTIAL = (
    "n_tokens long, n_known long, base_score double, score double, rare array<struct<hash:long,n:int>>, "
    f"open array<struct<{OPEN}>>"
)


def _partial(part: pa.RecordBatch, text: str, model: Model) -> list[pa.Array]:
    token, before, first = tokens(words_of(part.column(text), lower=True))
    texts = part.num_rows
    owner = np.repeat(np.arange(texts), np.diff(first))
    # Distinct tokens are looked up once a slice.
    unique, at = np.unique(token, return_inverse=True)
    low, high, exact, left = model.word_counts(unique)
    unit = np.log10((low + 1) / (model.tokens + model.types + 1))
    known = exact[at]
    base = np.bincount(owner, weights=np.where(known, unit[at], 0.0), minlength=texts)
    n_known = np.bincount(owner, weights=known & (low[at] > 0), minlength=texts).astype(np.int64)
    pairs, pair_at = np.unique(pair_hashes(before, token), return_inverse=True)
    level = model.level(pairs)
    together = count_of(level, model.least)[pair_at]
    pair_left = model.is_open(level)[pair_at]
    # The begin stands before as many tokens as there are texts, which is how often the end was seen.
    end_at = np.searchsorted(unique, END)
    previous = np.concatenate(([0], at[:-1]))[: len(at)]
    previous[first[:-1]] = end_at
    history = high[previous]
    p = (np.minimum(together, history) + model.prior * 10.0 ** unit[at]) / (history + model.prior)
    is_open = pair_left | left[previous] | left[at]
    score = np.bincount(owner, weights=np.where(is_open, 0.0, np.log10(p)), minlength=texts)
    # Open tokens, once per text and pair.
    opened = np.flatnonzero(is_open)
    if len(opened):
        _, once, times = np.unique(
            np.stack((owner[opened], pair_at[opened])), axis=1, return_index=True, return_counts=True
        )
        opened = opened[once]
    else:
        times = opened
    key = pairs[pair_at[opened]]
    before_left, token_left = left[previous[opened]], left[at[opened]]
    open_bounds = np.searchsorted(owner[opened], np.arange(texts + 1)).astype(np.int32)
    open_structs = pa.StructArray.from_arrays(
        [
            pa.array(key.view(np.int64)),
            pa.array(np.where(before_left, unique[previous[opened]], key).view(np.int64)),
            pa.array(np.where(token_left, unique[at[opened]], key).view(np.int64)),
            pa.array(together[opened], mask=pair_left[opened]),
            pa.array(history[opened], mask=before_left),
            pa.array(low[at[opened]], mask=token_left),
            pa.array(times.astype(np.int32)),
        ],
        [field.split(":")[0] for field in OPEN.split(",")],
    )
    # Occurrences of words whose exact count is not at hand, once per text and word.
    rare = np.flatnonzero(~known)
    if len(rare):
        (rare_text, rare_word), n = np.unique(np.stack((owner[rare], at[rare])), axis=1, return_counts=True)
    else:
        rare_text = rare_word = n = rare
    bounds = np.searchsorted(rare_text, np.arange(texts + 1)).astype(np.int32)
    structs = pa.StructArray.from_arrays(
        [pa.array(unique[rare_word].view(np.int64)), pa.array(n.astype(np.int32))], ["hash", "n"]
    )
    return [
        pa.array(np.diff(first)),
        pa.array(n_known),
        pa.array(base),
        pa.array(score),
        pa.ListArray.from_arrays(pa.array(bounds), structs),
        pa.ListArray.from_arrays(pa.array(open_bounds), open_structs),
    ]


def _open_scores(partial: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Rows (__row, __open): the part of the score that open tokens have, with exact counts for what they lack."""
    above = int(count_of(np.array([2]), model.least)[0])
    words = counts.where(~F.col("pair") & (F.col("n") < above))
    tokens = partial.select("__row", F.explode("open").alias("open")).select("__row", "open.*")
    for key, value, known in (
        ("pair", "together", counts.where("pair")),
        ("before", "history", words),
        ("token", "low", words),
    ):
        found = known.select(F.col("hash").alias(key), F.col("n").alias("__n"))
        value_known = F.coalesce(value, F.col("__n").cast("double"), F.lit(0.0))
        tokens = tokens.join(found, key, "left").withColumn(value, value_known).drop("__n", key)
    unit = (F.col("low") + 1) / F.lit(float(model.tokens + model.types + 1))
    together = F.least("together", "history")
    p = (together + F.lit(model.prior) * unit) / (F.col("history") + F.lit(model.prior))
    return tokens.groupBy("__row").agg(F.sum(F.col("n") * F.log10(p)).alias("__open"))


def with_scores(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text", carry: list[str] = ()) -> DataFrame:
    """The carried columns with n_tokens, n_known, train_tokens, base_score and score."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in T._parse_datatype_string(PARTIAL).fields]

    def rows(batches):
        for batch in batches:
            for part in slices(batch, text, SLICE):
                columns = [part.column(n) for n in ("__row", *carry)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *_partial(part, text, known.value)], ["__row", *carry, *names]
                )

    source = docs.select(F.monotonically_increasing_id().alias("__row"), *carry, text)
    kept = [f for f in source.schema.fields if f.name in ("__row", *carry)]
    kept.sort(key=lambda f: ("__row", *carry).index(f.name))
    # Written once, so that a row's number is the same wherever it is read.
    partial = written(
        source.mapInArrow(rows, T.StructType([*kept, *T._parse_datatype_string(PARTIAL).fields])), "scored"
    )
    rare = partial.select("__row", F.explode("rare").alias("rare")).select("__row", "rare.hash", F.col("rare.n").alias("times"))
    # No hot words here: each has less than 1 / FREQUENT of all tokens, or was never seen.
    count = F.coalesce("n", F.lit(0))
    unit = F.log10((count + 1) / F.lit(float(model.tokens + model.types + 1)))
    sums = (
        rare.join(counts.where(~F.col("pair")), "hash", "left")
        .groupBy("__row")
        .agg(
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("__known"),
            F.sum(F.col("times") * unit).alias("__base"),
        )
    )
    score = F.col("score")
    if model.least > 1:
        sums = sums.join(_open_scores(partial, model, counts), "__row", "full")
        score = score + F.coalesce("__open", F.lit(0.0))
    return partial.join(sums, "__row", "left").select(
        *carry,
        "n_tokens",
        (F.col("n_known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("__base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
    )

