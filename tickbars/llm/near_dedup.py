"""MinHash near-dedup with tensored banding.

A document's set holds the hashes of its distinct word pairs (or of its only word). Two collections of ``HALVES`` short
signatures are computed, each signature of ``ROWS`` minimum hashes; a table key is one signature of the first collection
together with one of the second, so 2 x HALVES x ROWS = 40 minimum hashes make HALVES^2 = 100 tables of 2 x ROWS hashes,
where independent tables would take 400. A pair of similarity s shares a table unless all signatures of one collection
differ: 1 - (1 - (1 - s^2)^10)^2, at s = 0.8 less than 1 in 10,000, at 0.85 less than 1 in 180,000.

Documents with equal sets form a class, and only classes go on. In each table's bucket all members are compared with one
hub, the smallest; that settles the bucket unless members remain in different components, then another hub follows.
What is left after ``HUB_ROUNDS`` is compared between components: pair by pair in small buckets, except where distances
to a hub rule a link out (distance is a metric: members whose distances to a hub differ by more than 0.2 are no link),
block by block in large ones. Nothing is capped. Every candidate is confirmed on the full sets of both texts:
100 * common >= 80 * union.

Null and empty texts have empty sets, link with nothing and stay. Rows that share an id are one document: where their
texts have different sets, each is compared by itself, and what is near to any of them is in the document's component.
Rows without an id are not compared; their component is null and they stay. Ties cannot matter: a component is named by its smallest id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.shared import joined_to_groups, written
from tickbars.llm.words import Words, _random, mixed, slices, words_of

WORDS_PER_SHINGLE = 5
SIMILARITY = 80
HALVES, ROWS = 10, 2
HUB_ROUNDS = 1
#: Buckets up to this size are compared pair by pair after the hub rounds, larger ones by blocks of documents.
SMALL = 32
BLOCK = 128
_SEEDS = _random(2 * HALVES * ROWS, 1 << 42)
_FACTORS = _random(2 * HALVES * ROWS, 1 << 43) | np.uint64(1)
SKETCH = "id long, n_shingles long, a long, b long, signatures array<long>"


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text: text numbers and hashes, ordered by both.

    A text of fewer than k words, but some, has its whole sequence as its one shingle.
    """
    full = np.flatnonzero(words.can_start(k))
    texts, hashes = words.text[full], words.sequences(k)[full]
    for n in range(1, k):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            texts = np.concatenate((texts, short))
            hashes = np.concatenate((hashes, mixed(words.sequences(n)[words.first[short]] + np.uint64(n))))
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    return texts[new], hashes[new]


def _sketched(docs: DataFrame, k: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                yield _sketch(part, k)

    return docs.mapInArrow(rows, SKETCH)


def _sketch(part: pa.RecordBatch, k: int) -> pa.RecordBatch:
    words = words_of(part.column("text"), lower=True)
    texts, hashes = shingles(words, k)
    sizes = np.bincount(texts, minlength=part.num_rows)
    has = np.flatnonzero(sizes)
    at = np.searchsorted(texts, has)
    names = np.zeros((2, part.num_rows), np.uint64)
    lowest = np.zeros((len(_SEEDS), len(has)), np.uint64)
    if len(has):
        names[0, has] = np.add.reduceat(mixed(hashes), at)
        names[1, has] = np.add.reduceat(mixed(hashes ^ _SEEDS[0]), at)
        for i, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS, strict=True)):
            values = (hashes ^ seed) * factor
            lowest[i] = np.minimum.reduceat(values ^ (values >> np.uint64(32)), at)
    # Each signature combines ROWS minimum hashes.
    signatures = np.zeros((2 * HALVES, len(has)), np.uint64)
    for i in range(ROWS):
        signatures = mixed(signatures + lowest[i::ROWS])
    lengths = np.where(sizes > 0, 2 * HALVES, 0)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            part.column("id"),
            pa.array(sizes.astype(np.int64)),
            pa.array(names[0].view(np.int64)),
            pa.array(names[1].view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(signatures.T.ravel().view(np.int64))),
        ],
        ["id", "n_shingles", "a", "b", "signatures"],
    )


def _table_keys(sketches: DataFrame) -> DataFrame:
    """One row per representative and table: key and id."""
    cell = F.explode(F.sequence(F.lit(0), F.lit(HALVES * HALVES - 1))).alias("cell")
    first = F.get("signatures", F.floor(F.col("cell") / HALVES).cast("int"))
    second = F.get("signatures", (HALVES + F.col("cell") % HALVES).cast("int"))
    return sketches.select("id", "signatures", cell).select(F.xxhash64("cell", first, second).alias("key"), "id")


def _compared(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Pairs (hub, id) with ``common`` and ``total``, the sizes of their sets' intersection and union."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                mine = shingles(words_of(part.column("text"), lower=True), k)
                other = shingles(words_of(part.column("hub_text"), lower=True), k)
                pair, hashes = (np.concatenate(x) for x in zip(mine, other, strict=True))
                order = np.lexsort((hashes, pair))
                pair, hashes = pair[order], hashes[order]
                twice = np.flatnonzero((pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1]))
                common = np.bincount(pair[twice], minlength=part.num_rows)
                total = np.bincount(pair, minlength=part.num_rows) - common
                yield pa.RecordBatch.from_arrays(
                    [part.column("hub"), part.column("id"), pa.array(common), pa.array(total)],
                    ["hub", "id", "common", "total"],
                )

    hubs = texts.select(F.col("id").alias("hub"), F.col("text").alias("hub_text"))
    # The join on the member comes first: members spread out, and Spark may split a hub with many of them.
    both = pairs.join(texts, "id").join(hubs, "hub").select("hub", "id", "text", "hub_text")
    return both.mapInArrow(rows, "hub long, id long, common long, total long")


def linked(docs: DataFrame, sketches: DataFrame, groups: DataFrame, k: int, similarity: int) -> DataFrame:
    """Rows (node, root) of the representatives that are not the smallest of their component."""
    representatives = sketches.join(groups.select(F.col("rep").alias("id"), "a", "b"), ["id", "a", "b"], "left_semi")
    keys = _table_keys(representatives)
    buckets = keys.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = groups.count() * HALVES * HALVES
    open_ = written(joined_to_groups(keys, written(buckets, "buckets"), ["key"], "n", rows), "members")
    texts = written(
        docs.join(open_.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "texts"
    )
    done, links, roots = None, None, None
    for _ in range(HUB_ROUNDS):
        pairs = open_.where("id <> hub").select("hub", "id").distinct()
        if done is not None:
            pairs = pairs.join(done.select("hub", "id"), ["hub", "id"], "left_anti")
        new = written(_compared(written(pairs, "pairs"), texts, k), "compared")
        done = new if done is None else done.unionByName(new)
        links = _joined_edges(roots, _links(new, similarity))
        roots = components(links)
        open_ = _still_open(open_, done, roots)
        if open_.isEmpty():
            return roots
    new = written(_compared(written(_cross_pairs(open_, similarity), "pairs"), texts, k), "compared")
    cells = _in_cells(open_.where(F.col("n") > SMALL), texts, k, similarity)
    return components(_joined_edges(roots, _links(new, similarity).unionByName(cells)))


def _links(compared: DataFrame, similarity: int) -> DataFrame:
    close = F.col("common") * 100 >= F.col("total") * similarity
    return compared.where(close).select(F.col("id").alias("u"), F.col("hub").alias("v"))


def _joined_edges(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components found so far stand for the links that made them."""
    return links if roots is None else links.unionByName(roots.toDF("u", "v"))


def _still_open(open_: DataFrame, done: DataFrame, roots: DataFrame) -> DataFrame:
    """Members but the hub just used, of buckets that still hold several components: with the distance to that hub, the
    component, the number of members left, and the next hub."""
    distance = 1 - F.col("common") / F.col("total")
    rows = open_.where("id <> hub").select("key", "id", "hub")
    rows = rows.join(done.select("hub", "id", distance.alias("distance")), ["hub", "id"])
    rows = rows.join(roots, F.col("id") == F.col("node"), "left").select(
        "key", "id", "distance", F.coalesce("root", "id").alias("root")
    )
    rows = written(rows, "open")
    several = rows.groupBy("key").agg(
        F.min("id").alias("hub"), F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    )
    left = joined_to_groups(rows, several.where("low <> high").drop("low", "high"), ["key"], "n", rows.count())
    return written(left, "open")


def _cross_pairs(open_: DataFrame, similarity: int) -> DataFrame:
    """Pairs of a small bucket in different components whose distances to the last hub leave a link possible."""
    near = 1 - similarity / 100 + 1e-9
    small = open_.where(F.col("n") <= SMALL)
    a, b = small.alias("a"), small.alias("b")
    pairs = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.root") != F.col("b.root"))
        & (F.abs(F.col("a.distance") - F.col("b.distance")) <= near),
    )
    return pairs.select(F.col("a.id").alias("hub"), F.col("b.id").alias("id")).distinct()


def _in_cells(open_: DataFrame, texts: DataFrame, k: int, similarity: int) -> DataFrame:
    """Links between different components among the members of large buckets, found without a row per pair.

    Members that share large buckets form a cluster, which is dealt into blocks of about ``BLOCK`` documents; a task gets
    two blocks and compares their sets with each other, one matrix product at a time. The cluster's largest component is
    dealt apart from the rest and is not compared with itself. A task gives no more links than join its documents.
    """
    cluster = components(open_.select(F.col("id").alias("u"), F.col("hub").alias("v"))).toDF("node", "cluster")
    members = open_.select("id", "root").distinct().join(cluster, F.col("id") == F.col("node"), "left")
    members = written(members.select("id", "root", F.coalesce("cluster", "id").alias("cluster")), "cluster")
    sizes = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(
        sizes.groupBy("cluster").agg(
            F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n")
        ),
        "clusters",
    )
    total = members.count()
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    dealt = joined_to_groups(members, sizes, ["cluster"], "n", total).select(
        "id",
        "root",
        "cluster",
        (F.col("root") == F.col("main")).alias("is_main"),
        blocks(F.col("most")).alias("mains"),
        blocks(F.col("n") - F.col("most")).alias("others"),
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))))
    number = F.when(F.col("is_main"), F.col("others") + F.col("block")).otherwise(F.col("block"))
    partner = F.explode(
        F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("others") - 1)).otherwise(
            F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1)
        )
    )
    cells = dealt.select("id", "root", "cluster", number.alias("own"), partner.alias("partner")).join(texts, "id")
    cells = cells.select(
        "cluster",
        F.least("own", "partner").alias("low"),
        F.greatest("own", "partner").alias("high"),
        "id",
        "root",
        "own",
        "text",
    )

    def found(cell: pd.DataFrame) -> pd.DataFrame:
        sets = shingles(words_of(pa.array(cell["text"], pa.large_string()), lower=True), k)
        left = (cell["own"] == cell["low"]).to_numpy()
        right = (cell["own"] == cell["high"]).to_numpy()
        pairs = close_pairs(*sets, np.flatnonzero(left), np.flatnonzero(right), similarity)
        roots = cell["root"].to_numpy()
        parts = {}
        out = []
        for u, v in pairs:
            a, b = _top(parts, roots[u]), _top(parts, roots[v])
            if a != b:
                parts[max(a, b)] = min(a, b)
                out.append((cell["id"].iat[u], cell["id"].iat[v]))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    return written(cells.groupBy("cluster", "low", "high").applyInPandas(found, "u long, v long"), "cells")


def _top(parents: dict, x: int) -> int:
    while x in parents:
        x = parents[x]
    return x


def close_pairs(
    texts: np.ndarray, hashes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: int
) -> list[tuple[int, int]]:
    """Pairs of a left and a right document whose sets, given by document number and hash, reach the similarity."""
    n = int(max(left.max(initial=-1), right.max(initial=-1), texts.max(initial=-1))) + 1
    sizes = np.bincount(texts, minlength=n).astype(np.int64)
    _, column = np.unique(hashes, return_inverse=True)
    order = np.argsort(column, kind="stable")
    texts, column = texts[order], column[order]
    common = np.zeros((len(left), len(right)), np.int64)
    width = 1 << 13
    for low in range(0, int(column.max(initial=-1)) + 1, width):
        at = slice(*np.searchsorted(column, (low, low + width)))
        has = np.zeros((n, width), np.float32)
        has[texts[at], column[at] - low] = 1
        common += (has[left] @ has[right].T).astype(np.int64)
    total = sizes[left][:, None] + sizes[right][None, :] - common
    close = (100 * common >= similarity * total) & (total > 0)
    return [(int(left[i]), int(right[j])) for i, j in np.argwhere(close) if left[i] != right[j]]


def mark_near_copies(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = WORDS_PER_SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """One row per row: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = written(_sketched(texts, k), "sketches")
    in_sets = sketches.where("id is not null and n_shingles > 0")
    twofold = written(
        in_sets.groupBy("id").agg(F.min(F.struct("a", "b")).alias("low"), F.max(F.struct("a", "b")).alias("high"))
        .where("low <> high").select("id"),
        "twofold",
    )
    if twofold.isEmpty():
        marked = _components_of_sets(texts.where("id is not null"), in_sets, k, similarity)
    else:
        marked = _components_of_twofold(texts.where("id is not null"), in_sets, twofold, k, similarity)
    alone = sketches.where("id is null or n_shingles = 0").withColumn("component_id", F.col("id"))
    columns = ["id", "n_shingles", "component_id"]
    rows = marked.select(*columns).unionByName(alone.select(*columns))
    return rows.select(
        F.col("id").alias(id), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _components_of_sets(
    texts: DataFrame, in_sets: DataFrame, k: int, similarity: int, same: DataFrame | None = None
) -> DataFrame:
    """The sketches with their component_id, the smallest id. ``same`` are pairs (u, v) of ids that belong together."""
    groups = written(
        in_sets.groupBy("a", "b").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "groups"
    )
    roots = linked(texts, in_sets, groups, k, similarity)
    if same is not None:
        # Of an id, its class's representative is what has links.
        rep = written(in_sets.join(groups, ["a", "b"]).select("id", "rep"), "reps")
        known = same.join(rep.toDF("u", "x"), "u").join(rep.toDF("v", "y"), "v")
        roots = components(_joined_edges(roots, known.select(F.col("x").alias("u"), F.col("y").alias("v"))))
    named = groups.join(roots, F.col("rep") == F.col("node"), "left").select(
        "a", "b", "n", F.coalesce("root", "rep").alias("component_id")
    )
    total = in_sets.count()
    return joined_to_groups(in_sets.select("id", "n_shingles", "a", "b"), written(named, "named"), ["a", "b"], "n", total)


def _components_of_twofold(
    texts: DataFrame, in_sets: DataFrame, twofold: DataFrame, k: int, similarity: int
) -> DataFrame:
    """The same where some ids have several sets: each of their rows goes under a number of its own beyond all ids."""
    beyond = in_sets.agg(F.max("id")).first()[0] + 1
    own = written(
        texts.join(twofold, "id", "left_semi").withColumn("node", F.lit(beyond) + F.monotonically_increasing_id()), "twofold"
    )
    if own.agg(F.min("node")).first()[0] < beyond:
        raise OverflowError("no numbers are left beyond the ids")
    numbered = own.select(F.col("node").alias("id"), "text")
    single = in_sets.join(twofold, "id", "left_anti")
    sketches = written(single.unionByName(_sketched(numbered, k).where("n_shingles > 0")), "sketches")
    used = own.join(sketches.select(F.col("id").alias("node")), "node", "left_semi").select("id", "node")
    same = used.join(used.groupBy("id").agg(F.min("node").alias("v")), "id").select(F.col("node").alias("u"), "v")
    texts = texts.join(twofold, "id", "left_anti").unionByName(numbered)
    marked = written(_components_of_sets(texts, sketches, k, similarity, same), "marked")
    # Back to the ids; a component that has such numbers is named by the smallest id of all its members.
    names = used.withColumnRenamed("id", "real")
    marked = marked.join(names, F.col("id") == F.col("node"), "left").withColumn("id", F.coalesce("real", "id"))
    touched = marked.where(F.col("real").isNotNull()).select("component_id").distinct()
    renamed = marked.join(touched, "component_id", "left_semi").groupBy("component_id").agg(F.min("id").alias("smallest"))
    return marked.join(renamed, "component_id", "left").withColumn("component_id", F.coalesce("smallest", "component_id"))


def drop_near_copies(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stay, one document of each group, with all their columns."""
    dropped = mark_near_copies(docs, id=id, text=text, **options).where("not kept").select(id).distinct()
    return docs.join(dropped, id, "left_anti")
