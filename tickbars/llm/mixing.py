"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target, a number of words: its weight's part of all words, held to ``MOST_COPIES`` times the source's
own words, the excess shared again by weight. A document's expected copies are the target over the source's words. The
whole part of that is certain: so many copies of every document. The rest is an unequal-probability sample of fixed
size: each document draws a uniform number u from its id and is ranked by the odds u / (1 - u) divided by its inclusion
odds p / (1 - p), and documents are taken in rank order until the words still missing are reached (the last one if at
least half of it fits). So each source's words differ from its target by half a document at most.

The ranking never puts a source into one task. Ranks are counted into bins per source (sums of words, combined before
the shuffle), a running sum over the bins finds the one that holds the cut, and only that bin's documents are ordered,
which gives one cut rank per source. Each document then decides for itself; the bins grow with the square root of the
rows. Without ``weight`` all documents of a source have the same inclusion odds; with it, expected copies are
proportional to the weight within the source, up to MOST_COPIES.

Null and empty texts have size 0 and are never copied. Rows that repeat one id draw the same number and share a fate. A
null source is a source of its own. An empty table gives an empty mix. The same input and seed give the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.shared import joined_to_groups, on_own_columns, written

MOST_COPIES = 3
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
_KEY, _SIZE, _DRAW, _RANK, _BIN, _SHARE = "__key", "__size", "__draw", "__rank", "__bin", "__share"
_EXPECTED, _WHOLE, _ROWS = "__expected", "__whole", "__rows"

ADDED = ["size", "source_size", "target", "copies", "taken"]


def source_key(source: Column) -> Column:
    """A text that is never null, ordered as the sources are by code point with null last."""
    return F.coalesce(F.concat(F.lit("a"), source), F.lit("b"))


def draw(id: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def shared_out(items: DataFrame, total: int, cap: str, weight: str, share: str) -> DataFrame:
    """Share a total by weight, no item above its cap and the excess shared again among the others.

    The level ``total not yet capped / weight not yet capped`` only rises and ends after as many rounds as it caps
    anything new; each round is one sum over the items.
    """
    level = (0, 1)
    while True:
        at_cap = F.lit(float(level[0])) * F.col(weight) / F.lit(float(level[1])) >= F.col(cap)
        row = items.agg(
            F.sum(F.when(at_cap, F.col(cap))).alias("capped"),
            F.sum(F.when(~at_cap, F.col(weight))).alias("free"),
        ).first()
        if not row.free:
            return items.withColumn(share, F.col(cap).cast("double"))
        risen = (total - (row.capped or 0), row.free)
        if risen == level:
            portion = F.lit(float(level[0])) * F.col(weight) / F.lit(float(level[1]))
            return items.withColumn(share, F.least(portion, F.col(cap).cast("double")))
        level = risen


def mix(
    docs: DataFrame,
    weights: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The rows of docs with size, source_size, target, copies and taken (words, repeats counted).

    ``weights`` has one row per source: ``source`` and an integer ``weight``; a source without one gets nothing. The
    optional column ``weight`` of docs (0 or more, null is 0) makes documents of one source unequally likely. Columns of
    docs that are named like the new ones are replaced by them.
    """
    used = [id, text, source, *([weight] if weight else [])]
    return on_own_columns(docs, used, ADDED, lambda rows: _mixed(rows, weights, id, text, source, weight, seed))


def _mixed(
    docs: DataFrame, weights: DataFrame, id: str, text: str, source: str, weight: str | None, seed: int
) -> DataFrame:
    sized = docs.withColumn(_SIZE, F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))
    sized = sized.withColumn(_KEY, source_key(F.col(source))).withColumn(_DRAW, draw(F.col(id), seed))
    own = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)
    slim = written(sized.select(F.col(id), _KEY, _SIZE, _DRAW, own.alias(_SHARE)), "sizes")

    sizes = slim.groupBy(_KEY).agg(F.sum(_SIZE).alias("source_size"), F.count(F.lit(1)).alias(_ROWS))
    weighed = weights.select(source_key(F.col("source")).alias(_KEY), F.col("weight").cast("long").alias("__weight"))
    sources = written(
        sizes.join(weighed, _KEY, "left")
        .withColumn("__weight", F.coalesce("__weight", F.lit(0)))
        .withColumn("__cap", F.col("source_size") * MOST_COPIES),
        "sources",
    )
    counted = sources.agg(F.sum("source_size").alias("words"), F.sum(_ROWS).alias("rows")).first()
    total, rows = counted.words or 0, counted.rows or 0
    targets = shared_out(sources, total, "__cap", "__weight", "target")
    if weight:
        targets = targets.join(_copies_per_weight(slim, targets, rows), _KEY, "left")
    else:
        targets = targets.withColumn("__per_weight", F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    targets = written(targets, "targets")

    def ranked(rows_of: DataFrame, share: Column) -> DataFrame:
        """Expected copies, their whole part and the rank of the rest."""
        expected = F.least(F.coalesce(F.col("__per_weight") * share, F.lit(0.0)), F.lit(float(MOST_COPIES)))
        left = F.col(_EXPECTED) - F.col(_WHOLE)
        win, lose = F.col(_DRAW) * (1 - left), left * (1 - F.col(_DRAW))
        return (
            rows_of.withColumn(_EXPECTED, expected)
            .withColumn(_WHOLE, F.floor(_EXPECTED))
            # odds(u) / odds(p) = x as x / (1 + x), which keeps the order and lies within 0 and 1.
            .withColumn(_RANK, F.when((left > 0) & (F.col(_SIZE) > 0), win / (win + lose)))
        )

    bins = max(256, 1 << (int(max(rows, 1) ** 0.5)).bit_length())
    drawn = ranked(joined_to_groups(slim, targets, [_KEY], _ROWS, rows), F.col(_SHARE))
    drawn = drawn.withColumn(_BIN, F.floor(F.col(_RANK) * bins))
    cuts = written(targets.join(_cuts(drawn, id), _KEY, "left"), "cuts")

    decided = ranked(joined_to_groups(sized, cuts, [_KEY], _ROWS, rows), own)
    place = F.struct(F.col(_RANK).alias("rank"), F.col(id).alias("id"))
    chosen = F.coalesce((F.col(_RANK).isNotNull()) & (place <= F.col("__cut")), F.lit(False))
    copies = F.col(_WHOLE) + chosen.cast("long")
    return decided.select(
        *docs.columns,
        F.col(_SIZE).alias("size"),
        "source_size",
        "target",
        F.when(F.col(_SIZE) > 0, copies).otherwise(0).cast("long").alias("copies"),
        (copies * F.col(_SIZE)).cast("long").alias("taken"),
    )


def _copies_per_weight(slim: DataFrame, targets: DataFrame, rows: int) -> DataFrame:
    """Copies per unit of weight, by source, so that expected words meet the target with no document above the limit.

    The same rising level as for sources, for all sources at once; each round reads the slim rows once.
    """
    level = targets.select(_KEY, "target", _ROWS, F.lit(0.0).alias("__per_weight"), F.lit(0).alias("__full"))
    while True:
        full = F.col("__per_weight") * F.col(_SHARE) >= MOST_COPIES
        sums = (
            joined_to_groups(slim, level.drop("__full"), [_KEY], _ROWS, rows)
            .groupBy(_KEY)
            .agg(
                F.first("target").alias("target"),
                F.first(_ROWS).alias(_ROWS),
                F.count(F.when(full, 1)).alias("__full"),
                F.sum(F.when(full, F.col(_SIZE) * MOST_COPIES).otherwise(0)).alias("__taken"),
                F.sum(F.when(~full, F.col(_SIZE) * F.col(_SHARE)).otherwise(0.0)).alias("__free"),
            )
        )
        risen = F.greatest((F.col("target") - F.col("__taken")) / F.nullif(F.col("__free"), F.lit(0.0)), F.lit(0.0))
        new = written(
            sums.select(
                _KEY, "target", _ROWS, F.coalesce(risen, F.lit(float(MOST_COPIES))).alias("__per_weight"), "__full"
            ),
            "levels",
        )
        changed = new.join(level.select(_KEY, F.col("__full").alias("__was")), _KEY).where("__full <> __was")
        first = level.where("__per_weight > 0").isEmpty()
        level = new
        if not first and changed.isEmpty():
            return level.select(_KEY, "__per_weight")


def _cuts(drawn: DataFrame, id: str) -> DataFrame:
    """Per source the last place (rank, id) that is taken."""
    in_bins = written(
        drawn.groupBy(_KEY, _BIN).agg(
            F.sum(_SIZE).alias("words"),
            F.sum(F.col(_WHOLE) * F.col(_SIZE)).alias("certain"),
            F.max(F.struct(F.col(_RANK).alias("rank"), F.col(id).alias("id"))).alias("__top"),
            F.first("target").alias("target"),
        ),
        "bins",
    )
    missing = F.col("target") - F.sum("certain").over(Window.partitionBy(_KEY))
    running = in_bins.withColumn("__missing", missing).where(F.col(_BIN).isNotNull())
    upto = F.sum("words").over(Window.partitionBy(_KEY).orderBy(_BIN))
    running = running.withColumn("__before", upto - F.col("words"))
    below = (F.col("__before") + F.col("words") <= F.col("__missing"))
    at_cut = running.where(~below & (F.col("__before") < F.col("__missing")))
    whole_bins = running.where(below).groupBy(_KEY).agg(F.max("__top").alias("__cut"))

    inside = drawn.select(F.col(id), _KEY, _BIN, _SIZE, _RANK).join(
        F.broadcast(at_cut.select(_KEY, _BIN, "__before", "__missing")), [_KEY, _BIN]
    )
    order = Window.partitionBy(_KEY).orderBy(_RANK, F.col(id), _SIZE)
    middle = F.col("__before") + F.sum(_SIZE).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(_SIZE) / 2
    in_bin = (
        inside.withColumn("__middle", middle)
        .where(F.col("__middle") <= F.col("__missing"))
        .groupBy(_KEY)
        .agg(F.max(F.struct(F.col(_RANK).alias("rank"), F.col(id).alias("id"))).alias("__cut"))
    )
    return whole_bins.unionByName(in_bin).groupBy(_KEY).agg(F.max("__cut").alias("__cut"))


def repeating_weights(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights given in turn to the sources by code point, null last. One row per source is ordered, not documents."""
    sources = docs.groupBy(source_key(F.col(source)).alias(_KEY)).agg(F.first(source).alias("source"))
    turn = F.pmod(F.row_number().over(Window.orderBy(_KEY)) - 1, F.lit(len(weights)))
    return sources.select("source", F.get(F.array(*map(F.lit, weights)), turn).alias("weight"))
