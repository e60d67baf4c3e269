"""Boards and roll-ups kept up to date, newest rows without a sort, top rows of every group, rejected lines, stored days."""

from random import Random

import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from tickbars.operators import boards, live, ranking, rollups
from tickbars.plans import jobs
from tickbars.schemas import ResultTable
from tickbars.sinks import partitioned
from tickbars.sinks.keyed import KeyedTable
from tickbars.sources import bars as bar_source
from tickbars.streaming.incremental_boards import RULES, IncrementalBoard

METRICS = (
    "name_coin string, time_stamp timestamp, price double, percent_change double, percent_volume double, percent_market_cap double"
)
FUNCTIONS = {"top_winners": boards.top_winners, "top_losers": boards.top_losers, "market_share": boards.market_share}


def metrics(spark, seed, n, coins=30):
    random = Random(seed)
    data = [
        (f"c{random.randrange(coins)}", 1_700_000_000 + random.randrange(5000), random.random(),
         random.choice([None, random.randrange(40) / 4 - 5]), random.random(), random.choice([None, random.random()]))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, METRICS.replace("timestamp", "long")).withColumn("time_stamp", F.timestamp_seconds("time_stamp"))


@pytest.mark.parametrize("pick", ["max", "latest"])
@pytest.mark.parametrize("name", sorted(RULES))
def test_a_kept_board_equals_the_board_of_everything(spark, tmp_path, name, pick):
    batches = [metrics(spark, seed, n).coalesce(1).cache() for seed, n in ((1, 40), (2, 6), (3, 1), (4, 25))]
    kept = IncrementalBoard.like(batches[0], name, str(tmp_path), n=5, pick=pick, compact_every=2)
    for number, batch in enumerate(batches):
        kept.write_batch(batch, number)
        if number == 1:
            kept.write_batch(batch, number)  # repeated after a failure
        seen = batches[0]
        for other in batches[1 : number + 1]:
            seen = seen.unionByName(other)
        columns = kept.boards.contract.columns
        wanted = FUNCTIONS[name](seen, 5, pick).select(*columns)
        assert rows(kept.boards.last_snapshot(spark).select(*columns)) == rows(wanted)
    # Only the changed coins were written.
    sizes = {r.batch_id: r["count"] for r in kept.coins.log(spark).groupBy("batch_id").count().collect()}
    assert sizes[2] == 1 and sizes[1] <= 6


def test_a_recovered_loser_makes_room_for_a_coin_outside(spark, tmp_path):
    def batch(**changes):
        data = [(name, 1.0, change) for name, change in changes.items()]
        frame = spark.createDataFrame(data, "name_coin string, price double, percent_change double")
        return frame.withColumn("time_stamp", F.lit("2024-01-01").cast("timestamp"))

    kept = IncrementalBoard.like(batch(a=1.0), "top_losers", str(tmp_path), n=2)
    kept.write_batch(batch(a=-5.0, b=-4.0, c=-3.0, d=-2.0), 0)
    kept.write_batch(batch(a=9.0), 1)
    assert {r.name_coin for r in kept.boards.last_snapshot(spark).collect()} == {"b", "c"}
    kept.write_batch(batch(e=-9.0), 2)
    assert {r.name_coin for r in kept.boards.last_snapshot(spark).collect()} == {"b", "e"}


def test_many_changed_coins_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tickbars.streaming.incremental_boards.FEW", 3)
    first, second = metrics(spark, 5, 60), metrics(spark, 6, 60)
    kept = IncrementalBoard.like(first, "top_winners", str(tmp_path))
    kept.write_batch(first, 0)
    kept.write_batch(second, 1)
    columns = kept.boards.contract.columns
    assert rows(kept.boards.last_snapshot(spark).select(*columns)) == rows(boards.top_winners(first.unionByName(second)).select(*columns))


# Roll-ups -------------------------------------------------------------------------------------------------------------


def bars(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "i int").select(
        F.col("i").alias("SNo"),
        F.concat(F.lit("n"), F.col("i") % 3).alias("Name"),
        F.lit("X").alias("Symbol"),
        F.expr("date_add(date'2020-01-01', (i * 7) % 500)").alias("Date"),
        *[(F.col("i") * k % 101).cast("double").alias(c) for k, c in enumerate(("High", "Low", "Open", "Close", "Volume", "Marketcap"), 3)],
    )


@pytest.mark.parametrize("unique", [True, False])
def test_rollups_of_runs_equal_those_of_all_bars(spark, tmp_path, unique):
    parts = {1: range(0, 300, 2), 2: range(1, 200, 2), 3: range(201, 300, 2)}
    root = str(tmp_path)
    for run, numbers in ((1, parts[1]), (2, [5, 7]), (3, parts[3]), (2, parts[2]), (2, parts[2])):
        landed = f"{root}/landed-{run}"
        bars(spark, numbers).write.mode("overwrite").parquet(landed)
        months, years = jobs.bar_rollups_of_new(spark, landed, root, run, landed=True, unique_sequence=unique)
    everything = bars(spark, range(300))
    assert rows(months.last_snapshot(spark).drop("snapshot_id")) == rows(rollups.bars_by_month(everything))
    assert rows(years.last_snapshot(spark).drop("snapshot_id")) == rows(rollups.bars_by_year(everything))


def test_a_run_reads_its_own_bars_only(spark, tmp_path):
    root = str(tmp_path)
    for run, numbers in ((1, range(100)), (2, range(100, 130))):
        bars(spark, numbers).write.parquet(f"{root}/landed-{run}")
        stored, _ = jobs.bar_rollups_of_new(spark, f"{root}/landed-{run}", root, run, landed=True)
    partials = rollups.period_partials(bar_source.read_landed_bars(spark, f"{root}/landed-2"), "month", unique_sequence=True)
    assert all("landed-2" in name for name in partials.inputFiles())
    assert "SortAggregate" not in plan(partials) and plan(partials).count("Exchange") == 1
    log = spark.read.parquet(f"{root}/crypto_month_partials/log/batch_id=2")
    assert rows(log) == rows(partials)


# Newest rows ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_newest_per_key_equals_latest_per_key(spark, most):
    random = Random(1)
    data = [(random.choice(["a", "b", None]), random.choice([1, 2, None]), random.choice([None, *range(9)]), random.randrange(5)) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, l int, t long, v int").repartition(4)
    found = live.newest_per_key(df, ["k", "l"], "t", most)
    assert rows(found) == rows(live.latest_per_key(df, ["k", "l"], ["t"]))
    assert found.columns == df.columns
    assert live.newest_per_key(df.limit(0), ["k"], "t", most).count() == 0


def test_a_keyed_table_is_read_without_a_sort(spark, tmp_path):
    contract = ResultTable("t", ("k", "p", "v"), ("k", "p"), "s")
    frame = spark.range(0, 3000, 1, 4).select((F.col("id") % 700).alias("k"), (F.col("id") % 3).alias("p"), F.hex("id").alias("v"))
    first = frame.dropDuplicates(["k", "p"])
    table = KeyedTable.like(first, contract, str(tmp_path))
    table.write_batch(first, 0)
    table.write_batch(first.where("k < 100").withColumn("v", F.lit("new")), 1)
    text = plan(table.latest(spark))
    assert "Sort" not in text and table.latest(spark).where("v = 'new'").count() == first.where("k < 100").count()


def test_newest_per_key_sorts_no_raw_rows(spark, tmp_path):
    """Few keys are broadcast; many are dealt by key and time, so that one key with most of the rows is spread."""
    path = str(tmp_path / "rows")
    hot = F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id"))
    spark.range(0, 30_000, 1, 6).select(hot.alias("k"), F.col("id").alias("t"), F.hex("id").alias("text")).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(live.newest_per_key(df, ["k"], "t"))
    # Nothing is tied: rows pass one join by broadcast, and nothing is sorted or shuffled.
    assert "BroadcastHashJoin" in text and "Sort" not in text and "Exchange hashpartitioning" not in text
    repeated = plan(live.newest_per_key(df.unionByName(df.where("k = 2")), ["k"], "t"))
    # Of tied keys, what is sorted has passed both joins.
    ties = repeated[repeated.rindex("SortAggregate") :]
    assert ties.count("BroadcastHashJoin") >= 2 and "Sort [" not in ties.split("BroadcastHashJoin", 1)[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = plan(live.newest_per_key(df, ["k"], "t", 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in dealt
    raw = dealt[: dealt.index("FileScan")]
    assert "Exchange hashpartitioning(coalesce(k" in raw and "coalesce(t" in raw[raw.rindex("hashpartitioning") :]


# Top rows of every group ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 3, 10])
def test_top_ranked_by_group(spark, n):
    random = Random(n)
    data = [(random.choice(["a", "a", "a", "b", None]), random.choice([None, *range(12)]), i) for i in range(300)] + [("one", 5, 1000)]
    df = spark.createDataFrame(data, "g string, v int, i int").repartition(5)
    wanted = []
    for g, v, i in data:
        if v is not None and sum(1 for h, w, _ in data if h == g and w is not None and w > v) < n:
            wanted.append((g, v, i))
    assert rows(ranking.top_ranked_by(df, "v", "g", n)) == sorted(wanted, key=repr)


def test_a_group_with_most_rows_is_not_one_task(spark):
    hot = F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id")))
    df = spark.range(0, 60_000, 1, 8).select(hot.alias("g"), (F.col("id") * 7919 % 50_021).alias("v"), "id")
    text = plan(ranking.group_thresholds(df, "v", "g", 10))
    # Both windows get what a limit in the task before has left of each part.
    assert text.count("WindowGroupLimit") >= 2 and "partial_count" in text
    met = ranking.group_thresholds(df, "v", "g", 10)
    top = ranking.top_ranked_by(df, "v", "g", 10)
    assert met.where("g = 'hot'").first().threshold == top.where("g = 'hot'").agg(F.min("v")).first()[0]
    best = df.where("g = 'hot'").orderBy(F.col("v").desc()).limit(10).agg(F.min("v")).first()[0]
    assert met.where("g = 'hot'").first().threshold == best


def test_ties_of_any_size_are_one_row_of_the_ranking(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.lit("g").alias("g"), (F.col("id") % 2).alias("v"), "id")
    assert ranking.top_ranked_by(df, "v", "g", 3).count() == 10_000


# Rejected lines -------------------------------------------------------------------------------------------------------

LINES = [
    "SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap",
    "1,A,X,2020-01-01,1,2,3,4,5,6",
    "2,A,X,2020-01-02,1,2,3",
    "x,A,X,2020-01-03,1,2,3,4,5,6",
    "4,A,X,2020-01-04,1,2,3,4,,6",
    '5,"A, B",X,2020-01-05,1,2,3,4,5,6',
    '6,"A, B, C, D, E",X,2020-01-06',
    "7,A,X,2020-13-45,1,2,3,4,5,6",
    "8,A,X,2020-01-08,1,2,3,4,5,6,7",
    "",
    "SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap",
]
COUNTS = {"header": 2, "short line": 2, "bad type": 2, "incomplete": 1}


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text("\n".join(LINES) + "\n")
    return str(path)


def test_rejected_lines_are_kept_with_their_problem(spark, csv, tmp_path):
    counts = bar_source.land_checked_bars(spark, csv, str(tmp_path / "landed"))
    assert counts == COUNTS | {"lines": 10}
    landed = bar_source.read_checked_bars(spark, str(tmp_path / "landed"))
    assert rows(landed) == rows(bar_source.read_bars(spark, csv)) and landed.count() == 3
    rejected = {r.raw_line: r.problem for r in bar_source.read_rejected_lines(spark, str(tmp_path / "landed")).collect()}
    assert rejected[LINES[2]] == rejected[LINES[6]] == "short line" and rejected[LINES[3]] == rejected[LINES[7]] == "bad type"
    assert list(rejected.values()).count("incomplete") == 1 and rejected[LINES[0]] == "header"


def test_the_rollup_job_counts_them_in_its_one_read(spark, csv, tmp_path):
    months, _ = jobs.bar_rollups(spark, csv, str(tmp_path), 1)
    assert months.latest(spark).count() == 2
    assert dict(map(tuple, jobs.bar_problems(spark, str(tmp_path)).last_snapshot(spark).drop("snapshot_id").collect())) == COUNTS


# Stored days ----------------------------------------------------------------------------------------------------------


def scanned(df):
    """Metrics of the one scan after the query has run: partitions, files and rows read."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    node = query.executedPlan()
    while node.children().size():
        node = node.children().head()
    found = node.metrics()
    return {name: found.get(name).get().value() for name in ("numPartitions", "numFiles", "numOutputRows") if found.contains(name)}


@pytest.fixture
def static(spark):
    """Plans stay as they are, so that the scan of an empty result can be asked."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_lookup_skips_days_and_row_groups(spark, static, tmp_path):
    start = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    symbol = F.concat(F.lit("s"), F.lpad((F.col("id") % 500 * 2).cast("string"), 4, "0"))
    ticks = spark.range(0, 20_000, 1, 3).select(symbol.alias("symbol_coin"), F.timestamp_seconds(start + F.col("id") * 60).alias("time_stamp"), "id")
    path = str(tmp_path / "days")
    partitioned.write_by_day(ticks, path, symbols=500)
    stored = partitioned.read_by_day(spark, path, ticks.schema)
    assert rows(stored.drop("day")) == rows(ticks)
    one = partitioned.history(stored, "s0010", "2024-01-03", "2024-01-04")
    assert rows(one) == rows(ticks.where("symbol_coin = 's0010' and time_stamp >= '2024-01-03' and time_stamp < '2024-01-04'"))
    assert scanned(partitioned.history(stored, "s0010", "2024-01-03 01:00:00", "2024-01-03 23:00:00"))["numPartitions"] == 1
    # Absent, but between the smallest and the largest symbol of every row group.
    absent = scanned(partitioned.history(stored, "s0011"))
    assert absent["numFiles"] == 14 and absent["numOutputRows"] == 0
    assert scanned(partitioned.history(stored, "s0010"))["numOutputRows"] >= 20_000
