import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from tickbars.operators import quality, rollups
from tickbars.schemas import BAR, QUOTE
from tickbars.sources.bars import land_bars, read_bars, read_bars_raw, read_quotes

HEADER = "SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def bar_lines(name, days, start=1):
    return [
        f"{i},{name},{name[:3]},{day},{10 + i},{5 - i / 10},{6 + i},{7 + i},{100 * i},{1000 * i}"
        for i, day in enumerate(days, start)
    ]


DAYS = ["2020-12-30", "2020-12-31", "2021-01-01", "2021-01-02", "2021-02-01"]


def test_header_short_broken_and_empty_lines_are_dropped(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        HEADER,
        *bar_lines("Alpha", ["2021-01-01", "2021-01-02 00:00:00"]),
        "3,Alpha,Alp,2021-01-03,1,2",
        "4,Alpha,Alp,not a date,1,1,1,1,1,1",
        "5,Alpha,Alp,2021-01-05,1,1,,1,1,1",
        "x,Alpha,Alp,2021-01-06,1,1,1,1,1,1",
    )
    kept = read_bars(spark, path)
    assert kept.schema == BAR
    assert [str(r.Date) for r in kept.orderBy("SNo").collect()] == ["2021-01-01", "2021-01-02"]

    watched, counts = quality.counted(read_bars_raw(spark, path), BAR.fieldNames(), "bars")
    assert watched.count() == 2
    assert counts.get == {"rows_read": 7, "rows_rejected": 5}


def test_a_query_of_few_columns_still_drops_incomplete_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", *bar_lines("Alpha", DAYS), "6,Alpha,Alp,2021-03-01,1,1,1,1,1,oops")
    assert read_bars(spark, path).select("Name").count() == len(DAYS)


def test_month_and_year_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *bar_lines("Alpha", DAYS))
    bars = read_bars(spark, path)
    month = rollups.bars_by_month(bars)
    assert month.columns == [
        "name",
        "month",
        "highest_high",
        "lowest_low",
        "first_open",
        "last_close",
        "total_volume",
        "total_marketcap",
    ]
    assert rows(month) == [
        ("Alpha", "2020-12", 12.0, 4.8, 7.0, 9.0, 300.0, 3000.0),
        ("Alpha", "2021-01", 14.0, 4.6, 9.0, 11.0, 700.0, 7000.0),
        ("Alpha", "2021-02", 15.0, 4.5, 11.0, 12.0, 500.0, 5000.0),
    ]
    assert rows(rollups.bars_by_year(bars)) == [
        ("Alpha", "2020", 12.0, 4.8, 7.0, 9.0, 300.0, 3000.0),
        ("Alpha", "2021", 15.0, 4.5, 9.0, 12.0, 1200.0, 12000.0),
    ]


def test_result_does_not_depend_on_files_or_row_order(spark, tmp_path):
    folder = tmp_path / "coins"
    folder.mkdir()
    write(folder / "b.csv", HEADER, *reversed(bar_lines("Alpha", DAYS)))
    write(folder / "a.csv", HEADER, *bar_lines("Beta", DAYS))
    one = read_bars(spark, str(folder))
    listed = read_bars(spark, [str(folder / "a.csv"), str(folder / "b.csv")])
    shuffled = one.repartition(7).orderBy(F.xxhash64("Name", "SNo"))
    expected = rows(rollups.bars_by_month(one))
    assert len(expected) == 6
    for bars in (listed, shuffled):
        assert rows(rollups.bars_by_month(bars)) == expected
        assert rows(rollups.bars_by_month(bars, unique_sequence=True)) == expected


def test_equal_date_and_sequence_are_ordered_by_price(spark):
    data = [(1, "A", "A", "2021-01-01", 9.0, 1.0, float(o), float(c), 1.0, 1.0) for o, c in ((3, 4), (2, 8), (2, 5))]
    bars = spark.createDataFrame(data, "SNo int, Name string, Symbol string, Date string, High double, Low double,"
                                 "Open double, Close double, Volume double, Marketcap double")
    for permuted in (bars, bars.orderBy("Close"), bars.orderBy(F.desc("Open"), F.desc("Close"))):
        month = rollups.bars_by_month(permuted.coalesce(1)).first()
        assert (month.first_open, month.last_close) == (2.0, 4.0)


def test_years_from_months_equal_years(spark, tmp_path):
    path = write(tmp_path / "a.csv", *bar_lines("Alpha", DAYS), *bar_lines("Beta", DAYS[::-1]))
    bars = read_bars(spark, path)
    months = rollups.period_base(bars, "month", unique_sequence=True)
    derived = rollups.labelled(rollups.year_base_from_months(months), "year")
    assert rows(derived) == rows(rollups.bars_by_year(bars))


def test_sequence_too_large_for_the_packed_order_is_refused(spark, tmp_path):
    bars = read_bars(spark, write(tmp_path / "a.csv", *bar_lines("Alpha", DAYS)))
    big = bars.withColumn("SNo", F.lit(1 << 60))
    with pytest.raises(Exception, match="too large"):
        rollups.bars_by_month(big, unique_sequence=True).collect()
    assert rollups.bars_by_month(big).count() == 3


def test_one_asset_with_most_rows_is_combined_before_the_shuffle(spark):
    bars = spark.range(0, 20_000, 1, 8).select(
        F.col("id").cast("int").alias("SNo"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("Name"),
        F.lit("X").alias("Symbol"),
        F.expr("date_add(date'2020-01-01', cast(id % 365 as int))").alias("Date"),
        *[F.col("id").cast("double").alias(c) for c in ("High", "Low", "Open", "Close", "Volume", "Marketcap")],
    )
    fast = rollups.bars_by_month(bars, unique_sequence=True)
    text = plan(fast)
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2 and text.count("Exchange") == 1
    exact = plan(rollups.bars_by_month(bars))
    assert "partial_min_by" in exact and exact.count("Exchange") == 1
    assert rows(fast) == rows(rollups.bars_by_month(bars))


def test_parquet_scan_gets_filters_and_only_needed_columns(spark, sf_dir):
    from tickbars.plans import tables

    text = plan(rollups.bars_by_month(tables.bars(spark, sf_dir)))
    scan = text[text.index("FileScan") :]
    assert "IsNotNull(l_orderkey)" in scan
    assert "l_comment" not in scan and "l_returnflag" not in scan and "l_linestatus" not in scan


def test_land_bars(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, *bar_lines("Alpha", DAYS))
    landed = land_bars(spark, path, str(tmp_path / "landed"))
    assert rows(landed) == rows(read_bars(spark, path))
    assert "ReadSchema: struct<Close:double>" in plan(landed.select("Close")).replace("..", "")


def test_quotes_are_read_by_name(spark, tmp_path):
    first = write(tmp_path / "a.csv", "rank,price,name1,marketCap", "1,2.5,A,10", "2,,A,20", "3,3.5,A,30", "4,1,B,5")
    quotes = read_quotes(spark, first)
    assert quotes.schema == QUOTE
    assert rows(rollups.asset_summary(quotes)) == [("A", 3.0, 2.5, 3.5, 30.0), ("B", 1.0, 1.0, 1.0, 5.0)]

    write(tmp_path / "b.csv", "name1,price,rank,marketCap", "A,2.5,1,10")
    with pytest.raises(Exception, match="(?i)header"):
        read_quotes(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="marketCap"):
        read_quotes(spark, write(tmp_path / "c.csv", "name1,price", "A,1"))


def test_summary_of_decimal_prices_is_exact_in_any_order(spark):
    data = spark.createDataFrame([("A", str(p)) for p in ("0.1", "0.2", "0.3", "1e15", "-1e15")], "name1 string, p string")
    quotes = data.select("name1", F.col("p").cast("decimal(38,18)").alias("price"), F.lit(1.0).alias("marketCap"))
    for n in (1, 3, 5):
        assert rollups.asset_summary(quotes.repartition(n)).first().avg_price == 0.12


def test_text_dates(spark):
    data = [(i, "A", d, *[1.0] * 6) for i, d in enumerate(["2021-01-05", "2021-01-06 10:00:00", "soon", "2021-13-01"])]
    bars = spark.createDataFrame(data, "SNo int, Name string, Date string, High double, Low double, Open double,"
                                 "Close double, Volume double, Marketcap double")
    assert [(r.month, r.total_volume) for r in rollups.bars_by_month(bars).collect()] == [("2021-01", 2.0)]


def test_unknown_grain(spark):
    from tickbars.functions.calendar import period_start

    with pytest.raises(ValueError, match="grain"):
        period_start(F.col("d"), "week")
