import pytest
from compare import rows

from tickbars import schemas
from tickbars.plans import jobs
from tickbars.sinks.keyed import KeyedTable

BARS = """SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap
1,Alpha,ALP,2020-12-31 23:59:59,5,1,2,3,10,100
2,Alpha,ALP,2021-01-01 23:59:59,6,2,3,4,20,300
3,Alpha,ALP,2021-02-01 23:59:59,7,3,4,5,30,200
"""


def table(spark, contract, root):
    return rows(KeyedTable.open(spark, contract, f"{root}/{contract.name}").latest(spark))


def test_commands(spark, tmp_path):
    (tmp_path / "one.csv").write_text(BARS)
    (tmp_path / "two.csv").write_text(BARS.replace("Alpha", "Beta").replace("100", "900"))
    (tmp_path / "quotes.csv").write_text("id,name1,price,marketCap\n1,Alpha,2.0,10\n2,Alpha,4.0,5\n")
    paths = [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]
    out = str(tmp_path / "out")

    for _ in range(2):  # a repeated run replaces itself
        jobs.main(["bars", "--input", *paths, "--output", out, "--run", "1"])
        jobs.main(["top-bars", "--input", *paths, "--output", out, "--run", "1"])
        jobs.main(["summary", "--input", str(tmp_path / "quotes.csv"), "--output", out, "--run", "1"])

    months = table(spark, schemas.MONTH_BARS, out)
    assert len(months) == 6
    assert ("Alpha", "2021-01", 6.0, 2.0, 3.0, 4.0, 20.0, 300.0) in months
    assert ("Beta", "2021", 7.0, 2.0, 3.0, 5.0, 50.0, 500.0) in table(spark, schemas.YEAR_BARS, out)
    assert table(spark, schemas.ASSET_SUMMARY, out) == [("Alpha", 3.0, 2.0, 4.0, 10.0)]
    assert max(r[-1] for r in table(spark, schemas.TOP_MARKETCAP, out)) == 900.0

    landed, again = str(tmp_path / "landed"), str(tmp_path / "again")
    jobs.main(["land", "--input", *paths, "--output", landed])
    for command in ("bars", "top-bars"):
        jobs.main([command, "--input", landed, "--landed", "--output", again, "--run", "1"])
    for contract in (schemas.MONTH_BARS, schemas.YEAR_BARS, schemas.TOP_MARKETCAP):
        assert table(spark, contract, again) == table(spark, contract, out)

    jobs.main(["bars", "--input", *paths, "--output", out, "--run", "2"])
    jobs.main(["compact", "--output", out, "--table", "crypto_month_agg"])
    assert table(spark, schemas.MONTH_BARS, out) == months


def test_a_glob_is_one_read(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.csv").write_text(BARS.replace("Alpha", name))
    months, years = jobs.bar_rollups(spark, str(tmp_path / "*.csv"), str(tmp_path / "out"), 7)
    assert (months.latest(spark).count(), years.latest(spark).count()) == (9, 6)


def test_repeated_sequence_numbers_are_settled_by_price(spark, tmp_path):
    (tmp_path / "a.csv").write_text(BARS + "1,Alpha,ALP,2020-12-31,5,1,1.5,9,10,100\n")
    out = str(tmp_path / "out")
    jobs.main(["bars", "--input", str(tmp_path / "a.csv"), "--output", out, "--run", "1", "--repeated-sequence"])
    december = [r for r in table(spark, schemas.MONTH_BARS, out) if r[1] == "2020-12"]
    assert december == [("Alpha", "2020-12", 5.0, 1.0, 1.5, 3.0, 20.0, 200.0)]


def test_stream_command_needs_the_kafka_package(spark, tmp_path):
    command = ["stream", "--servers", "localhost:1", "--output", str(tmp_path), "--option", "startingOffsets=earliest"]
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.main(command)


def test_incomplete_quotes_are_counted(spark, tmp_path):
    (tmp_path / "quotes.csv").write_text("name1,price,marketCap\nA,2.0,10\nA,,5\nB,x,5\n,1,1\nB,1,1\n")
    table = jobs.asset_summary(spark, str(tmp_path / "quotes.csv"), str(tmp_path / "out"), 3)
    assert {r.name for r in table.latest(spark).collect()} == {"A", "B"}
    counts = jobs.quote_counts(spark, str(tmp_path / "out")).last_snapshot(spark)
    assert rows(counts.drop("snapshot_id")) == [("rows_read", 5), ("rows_rejected", 3)]
