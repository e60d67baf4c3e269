import os
from random import Random

import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from tickbars.schemas import ResultTable
from tickbars.sinks.external import CassandraTable, preview
from tickbars.sinks.keyed import KeyedTable

CONTRACT = ResultTable("t", ("k", "p", "v"), ("k", "p"), "space")


def batch(spark, *data):
    return spark.createDataFrame(list(data), "v int, k string, extra string, p int")


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable.like(batch(spark, (1, "a", "x", 1)), CONTRACT, str(tmp_path / "t"))


def test_empty(spark, table):
    assert table.latest(spark).collect() == []
    assert table.latest(spark).columns == ["k", "p", "v"]
    assert table.compact(spark) == -1
    assert table.last_snapshot(spark).count() == 0


def test_last_write_wins(spark, table):
    table.write_batch(batch(spark, (1, "a", "", 1), (2, "b", "", 1)), 0)
    table.write_batch(batch(spark, (0, "a", "", 1), (5, "a", "", 2)), 1)
    assert rows(table.latest(spark)) == [("a", 1, 0), ("a", 2, 5), ("b", 1, 2)]


def test_batch_order_is_numeric(spark, table):
    table.write_batch(batch(spark, (10, "a", "", 1)), 10)
    table.write_batch(batch(spark, (9, "a", "", 1)), 9)
    assert rows(table.latest(spark)) == [("a", 1, 10)]


def test_repeated_batch_changes_nothing(spark, table):
    for _ in range(3):
        table.write_batch(batch(spark, (1, "a", "", 1)), 0)
        table.write_batch(batch(spark, (2, "a", "", 1), (3, "c", "", 1)), 1)
    assert rows(table.latest(spark)) == [("a", 1, 2), ("c", 1, 3)]
    assert table.log(spark).count() == 3


def test_one_key_twice_in_a_batch_is_settled_by_content(spark, table):
    for n in (1, 3):
        table.write_batch(batch(spark, (1, "a", "", 1), (7, "a", "", 1), (3, "a", "", 1)).repartition(n), 0)
        assert rows(table.latest(spark)) == [("a", 1, 7)]


def test_uncommitted_batch_is_not_read(spark, table):
    table.write_batch(batch(spark, (1, "a", "", 1)), 0)
    table.write_batch(batch(spark, (2, "a", "", 1)), 1)
    os.remove(f"{table.path}/log/batch_id=1/_SUCCESS")
    assert rows(table.latest(spark)) == [("a", 1, 1)]


def test_compaction(spark, table):
    table.write_batch(batch(spark, (1, "a", "", 1), (2, "b", "", 1)), 0)
    assert table.compact(spark) == -1  # the newest batch may still be repeated
    table.write_batch(batch(spark, (3, "a", "", 1)), 4)
    assert table.compact(spark) == 0
    assert table.compact(spark) == 0
    assert rows(table.latest(spark)) == [("a", 1, 3), ("b", 1, 2)]
    table.write_batch(batch(spark, (0, "b", "", 1), (9, "c", "", 1)), 5)
    expected = [("a", 1, 3), ("b", 1, 0), ("c", 1, 9)]
    assert rows(table.latest(spark)) == expected
    # Few new keys: the compacted rows are not shuffled.
    assert "LeftAnti" in plan(table.latest(spark)) and "SortMergeJoin" not in plan(table.latest(spark))
    assert table.compact(spark) == 4
    assert rows(table.latest(spark)) == expected
    table.drop_compacted(spark)
    assert sorted(os.listdir(f"{table.path}/log")) == ["batch_id=5"]
    assert sorted(os.listdir(f"{table.path}/compacted")) == ["batch_id=4"]
    assert rows(table.latest(spark)) == expected
    assert rows(KeyedTable.open(spark, CONTRACT, table.path).latest(spark)) == expected


def test_the_newest_batch_can_be_replaced_after_a_compaction_and_older_ones_cannot(spark, table):
    for number in range(3):
        table.write_batch(batch(spark, (number, "a", "", 1), (number, "b", "", number)), number)
    assert table.compact(spark) == 1
    table.write_batch(batch(spark, (7, "a", "", 1)), 2)
    assert rows(table.latest(spark)) == [("a", 1, 7), ("b", 0, 0), ("b", 1, 1)]
    with pytest.raises(ValueError, match="compacted"):
        table.write_batch(batch(spark, (8, "a", "", 1)), 1)


def test_a_state_before_the_compaction_is_refused(spark, table):
    for number in range(4):
        table.write_batch(spark.createDataFrame([], table.schema), number)
    done = table.compact(spark)
    with pytest.raises(ValueError, match="compacted"):
        table.latest(spark, upto=done - 1)


def test_a_compaction_that_died_is_ignored(spark, table):
    table.write_batch(batch(spark, (1, "a", "", 1)), 0)
    table.write_batch(batch(spark, (2, "b", "", 1)), 1)
    table.compact(spark)
    os.remove(f"{table.path}/compacted/batch_id=0/_SUCCESS")
    assert rows(table.latest(spark)) == [("a", 1, 1), ("b", 1, 2)]
    assert table.compact(spark) == 0
    assert rows(table.latest(spark)) == [("a", 1, 1), ("b", 1, 2)]


def test_null_in_a_key_is_a_key_of_its_own(spark, table):
    table.write_batch(batch(spark, (1, "a", "", None), (2, "a", "", 1)), 0)
    table.write_batch(batch(spark, (3, "a", "", None)), 1)
    assert table.compact(spark) == 0
    assert rows(table.latest(spark)) == [("a", 1, 2), ("a", None, 3)]


def test_lookups_reach_the_scans(spark, table):
    table.write_batch(batch(spark, *[(i, "ab"[i % 2], "", i) for i in range(20)]), 0)
    table.write_batch(batch(spark, (99, "a", "", 4)), 1)
    assert table.compact(spark) == 0
    found = table.latest(spark, (F.col("k") == "a") & F.col("p").between(4, 7))
    scans = [line for line in plan(found).splitlines() if "FileScan" in line]
    assert rows(found) == [("a", 4, 99), ("a", 6, 6)]
    assert len(scans) == 3
    for scan in scans:
        assert "EqualTo(k,a)" in scan and "GreaterThanOrEqual(p,4)" in scan and "LessThanOrEqual(p,7)" in scan
    with pytest.raises(Exception, match="v"):
        table.latest(spark, F.col("v") == 1)


def test_any_history_equals_a_dictionary(spark, tmp_path):
    """Random batches, repeats and compactions against the obvious model."""
    random = Random(7)
    for trial in range(4):
        table = KeyedTable.like(batch(spark, (1, "a", "x", 1)), CONTRACT, str(tmp_path / f"t{trial}"))
        model = {}
        for number in range(6):
            data = [(random.randrange(9), random.choice("abc"), "", random.randrange(3)) for _ in range(5)]
            for _ in range(random.choice((1, 1, 2))):
                table.write_batch(batch(spark, *data), number)
            newest = {}
            for v, k, _, p in data:
                newest[k, p] = max(v, newest.get((k, p), v))
            model |= newest
            if random.random() < 0.4:
                table.compact(spark)
        assert rows(table.latest(spark)) == sorted(((k, p, v) for (k, p), v in model.items()), key=repr)


def test_last_snapshot(spark, table):
    table.write_batch(batch(spark, (1, "a", "", 1), (2, "b", "", 1)), 0)
    table.write_batch(batch(spark, (3, "c", "", 1)), 1)
    assert rows(table.last_snapshot(spark)) == [("c", 1, 3, 1)]
    assert table.snapshots(spark).count() == 3


def test_external_store_needs_its_connector(spark, tmp_path):
    store = CassandraTable(CONTRACT, str(tmp_path))
    with pytest.raises(Exception, match="(?i)cassandra"):
        store.write_batch(batch(spark, (1, "a", "", 1)), 0)


def test_preview(spark, capsys):
    preview(batch(spark, (1, "key", "", 1)), 1)
    assert "key" in capsys.readouterr().out


def test_work_folder_follows_the_session(spark):
    from tickbars.session import work_dir

    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tickbars.session import work_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(cluster, "x")
