"""Helpers on data frames that several operators share: written intermediates and joins that no hot key can bend."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.session import work_dir

#: At most so many keys can each hold more than this share of the rows, so that side of a join may be broadcast.
HOT_KEYS = 100_000


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """The rows written to the shared folder and read from there: nothing upstream runs again, lost executors or not.
    ``by`` are columns of few values, each of which gets a folder of its own."""
    path = f"{work_dir(df.sparkSession, label)}/rows"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_to_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Rows with the columns of their group, given one row per key in ``groups`` with its number of rows in ``size``.

    Keys holding more than 1 / HOT_KEYS of all rows number at most HOT_KEYS: their groups are broadcast and their rows
    stay where they are. The rest is an ordinary join, in which no key holds more than that share.
    """
    most = max(1, total // HOT_KEYS)
    hot = F.broadcast(groups.where(F.col(size) > most))
    cold = groups.where(F.col(size) <= most)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys))


def on_own_columns(
    docs: DataFrame, used: list[str], added: list[str], operate: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``operate`` makes of the rows, whose other columns go through it under names that clash with nothing.

    The result has the columns of the rows and the added ones; a column named like an added one is replaced by it.
    """
    aside = {name: f"__aside_{i}" for i, name in enumerate(docs.columns) if name not in used}
    replaced = {name.lower() for name in added}
    kept = [aside.get(n, n) for n in docs.columns if n.lower() not in replaced]
    back = {new: old for old, new in aside.items()}
    made = operate(docs.toDF(*[aside.get(n, n) for n in docs.columns]))
    return made.select(*[F.col(n).alias(back.get(n, n)) for n in kept], *added)


def crc_fold(column: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo the number of folds."""
    return F.crc32(column.cast("string")) % folds


def lower_hex(column: Column) -> Column:
    return F.lower(F.hex(column))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")
