"""Row completeness and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def is_complete(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without NULL in ``columns`` (default: all).

    Written as ``IS NOT NULL AND ...`` so that a parquet scan receives the conditions as pushed filters; naming only
    the columns a query reads keeps the others out of the scan.
    """
    return df.where(is_complete(columns or df.columns))


def counted(df: DataFrame, columns: Sequence[str], name: str = "quality") -> tuple[DataFrame, Observation]:
    """``drop_incomplete`` that also counts what it read and rejected, in the same pass over the data.

    The counts are in ``observation.get`` (``rows_read``, ``rows_rejected``) once an action has run on the frame.
    """
    observation = Observation(name)
    good = is_complete(columns)
    watched = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(~good, 1)).alias("rows_rejected"),
    )
    return watched.where(good), observation


def split(df: DataFrame, reason: Column, name: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason); a NULL reason means accepted."""
    return df.where(reason.isNull()), df.withColumn(name, reason).where(F.col(name).isNotNull())
