"""Daily bars and quotes from CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.quality import drop_incomplete, is_complete
from tickbars.schemas import BAR, QUOTE

Paths = str | list[str]


def read_bars_raw(spark: SparkSession, paths: Paths) -> DataFrame:
    """Every CSV line as a bar; fields that do not parse are NULL, and so is a whole header line but for its names."""
    return spark.read.schema(BAR).option("header", False).option("mode", "PERMISSIVE").csv(paths)


def read_bars(spark: SparkSession, paths: Paths) -> DataFrame:
    """Complete bars of any number of CSV files, folders or globs, with or without header lines.

    A bar counts as complete over all its fields, so a query must not narrow the columns before this check: a short or
    broken line has to go even if the fields the query wants were readable.
    """
    return drop_incomplete(read_bars_raw(spark, paths))


RAW_LINE = "raw_line"
#: Why a line is no bar, in the order of the checks.
HEADER, SHORT_LINE, BAD_TYPE, INCOMPLETE = BAR_PROBLEMS = ("header", "short line", "bad type", "incomplete")


def read_bar_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """``read_bars_raw`` with the text of lines that did not parse in ``raw_line``."""
    lines = T.StructType([*BAR.fields, T.StructField(RAW_LINE, T.StringType())])
    reader = spark.read.schema(lines).option("header", False).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", RAW_LINE).csv(paths)


def bar_problem() -> Column:
    """Why a line is no complete bar; NULL for a bar. Exactly the lines that ``read_bars`` leaves out have a problem."""
    names, raw = BAR.fieldNames(), F.col(RAW_LINE)
    header = F.col("SNo").isNull() & (F.col("Name") == "Name") & (F.col("Symbol") == "Symbol")
    # Separators that an even number of quotes follows are not part of a quoted field.
    fields = F.regexp_count(raw, F.lit(r',(?=(?:[^"]*"[^"]*")*[^"]*$)')) + 1
    return (
        F.when(is_complete(names), F.lit(None))
        .when(header, HEADER)
        .when(raw.isNotNull() & (fields < len(names)), SHORT_LINE)
        .when(raw.isNotNull(), BAD_TYPE)
        .otherwise(INCOMPLETE)
    )


def counted_bars(lines: DataFrame, name: str = "bars") -> tuple[DataFrame, Observation]:
    """Bars of ``read_bar_lines`` and, once an action has read them, the number of lines and of each problem.

    ``observation.get`` has ``lines`` and a count by problem; nothing is read twice for it.
    """
    seen, problem = Observation(name), F.col("problem")
    counts = [F.count_if(problem == p).alias(p) for p in BAR_PROBLEMS]
    watched = lines.withColumn("problem", bar_problem()).observe(seen, F.count(F.lit(1)).alias("lines"), *counts)
    return watched.where(problem.isNull()).select(*BAR.fieldNames()), seen


def land_checked_bars(spark: SparkSession, paths: Paths, target: str) -> dict[str, int]:
    """Store bars and rejected lines from one pass over the files, and return the counts of ``counted_bars``.

    Rejected lines keep their text (an incomplete one is put together from its fields) and the problem; they lie in a
    partition of their own, which ``read_checked_bars`` never opens.
    """
    seen, problem, rejected = Observation("landed bars"), F.col("problem"), F.col("problem").isNotNull()
    counts = [F.count_if(problem == p).alias(p) for p in BAR_PROBLEMS]
    lines = read_bar_lines(spark, paths).withColumn("problem", bar_problem())
    text = F.coalesce(F.col(RAW_LINE), F.to_csv(F.struct(*BAR.fieldNames())))
    rows = lines.withColumns({RAW_LINE: F.when(rejected, text), "rejected": rejected})
    rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), *counts)
    rows.write.mode("overwrite").partitionBy("rejected").parquet(target)
    return seen.get


_CHECKED = T.StructType(
    [*BAR.fields, *[T.StructField(name, T.StringType()) for name in (RAW_LINE, "problem")], T.StructField("rejected", T.BooleanType())]
)


def read_checked_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CHECKED).parquet(path).where(~F.col("rejected")).select(*BAR.fieldNames())


def read_rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text and problem of the lines that were set aside."""
    return spark.read.schema(_CHECKED).parquet(path).where("rejected").select(RAW_LINE, "problem")


def land_bars(spark: SparkSession, paths: Paths, target: str) -> DataFrame:
    """Store the complete bars as parquet once, so that every later job prunes columns and skips row groups."""
    read_bars(spark, paths).write.mode("overwrite").parquet(target)
    return read_landed_bars(spark, target)


def read_landed_bars(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.schema(BAR).parquet(*([paths] if isinstance(paths, str) else paths))


def read_quotes(spark: SparkSession, paths: Paths) -> DataFrame:
    """The complete rows of ``read_quotes_raw``."""
    return drop_incomplete(read_quotes_raw(spark, paths))


def read_quotes_raw(spark: SparkSession, paths: Paths) -> DataFrame:
    """Name, price and market capitalisation from CSV files with a header, whatever other columns they have.

    Only the header line is looked at for the layout: types are given, not inferred, which would read everything twice.
    Files whose header differs from the first one's fail instead of being read into the wrong columns.
    """
    names = spark.read.option("header", True).csv(paths).columns
    missing = [field.name for field in QUOTE if field.name not in names]
    if missing:
        raise ValueError(f"quote files lack the columns {missing}")
    types = {field.name: field.dataType for field in QUOTE}
    layout = T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in names])
    reader = spark.read.schema(layout).option("header", True).option("enforceSchema", False)
    return reader.csv(paths).select(*QUOTE.fieldNames())
