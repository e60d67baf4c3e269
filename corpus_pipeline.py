"""The corpus pipeline: documents through filtering, dedup, decontamination and mixing.

Each stage takes the rows that the one before kept and returns, but for the last, rows with the columns of documents; it
is written and read again as Parquet between stages. Clean documents pass every filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from tickbars.llm.shared import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents among its input and drop those scored toxic."""
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of five-word shingles of 0.8 or more, keep the one with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more stands in the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every document its number of copies in the mix; documents that the mix does not take have none."""
    return mixing.mix(docs, mixing.repeating_weights(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The classifier and the components of near-dedup go beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
