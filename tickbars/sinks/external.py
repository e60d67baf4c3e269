"""Pass-through of results to an external keyed store, and previews on the console."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickbars.operators.quality import drop_incomplete
from tickbars.schemas import STORE_FORMAT, ResultTable


@dataclass(frozen=True)
class CassandraTable:
    """A result table in Cassandra; needs its connector on the class path.

    Appending there keeps the last write of each primary key, so a repeated batch changes nothing. A row with a NULL in
    its key, such as a board coin of unknown change, cannot be stored there and is left out rather than failing the
    batch; ``KeyedTable`` keeps it. Host and port are session settings of the connector
    (``spark.cassandra.connection.host``, ``spark.cassandra.connection.port``).
    """

    contract: ResultTable
    checkpoint: str

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        rows = drop_incomplete(df.select(*self.contract.columns), self.contract.keys)
        writer = rows.write.format(STORE_FORMAT).mode("append")
        writer.option("keyspace", self.contract.keyspace).option("table", self.contract.name).save()


def preview(df: DataFrame, rows: int = 20) -> None:
    """Print some rows. Each call is a job of its own, so no job of this library calls it."""
    df.show(rows, truncate=False)


def preview_stream(df: DataFrame, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    """Print every batch of a stream, for development."""
    writer = df.writeStream.outputMode(output_mode).format("console").option("truncate", False)
    return writer.option("checkpointLocation", checkpoint).start()
