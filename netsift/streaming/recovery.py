"""Restart of a streaming query from its checkpoint, without lost or repeated rows.

A query can stop after a micro-batch is written and before its commit reaches
the checkpoint; the restarted query then runs that batch again under the same
number. :func:`write_batch` keeps each batch in a folder of its own and replaces it,
so the second run takes the place of the first; :func:`read_committed` reads the
batches that the checkpoint has committed and no others, also while a query is down.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import shared


def write_batch(df: DataFrame, batch_id: int, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a micro-batch as ``<path>/batch=<id>``, in place of an earlier attempt."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/batch={batch_id}")


def start_batch_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
    after_write: Callable[[int], None] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a query whose batches replace themselves; ``after_write(batch)`` runs between write and commit."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, partition_by)
        if after_write:
            after_write(batch_id)

    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def run_with_restarts(start: Callable[[], StreamingQuery], restarts: int = 3) -> int:
    """Run a query to its end, starting it anew when it fails; returns the restarts used.

    ``start`` must use the same checkpoint each time. The last failure is raised when no restart is left.
    """
    for used in range(restarts + 1):
        try:
            start().awaitTermination()
            return used
        except StreamingQueryException:
            if used == restarts:
                raise
    return restarts


def committed_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the batches in the checkpoint's commit log (Spark keeps the last hundred or so files there)."""
    return sorted(int(n) for n in shared.names(spark, f"{checkpoint}/commits") if n.isdigit())


def read_committed(spark: SparkSession, path: str, checkpoint: str, schema: str | None = None) -> DataFrame:
    """Rows of all batches up to the last committed one.

    Batches commit in order, so the last commit covers all before it, also those whose commit file is cleaned up.
    """
    done = committed_batches(spark, checkpoint)
    if not done or not shared.names(spark, path):
        if schema is None:
            raise ValueError("nothing committed: name the schema of the empty result")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, batch long")
    return reader.parquet(path).where(F.col("batch") <= done[-1]).drop("batch")
