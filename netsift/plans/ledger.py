"""Runs on record: observed stages, a run's summary row, and a ledger that keeps each run once.

:class:`Stages` wraps real actions: each stage runs under a job description of
its own and is timed around the action, so lazy planning is not mistaken for
work. Its rows are counted from the footers of the files it wrote. (An
``Observation`` would count them on the way, but in Spark 4.1 it leaves an object in
the session that the scoring tasks of tree models cannot be serialised with.)

The ledger is a folder with one partition per run id: appending a run again
replaces its row, so a retried driver does not list a run twice. Rows may
have other columns than earlier ones; the reader merges the schemas and fills
with nulls. :func:`latest` is the newest row per key.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import shared

STAGE_SCHEMA = "position int, stage string, rows long, seconds double"


class Stages:
    """Stages of one run, in order: name, rows, seconds."""

    def __init__(self, spark: SparkSession, run: str):
        self.spark, self.run, self.done = spark, run, []

    def _run(self, name: str, action):
        sc = self.spark.sparkContext
        sc.setLocalProperty("spark.job.description", f"{self.run}: {name}")
        started = time.perf_counter()
        try:
            result = action()
        finally:
            sc.setLocalProperty("spark.job.description", None)
        return result, time.perf_counter() - started

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` once to the shared folder and return what was written."""
        path = scratch_path(self.spark, f"stage-{uuid.uuid4().hex[:12]}")
        _, seconds = self._run(name, lambda: df.write.parquet(path))
        written = self.spark.read.schema(df.schema).parquet(path)
        self.done.append((len(self.done), name, written.count(), seconds))
        return written

    def call(self, name: str, action, rows: int | None = None):
        """Run an action that gives no table (a fit); it must run its jobs itself."""
        result, seconds = self._run(name, action)
        self.done.append((len(self.done), name, rows, seconds))
        return result

    def report(self) -> DataFrame:
        """``position, stage, rows, seconds``, one row per stage."""
        return self.spark.createDataFrame(self.done, STAGE_SCHEMA)


def append_run(row: DataFrame, ledger: str, run_id: str) -> None:
    """Record ``row`` under ``run_id``; a run recorded before is replaced."""
    if "run_id" in row.columns:
        raise ValueError("run_id is the ledger's own column")
    row.withColumn("recorded_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{ledger}/run_id={run_id}")


def runs(spark: SparkSession, ledger: str) -> DataFrame:
    """All recorded rows with ``run_id`` and ``recorded_at``; columns that a run lacks are null."""
    if not shared.names(spark, ledger):
        return spark.createDataFrame([], "run_id string, recorded_at timestamp")
    rows = spark.read.option("mergeSchema", "true").parquet(ledger)
    return rows.withColumn("run_id", F.col("run_id").cast("string"))


def latest(recorded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per ``keys`` (ties: largest run id)."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("recorded_at"), F.desc("run_id"))
    return recorded.withColumn("__place", F.row_number().over(newest)).filter("__place = 1").drop("__place")
