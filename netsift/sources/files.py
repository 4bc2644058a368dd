"""File sources and sinks: CSV / Parquet scans, dataset and metrics writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import CONN_COLUMNS


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; an explicit schema skips the inference pass over the data."""
    r = spark.read.option("header", "true")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
    return r.csv(path)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None
) -> DataFrame:
    """Records in Parquet or CSV: ``fmt`` says which, else a ``.csv`` path is CSV and any other Parquet.

    Partition folders (``day=...``) become columns; ``_``/``.`` files are
    skipped by Spark.
    """
    if (fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")) == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def default_fieldnames() -> list[str]:
    """Column order of a written record dataset."""
    return list(CONN_COLUMNS)


def write_dataset(df: DataFrame, path: str, fieldnames: Sequence[str] | None = None, fmt: str = "csv") -> None:
    """Write records in field order, with a header for CSV."""
    cols = [c for c in (fieldnames or default_fieldnames()) if c in df.columns]
    w = df.select(*cols).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append run rows (metrics, summaries) to a typed table; creates it on first use."""
    df.write.mode("append").format(fmt).save(path)
