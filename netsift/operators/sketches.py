"""Column statistics that grow with the data: stored sketches, merged without a rescan.

Each load of a dataset is summarised once, in one aggregation that shuffles
sketches and no values: a KLL sketch of the quantiles of every numeric column and
an HLL sketch of the distinct values of every column. The store holds one row per
(load, feature); a load that is summarised again replaces its rows. Quantiles,
bucket edges and distinct counts of any set of loads come from merged rows alone.

Errors: a quantile's rank is within :func:`rank_error` of the asked one with
high confidence, a distinct count has the relative standard error
:func:`distinct_error`. The exact forms stay in :mod:`netsift.operators.features`.

Edge cases: null and NaN numbers are in no quantile; null counts as one distinct value; a
column without values has null sketches and no quantiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import bucket_probs, splits_from_quantiles

#: Sizes of the sketches: KLL's k and the logarithm of HLL's registers.
K, LOG_REGISTERS = 1024, 14
SCHEMA = "feature string, n long, nulls long, quantiles binary, distinct binary"


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch at 99 % confidence (published fit for one-sided queries)."""
    return 2.296 / k**0.9021


def distinct_error(log_registers: int = LOG_REGISTERS) -> float:
    return 1.04 / math.sqrt(2**log_registers)


def summarise(df: DataFrame, numeric: Sequence[str], nominal: Sequence[str] = (), k: int = K, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """One row per column: ``feature, n, nulls, quantiles, distinct``."""
    aggregates = {}
    for c in [*numeric, *nominal]:
        x = F.col(c).cast("double") if c in numeric else None
        usable = x.isNotNull() & ~F.isnan(x) if c in numeric else F.col(c).isNotNull()
        n = F.count(F.when(usable, 1))
        fields = [
            F.lit(c).alias("feature"),
            n.alias("n"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"),
            (F.when(n > 0, F.kll_sketch_agg_double(F.when(usable, x), k)) if c in numeric else F.lit(None).cast("binary")).alias("quantiles"),
            F.when(F.count(c) > 0, F.hll_sketch_agg(F.col(c).cast("string"), log_registers)).alias("distinct"),
        ]
        aggregates[c] = F.struct(*fields).alias(c)
    one = df.agg(*aggregates.values())
    return one.select(F.inline(F.array(*[F.col(f"`{c}`") for c in aggregates])))


def store_load(rows: DataFrame, store: str, load: str) -> None:
    """Write a load's rows as ``<store>/load=<load>``, in place of earlier ones."""
    rows.write.mode("overwrite").parquet(f"{store}/load={load}")


def stored(spark: SparkSession, store: str) -> DataFrame:
    """All rows: ``load`` and those of :func:`summarise`."""
    return spark.read.schema(f"{SCHEMA}, load string").parquet(store)


def merged(rows: DataFrame) -> DataFrame:
    """One row per feature over all ``rows`` (any selection of loads)."""
    return rows.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.when(F.count("quantiles") > 0, F.kll_merge_agg_double("quantiles")).alias("quantiles"),
        F.when(F.count("distinct") > 0, F.hll_union_agg("distinct")).alias("distinct"),
    )


def quantiles(summary: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(feature, n, q)``: approximate quantiles at ``probs`` of the columns that have values."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    return summary.filter("quantiles IS NOT NULL AND n > 0").select(
        "feature", "n", F.kll_sketch_get_quantile_double("quantiles", asked).alias("q")
    )


def splits(summary: DataFrame, num_buckets: int) -> DataFrame:
    """``(feature, splits)``: bucket edges refitted from the sketches, for :func:`features.bucket_of`."""
    return quantiles(summary, bucket_probs(num_buckets)).select("feature", splits_from_quantiles(F.col("q")).alias("splits"))


def distinct_counts(summary: DataFrame) -> DataFrame:
    """``(feature, n_distinct)``: estimated distinct values, null counted as one."""
    has_null = F.when(F.col("nulls") > 0, 1).otherwise(0)
    estimate = F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0))
    return summary.select("feature", (estimate + has_null).cast("long").alias("n_distinct"))
