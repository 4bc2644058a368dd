"""Small plan helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def long_form(df: DataFrame, cols: Sequence[str], value_type: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """``(feature, value)`` rows: one per input row and listed column.

    Used for per-column statistics in ONE aggregation (map-side combined)
    instead of one job per column.
    """
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value")) for c in cols])
    return df.select(*keep, F.inline(arr))


def ranked(counts: DataFrame, group: Sequence[str] = (), value: str = "value", weight: str = "n") -> DataFrame:
    """``counts`` with ``rank`` (from 0, by weight descending, then value), ``before`` and ``tot`` per group.

    ``before`` is the weight of the values ranked ahead, ``tot`` the group's. The values are
    range-partitioned by (group, weight, value); a rank is the place within its range
    plus the rows of the ranges before it, so no task holds all values of a
    group. The ranges depend on a sample, the ranks do not.
    """
    order = [F.col(weight).desc(), F.col(value).asc()]
    placed = cut_lineage(counts.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()))
    sums = placed.groupBy(*group, "__range").agg(F.count("*").alias("__rows"), F.sum(weight).alias("__weight"))
    # one row per group and range from here
    ahead = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *group,
        "__range",
        F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum("__weight").over(ahead), F.lit(0)).alias("__weight"),
        F.sum("__weight").over(Window.partitionBy(*group)).alias("tot"),
    )
    within = Window.partitionBy(*group, "__range").orderBy(*order)
    run = within.rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({"rank": F.row_number().over(within) - 1, "before": F.sum(weight).over(run) - F.col(weight)})
        .join(sums, [*group, "__range"])
        .select(*counts.columns, (F.col("rank") + F.col("__rows")).alias("rank"), (F.col("before") + F.col("__weight")).alias("before"), "tot")
    )
