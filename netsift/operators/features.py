"""Feature operators: quantiles, bucketing, nominal/IP/port/boolean bins.

Statistics for many columns are computed in ONE aggregation over a
``(feature, value)`` long form (partial aggregation map-side, so what is
shuffled is per-partition distinct values, not rows). Fitted edges reach
the rows through a scalar subquery holding one small map, so a whole
binning step is a single lazy plan.

Quantiles come in two forms:

* ``relative_error > 0`` (default 0.001, Spark ML's): the Greenwald-Khanna
  sketch of ``percentile_approx`` — bounded memory, mergeable, the form to
  use at scale;
* ``relative_error == 0``: exact quantiles from per-value counts and
  running sums within ranges of the distinct values, so that no task holds
  a whole column. Equal to DuckDB's ``quantile_disc`` and to
  ``approxQuantile(..., 0.0)``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import NOMINAL_SHARE, NUMERIC_TRIM, QUANTILE_RELATIVE_ERROR
from ..session import cut_lineage
from .util import long_form, ranked

INF = float("inf")
#: Ranges into which the distinct values of a column are cut for exact ranks.
RANGES = 64


def bucket_probs(num_buckets: int) -> list[float]:
    return [i / num_buckets for i in range(num_buckets + 1)]


def quantile_table(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    relative_error: float = QUANTILE_RELATIVE_ERROR,
) -> DataFrame:
    """``(feature, q)``: quantiles of each column at ``probs``; null and NaN ignored."""
    if relative_error > 0:
        accuracy = max(1, int(math.ceil(1.0 / relative_error)))
        one = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
        sketches = df.agg(*[F.percentile_approx(x, [float(p) for p in probs], accuracy).alias(c) for c, x in one.items()])
        both = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("q")) for c in cols])
        return sketches.select(F.inline(both)).filter("q is not null")
    long = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # cuts, range sums and ranks read the counts: stage them once
    counts = cut_lineage(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    return exact_quantiles(counts, probs)


def exact_quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(feature, q)`` from ``(feature, value, n)`` counts: rank ``ceil(p*N)`` per column.

    A sketch of the distinct values cuts each column into ``RANGES`` ranges;
    ranks are running sums within a range plus the rows of the ranges before
    it. The sketch decides how even the ranges are and never the answer.
    """
    counts = counts.filter("n > 0")
    cuts = counts.groupBy("feature").agg(
        F.percentile_approx("value", [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("cuts")
    )
    at = F.size(F.filter(F.col("__cuts")[F.col("feature")], lambda e: e <= F.col("value")))
    placed = counts.withColumn("__cuts", _edges_map(cuts, "cuts")).select("feature", at.alias("range"), "value", "n")
    sums = placed.groupBy("feature", "range").agg(F.sum("n").alias("rows"))
    # at most RANGES rows a column
    before = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "feature",
        "range",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy("feature")).alias("tot"),
    )
    run = Window.partitionBy("feature", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        placed.withColumn("cum", F.sum("n").over(run))
        .join(sums, ["feature", "range"])
        .select("feature", "value", (F.col("cum") + F.col("before")).alias("cum"), "tot")
    )
    picks = []
    for p in probs:
        # rank ceil(p*n) (1-based); p = 0 → the minimum
        target = F.greatest(F.ceil(F.lit(float(p)) * F.col("tot")), F.lit(1))
        picks.append(F.min(F.when(F.col("cum") >= target, F.col("value"))))
    return ranked.groupBy("feature").agg(F.array(*picks).alias("q"))


def value_counts(df: DataFrame, numeric_cols: Sequence[str], nominal_cols: Sequence[str]) -> DataFrame:
    """``(feature, d, s, n)``: per-value row counts of numeric (``d``) and nominal (``s``) columns.

    ONE aggregation (map-side combined) feeds both the exact quantiles and
    the nominal dictionaries; null and NaN numerics and null nominals are left out.
    """
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("d"), F.lit(None).cast("string").alias("s"))
        for c in numeric_cols
    ] + [
        F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("d"), F.col(c).cast("string").alias("s"))
        for c in nominal_cols
    ]
    long = df.select(F.inline(F.array(*items)))
    keep = (F.col("d").isNotNull() & ~F.isnan("d")) | F.col("s").isNotNull()
    return long.filter(keep).groupBy("feature", "d", "s").agg(F.count(F.lit(1)).alias("n"))


def splits_from_quantiles(q: Column) -> Column:
    """QuantileDiscretizer rule: outer quantiles → ±inf, -0.0 → 0.0, repeated edges merged."""
    inner = F.transform(F.slice(q, 2, F.size(q) - 2), lambda e: F.when(e == 0.0, F.lit(0.0)).otherwise(e))
    return F.array_distinct(F.concat(F.array(F.lit(-INF)), inner, F.array(F.lit(INF))))


def quantile_splits(
    df: DataFrame, cols: Sequence[str], num_buckets: int, relative_error: float = QUANTILE_RELATIVE_ERROR
) -> DataFrame:
    """``(feature, splits)`` as QuantileDiscretizer would fit them."""
    qt = quantile_table(df, cols, bucket_probs(num_buckets), relative_error)
    return qt.select("feature", splits_from_quantiles(F.col("q")).alias("splits"))


def bucket_of(x: Column, splits: Column) -> Column:
    """Bucketizer rule: bucket i = [s_i, s_{i+1}), last bucket closed; NaN → extra bucket; null → null.

    A higher-order ``filter`` counts the edges ≤ x (measured faster than an
    unrolled sum, whose methods grow too large to compile).
    """
    n_buckets = F.size(splits) - 1
    idx = F.size(F.filter(splits, lambda e: e <= x)) - 1
    return (
        F.when(x.isNull(), F.lit(None))
        .when(F.isnan(x), n_buckets)
        .otherwise(F.least(F.greatest(idx, F.lit(0)), n_buckets - 1))
        .cast("double")
    )


def _edges_map(table: DataFrame, value_col: str) -> Column:
    return table.select(F.map_from_entries(F.collect_list(F.struct("feature", value_col)))).scalar()


def _edges_struct(table: DataFrame, value_col: str, cols: Sequence[str]) -> Column:
    """One-row struct ``{col: value}`` of the fitted values (scalar subquery)."""
    return table.select(
        F.struct(*[F.max(F.when(F.col("feature") == c, F.col(value_col))).alias(c) for c in cols])
    ).scalar()


def quantile_bins(
    df: DataFrame,
    cols: Sequence[str],
    num_buckets: int,
    relative_error: float = QUANTILE_RELATIVE_ERROR,
    suffix: str = "_bin",
) -> DataFrame:
    """Add ``<col>_bin``: quantile buckets fitted on ``df``."""
    splits = quantile_splits(df, cols, num_buckets, relative_error)
    out = df.withColumn("__splits", _edges_struct(splits, "splits", cols))
    out = out.withColumns(
        {
            f"{c}{suffix}": bucket_of(F.col(c).cast("double"), F.col("__splits")[c])
            for c in cols
        }
    )
    return out.drop("__splits")


def fixed_edge_bins(
    df: DataFrame, splits: Mapping[str, Sequence[float]], handle_invalid: str = "error", suffix: str = "_bin"
) -> DataFrame:
    """Apply given edges with Spark ML's Bucketizer (F6); out of range → error by default."""
    cols = list(splits)
    b = Bucketizer(
        splitsArray=[list(map(float, splits[c])) for c in cols],
        inputCols=cols,
        outputCols=[f"{c}{suffix}" for c in cols],
        handleInvalid=handle_invalid,
    )
    return b.transform(df)


def trimmed_bin(x: Column, lo: Column, hi: Column, bins: int = 10) -> Column:
    """Equal-width bins inside [lo, hi]: below → 0, above → bins+1, null → -1."""
    width = (x - lo) / (hi - lo) * F.lit(float(bins))
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(-1))
        .when(x < lo, F.lit(0))
        .when(x > hi, F.lit(bins + 1))
        .when(hi == lo, F.lit(1))
        .otherwise(F.lit(1) + F.least(F.floor(width).cast("int"), F.lit(bins - 1)))
        .cast("int")
    )


def trimmed_numeric_bins(
    df: DataFrame,
    cols: Sequence[str],
    trim: float = NUMERIC_TRIM,
    bins: int = 10,
    relative_error: float = QUANTILE_RELATIVE_ERROR,
    suffix: str = "_bin",
) -> DataFrame:
    """Add ``<col>_bin`` with 2 % tails cut off (F8, inferred contract)."""
    return apply_trimmed(df, cols, quantile_table(df, cols, [trim, 1.0 - trim], relative_error), bins, suffix)


def apply_trimmed(df: DataFrame, cols: Sequence[str], qt: DataFrame, bins: int = 10, suffix: str = "_bin") -> DataFrame:
    """Apply trimmed bins given a ``(feature, [lo, hi])`` table.

    The edges reach the rows as plain columns of one broadcast row: as a scalar subquery they are looked up
    in every place where the expressions name them (measured tenfold slower).
    """
    edges = [F.max(F.when(F.col("feature") == c, F.col("q")[i])).alias(f"__{i}_{c}") for c in cols for i in (0, 1)]
    out = df.crossJoin(F.broadcast(qt.agg(*edges))) if cols else df
    exprs = {f"{c}{suffix}": trimmed_bin(F.col(c).cast("double"), F.col(f"__0_{c}"), F.col(f"__1_{c}"), bins) for c in cols}
    return out.withColumns(exprs).drop(*[f"__{i}_{c}" for c in cols for i in (0, 1)])


def nominal_dictionary(df: DataFrame, cols: Sequence[str], share: float = NOMINAL_SHARE) -> DataFrame:
    """``(feature, value, idx, other_idx)`` for the values kept by the share rule.

    Values are ranked by (count desc, value asc); a value is kept while the
    share of rows ranked before it is below ``share``. All other values and
    null map to ``other_idx`` = number of kept values.
    """
    long = long_form(df, cols, "string").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return nominal_from_counts(counts, share)


def nominal_from_counts(counts: DataFrame, share: float = NOMINAL_SHARE) -> DataFrame:
    """Share rule over ``(feature, value, n)`` counts (see :func:`nominal_dictionary`)."""
    kept = cut_lineage(ranked(counts, ["feature"]).filter(F.col("before") / F.col("tot") < F.lit(float(share))))
    sizes = kept.groupBy("feature").agg(F.count("*").cast("int").alias("size"))
    return kept.select("feature", "value", F.col("rank").cast("int").alias("idx"), _edges_map(sizes, "size")[F.col("feature")].alias("other_idx"))


#: Most frequent values of a column that are broadcast; rarer ones are joined by shuffle.
HEAD = 10_000


def nominal_bins(
    df: DataFrame,
    cols: Sequence[str],
    share: float = NOMINAL_SHARE,
    suffix: str = "_bin",
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Add ``<col>_bin`` nominal indexes with the tail folded into one index.

    The dictionary (kept values only, staged when it is fitted) is read by one join
    per column. A nominal column may hold three values, and a shuffle by it would leave three
    tasks with rows; so the ``HEAD`` most frequent values, a bounded number, are broadcast. Only a column with
    more values has a second join, by shuffle, which deals rows that need no
    value from it by a hash of the row: none of its values has more than a ``HEAD``-th of the rows.
    """
    dictionary = dictionary if dictionary is not None else nominal_dictionary(df, cols, share)
    # one row per column
    sizes = {r["feature"]: r["n"] for r in dictionary.groupBy("feature").agg(F.max("other_idx").alias("n")).collect()}
    out = df
    for c in cols:
        d = dictionary.filter(F.col("feature") == c).select(F.col("value").alias(f"__v_{c}"), F.col("idx").alias(f"__i_{c}"))
        found = f"__i_{c}"
        out = out.join(F.broadcast(d.filter(F.col(found) < HEAD)), F.col(c).cast("string") == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
        if sizes.get(c, 0) > HEAD:
            asked = F.when(F.col(found).isNull(), F.col(c).cast("string"))
            dealt = F.when(asked.isNull(), F.xxhash64(*[x for x in df.columns])).otherwise(F.lit(0).cast("long"))
            tail = d.filter(F.col(found) >= HEAD).select(F.col(f"__v_{c}").alias("__tv"), F.col(found).alias("__ti"), F.lit(0).cast("long").alias("__ts"))
            out = out.withColumns({"__asked": asked, "__dealt": dealt})
            out = out.join(tail, (F.col("__asked") == F.col("__tv")) & (F.col("__dealt") == F.col("__ts")), "left")
            out = out.withColumn(found, F.coalesce(found, "__ti")).drop("__asked", "__dealt", "__tv", "__ti", "__ts")
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(found), F.lit(sizes.get(c, 0))).cast("int")).drop(found)
    return out


#: One to three digits, at most 255.
_OCTET = "(?:[01]?[0-9]{1,2}|2[0-4][0-9]|25[0-5])"
IPV4_PATTERN = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ip_class(ip: Column) -> Column:
    """IPv4 class by first octet: A 1, B 2, C 3, D 4, E 5; anything else 0 (F10, inferred)."""
    s = ip.cast("string")
    # one match: the other octets are never extracted
    first = F.substring_index(s, ".", 1).try_cast("int")
    return (
        F.when(s.isNull() | ~s.rlike(IPV4_PATTERN), F.lit(0))
        .when(first <= 127, F.lit(1))
        .when(first <= 191, F.lit(2))
        .when(first <= 223, F.lit(3))
        .when(first <= 239, F.lit(4))
        .otherwise(F.lit(5))
        .cast("int")
    )


def port_class(port: Column) -> Column:
    """Well-known 1, registered 2, dynamic 3; null or out of range 0 (F11, inferred)."""
    x = port.cast("double")
    return (
        F.when(x.isNull(), F.lit(0))
        .when((x >= 0) & (x < 1024), F.lit(1))
        .when((x >= 1024) & (x < 49152), F.lit(2))
        .when((x >= 49152) & (x < 65536), F.lit(3))
        .otherwise(F.lit(0))
        .cast("int")
    )


def bool_class(b: Column) -> Column:
    """false 0, true 1, null 2 (F12, inferred)."""
    return F.when(b.isNull(), F.lit(2)).when(b, F.lit(1)).otherwise(F.lit(0)).cast("int")


def full_binning(
    df: DataFrame,
    ip_cols: Sequence[str],
    port_cols: Sequence[str],
    bool_cols: Sequence[str],
    nominal_cols: Sequence[str],
    nominal_share: float,
    numeric_cols: Sequence[str],
    numeric_trim: float,
    relative_error: float = QUANTILE_RELATIVE_ERROR,
    suffix: str = "_bin",
) -> DataFrame:
    """All binning rules in one call; adds ``<col>_bin`` and keeps the inputs."""
    out = df.withColumns(
        {f"{c}{suffix}": ip_class(F.col(c)) for c in ip_cols}
        | {f"{c}{suffix}": port_class(F.col(c)) for c in port_cols}
        | {f"{c}{suffix}": bool_class(F.col(c)) for c in bool_cols}
    )
    probs = [numeric_trim, 1.0 - numeric_trim]
    if relative_error == 0:
        counts = cut_lineage(value_counts(df, numeric_cols, nominal_cols))
        num = counts.filter(F.col("d").isNotNull()).select("feature", F.col("d").alias("value"), "n")
        nom = counts.filter(F.col("s").isNotNull()).select("feature", F.col("s").alias("value"), "n")
        qt, dictionary = exact_quantiles(num, probs), nominal_from_counts(nom, nominal_share)
    else:
        qt = quantile_table(df, numeric_cols, probs, relative_error)
        dictionary = nominal_dictionary(df, nominal_cols, nominal_share)
    out = apply_trimmed(out, numeric_cols, qt, 10, suffix)
    return nominal_bins(out, nominal_cols, nominal_share, suffix, dictionary=dictionary)


def distinct_per_feature(df: DataFrame, cols: Sequence[str], relative_error: float = 0.0) -> DataFrame:
    """``(feature, n_distinct)``; null counts as one value, like ``distinct().count()``.

    With ``relative_error`` above 0 the counts are estimates of that standard
    error from one aggregation without a shuffle of the values.
    """
    if relative_error > 0:
        one = lambda c: F.approx_count_distinct(c, relative_error) + F.max(F.col(c).isNull().cast("int"))
        n = df.agg(*[F.coalesce(one(c), F.lit(0)).cast("long").alias(c) for c in cols])
        return n.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_distinct")) for c in cols])))
    long = long_form(df, cols, "string")
    return long.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
