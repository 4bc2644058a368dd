"""Label operators: binary encodings, histograms, frequency index, index → name.

Everything that ranks values does so on the *aggregated* value table
(one row per distinct label), never on raw rows, and every ranking has a
total order (count descending, then value ascending).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BENIGN_LABEL, LABEL_COL
from .util import ranked


def binary_label_a(label: Column | str = LABEL_COL, benign: str = BENIGN_LABEL) -> Column:
    """1.0 when the label is benign, else 0.0 (a null label counts as attack)."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c == benign, F.lit(1.0)).otherwise(F.lit(0.0))


def binary_label_b(label: Column | str = LABEL_COL, benign: str = BENIGN_LABEL) -> Column:
    """0.0 when the label is not benign, else 1.0 (a null label counts as benign)."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c != benign, F.lit(0.0)).otherwise(F.lit(1.0))


def label_histogram(df: DataFrame, label: str = LABEL_COL, count_col: str = "num_records") -> DataFrame:
    """Rows per label, largest first (ties by label)."""
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(label).asc_nulls_first())
    )


def label_set(df: DataFrame, label: str = LABEL_COL) -> DataFrame:
    """Distinct labels, sorted."""
    return df.select(label).distinct().orderBy(F.col(label).asc_nulls_first())


def top_attack_labels(
    df: DataFrame, k: int, label: str = LABEL_COL, benign: str = BENIGN_LABEL, count_col: str = "num_records"
) -> DataFrame:
    """The ``k`` most frequent non-benign labels (a null label is not a candidate)."""
    return (
        df.filter(F.col(label) != benign)
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.col(count_col).desc(), F.col(label).asc())
        .limit(k)
    )


def frequency_index(df: DataFrame, col: str, idx_col: str | None = None, count_col: str = "n") -> DataFrame:
    """Dictionary ``(value, index, n)``: index 0 = most frequent, ties alphabetical.

    Nulls are not indexed (they go to the ``keep`` bucket). Values are ranked over
    ranges, so a column may have any number of them.
    """
    idx_col = idx_col or f"{col}_idx"
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    places = ranked(counts)
    return places.select(F.col("value").alias(col), F.col("rank").cast("double").alias(idx_col), F.col("n").alias(count_col))


def apply_index(
    df: DataFrame,
    dictionary: DataFrame,
    col: str,
    out_col: str | None = None,
    dict_col: str | None = None,
    keep: bool = True,
) -> DataFrame:
    """Map ``col`` through a dictionary from :func:`frequency_index` of ``dict_col``.

    Unseen and null values get index ``len(dictionary)`` when ``keep``
    (Spark ML's ``handleInvalid='keep'``), else null. The dictionary's size
    is read through a scalar subquery, so the plan stays lazy.
    """
    dict_col = dict_col or col
    out_col = out_col or f"{col}_idx"
    d = dictionary.select(F.col(dict_col).alias("__v"), F.col(f"{dict_col}_idx").alias("__i"))
    size = dictionary.select(F.count(F.lit(1)).cast("double")).scalar()
    out = df.join(d, F.col(col) == F.col("__v"), "left")
    idx = F.coalesce(F.col("__i"), size) if keep else F.col("__i")
    return out.withColumn(out_col, idx).drop("__v", "__i")


def index_to_name(
    df: DataFrame, dictionary: DataFrame, idx_col: str, value_col: str, out_col: str = "predicted_label"
) -> DataFrame:
    """Index → name via the dictionary; an index outside it keeps its number as text."""
    d = dictionary.select(F.col(value_col).alias("__name"), F.col(f"{value_col}_idx").alias("__i"))
    out = df.join(d, F.col(idx_col) == F.col("__i"), "left")
    return out.withColumn(out_col, F.coalesce(F.col("__name"), F.col(idx_col).cast("string"))).drop(
        "__name", "__i"
    )
