"""Class rebalancing, slicing, sampling and splitting as single Spark plans.

The reference builds one DataFrame per attack label in a driver loop and
counts each several times. Here every slice lives in one DataFrame with a
``slice`` column:

* the slice plan (attack rows per slice → benign rows needed, full benign
  copies, remainder fraction) is an aggregate over the label histogram,
  at most ``top_k`` rows;
* rows meet that plan through a scalar subquery (one tiny array),
  so no join and no driver loop is involved, and each benign row is
  emitted ``copies + [hash < fraction]`` times per slice with
  ``explode(sequence(...))`` — a narrow, shuffle-free step;
* sampling and splitting decide by a content hash of the row key, so a
  recomputed partition (lost executor, speculative task) yields exactly the
  same rows, and the decision is the same in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ALL_LABELS_SLICE, ATTACK_SHARE, BENIGN_LABEL, LABEL_COL, MIN_SLICE_ROWS
from ..functions.hashing import hash_bucket, unit_hash
from .labels import top_attack_labels

SAMPLE_SALT = "sample|"
SPLIT_SALT = "split|"


def check_share(p: float) -> float:
    if not (0.0 < p <= 1.0):
        raise ValueError("attack share must satisfy 0.0 < p <= 1.0")
    return float(p)


def benign_needed(attack_count: Column, p: float) -> Column:
    """Benign rows that make ``attack_count`` a share ``p`` of the slice."""
    p = check_share(p)
    return (F.lit(1.0 - p) * attack_count.cast("double")) / F.lit(p)


def hash_sample(df: DataFrame, fraction: float | Column, key: str = "key", salt: str = SAMPLE_SALT) -> DataFrame:
    """Bernoulli-like sample without replacement decided by the key's hash."""
    frac = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return df.filter(unit_hash(key, salt) < frac)


def hash_split(
    df: DataFrame, train_fraction: float, key: str = "key", salt: str = SPLIT_SALT, col: str = "split"
) -> DataFrame:
    """Tag each row ``train``/``test``; stable under repartitioning and re-runs."""
    cut = int(round(train_fraction * 1000))
    return df.withColumn(col, F.when(hash_bucket(key, 1000, salt) < cut, "train").otherwise("test"))


def split_frames(df: DataFrame, train_fraction: float, key: str = "key") -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key, 1000, SPLIT_SALT)
    cut = int(round(train_fraction * 1000))
    return df.filter(b < cut), df.filter(b >= cut)


def single_slice(df: DataFrame, name: str = ALL_LABELS_SLICE, col: str = "slice") -> DataFrame:
    """Multiclass runs: every row in one slice."""
    return df.withColumn(col, F.lit(name))


def label_slices(
    df: DataFrame, k: int, label: str = LABEL_COL, benign: str = BENIGN_LABEL, col: str = "slice"
) -> DataFrame:
    """Rows of the ``k`` most frequent attack labels, tagged with their slice.

    The top-k table has at most ``k`` rows (a limit), so the semi-join
    broadcasts a side of proven size.
    """
    top = top_attack_labels(df, k, label, benign).select(F.col(label).alias("__s"))
    return df.join(F.broadcast(top), F.col(label) == F.col("__s"), "left_semi").withColumn(col, F.col(label))


def slice_plan(
    df: DataFrame, k: int, p: float = ATTACK_SHARE, label: str = LABEL_COL, benign: str = BENIGN_LABEL
) -> DataFrame:
    """Per slice: attack rows, benign rows needed, full copies, remainder fraction.

    ``copies = floor(need / B)`` whole benign copies and a sample of
    ``(need mod B) / B`` of the benign rows, ``B`` = benign row count.
    No benign rows at all is an error.
    """
    check_share(p)
    attack = F.col(label) != benign
    ranked = F.array_sort(F.collect_list(F.when(attack, F.struct((-F.col("n")).alias("minus"), F.col(label).alias("slice")))))
    # one row over the histogram: the benign count and the top k labels (ties by label)
    one = (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(F.col(label) == benign, F.col("n"))).cast("double"), F.lit(0.0)).alias("b"),
            F.slice(ranked, 1, k).alias("top"),
        )
    )
    b = F.col("b")
    return one.select("b", F.inline("top")).select(
        "slice",
        (-F.col("minus")).alias("attack_rows"),
        benign_needed(-F.col("minus"), p).alias("benign_needed"),
        F.when(b > 0, b).otherwise(F.raise_error(F.lit("no benign rows to rebalance with"))).alias("benign_rows"),
    ).select(
        "slice",
        "attack_rows",
        "benign_needed",
        "benign_rows",
        F.floor(F.col("benign_needed") / F.col("benign_rows")).cast("int").alias("copies"),
        (F.col("benign_needed") % F.col("benign_rows") / F.col("benign_rows")).alias("fraction"),
    )


def rebalance(
    df: DataFrame,
    k: int,
    p: float = ATTACK_SHARE,
    label: str = LABEL_COL,
    benign: str = BENIGN_LABEL,
    key: str = "key",
) -> DataFrame:
    """Attack slice + ``copies`` full benign copies + a hashed remainder sample.

    Output: input columns plus ``slice`` and ``copy`` (0 for attack rows,
    1..n for the benign copies of a row within a slice). Two passes over
    ``df``: the histogram behind the plan, and one scan in which each row
    finds the slices it belongs to and the range of its copies there.
    """
    plan = slice_plan(df, k, p, label, benign).select(F.collect_list(F.struct("slice", "copies", "fraction")).alias("p"))
    u = unit_hash(key, SAMPLE_SALT)

    def place(slice_: Column, first: Column, last: Column) -> Column:
        return F.struct(slice_.alias("slice"), first.alias("__a"), last.cast("int").alias("__b"))

    zero = F.lit(0)
    as_attack = F.transform(F.filter("__plan", lambda s: s["slice"] == F.col(label)), lambda s: place(s["slice"], zero, zero))
    as_benign = F.transform(
        "__plan", lambda s: place(s["slice"], F.lit(1), s["copies"] + F.when(F.col("__u") < s["fraction"], 1).otherwise(0))
    )
    return (
        df.withColumns({"__plan": plan.scalar(), "__u": u})
        .select(*df.columns, F.inline(F.when(F.col(label) == benign, as_benign).otherwise(as_attack)))
        .filter(F.col("__b") >= F.col("__a"))
        .withColumn("copy", F.explode(F.sequence("__a", "__b")))
        .drop("__a", "__b")
    )


def min_rows_gate(df: DataFrame, n: int = MIN_SLICE_ROWS, col: str = "slice") -> DataFrame:
    """Keep only slices with at least ``n`` rows.

    The per-slice count table has one row per slice (≤ top-k), so it is
    broadcast for the semi-join.
    """
    ok = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= n).select(col)
    return df.join(F.broadcast(ok), col, "left_semi")


def pages(df: DataFrame, seq_col: str, limit: int) -> DataFrame:
    """Offset/limit paging over a dense sequence column: page number and offset.

    Page ``i`` holds ``seq in [i*limit, (i+1)*limit)``; a reader fetching all
    pages gets every row exactly once.
    """
    if not 1 <= limit <= 10000:
        raise ValueError("page limit must be within 1..10000")
    page = F.floor(F.col(seq_col) / F.lit(limit)).cast("long")
    return df.withColumns({"page": page, "page_offset": (page * limit).cast("long")})
