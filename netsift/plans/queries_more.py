"""Registered queries: balance, features, metrics, routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.casts import bool_to_double
from ..operators import balance, clean, features, labels, metrics, routing
from ..sources import tables
from .queries import register

# Golden bin edges fitted by the reference's saved 12-attribute model
# (inner edges; outer edges are -inf / +inf). Fixed values.
GOLDEN_INNER_EDGES = {
    "src_port": [27423, 34983, 37675, 40367, 43057, 45771, 52896],
    "dest_port": [53, 123, 4848],
    "orig_bytes": [43, 47, 64, 163, 686, 1043],
    "orig_pkts": [1, 3, 6, 40, 44, 48],
    "orig_ip_bytes": [71, 86, 202, 336, 4856, 5480, 6552],
    "resp_bytes": [0, 43, 58, 163, 11329, 16681],
    "resp_pkts": [0, 1, 3, 48, 68],
    "resp_ip_bytes": [0, 71, 86, 247, 47844, 70292],
    "missed_bytes": [0],
    "local_resp": [0],
}
NUMERIC_PORTS = list(C.NUMERIC_COLS + C.PORT_COLS)
F12_NUMERIC = [c for c in C.F12_FEATURES if c not in ("protocol", "conn_state")]
Q_PROBS = [i / 8 for i in range(1, 8)]


def _conn(spark, sf) -> DataFrame:
    return tables.conn_records(spark, sf)


def _clean_f12(spark, sf) -> DataFrame:
    """Evaluation input: f12 + label, booleans as 1.0/0.0, rows with nulls dropped."""
    conn = _conn(spark, sf).select("key", *C.F12_FEATURES, C.LABEL_COL, "rule_label")
    return clean.drop_null_subset(clean.cast_columns(conn), list(C.F12_FEATURES) + [C.LABEL_COL])


def _scored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Rule-scored rows with label and prediction indexed by the label dictionary."""
    conn = _conn(spark, sf)
    d = labels.frequency_index(conn, C.LABEL_COL).cache()  # read by two joins; one row per class
    t = labels.apply_index(conn.select("key", C.LABEL_COL, "rule_label"), d, C.LABEL_COL, "label")
    t = labels.apply_index(t, d, "rule_label", "prediction", dict_col=C.LABEL_COL)
    return t, d


# --- balance -----------------------------------------------------------------


@register("benign_needed")
def benign_needed(spark, sf):
    return balance.slice_plan(_conn(spark, sf), C.TOP_K_LABELS, C.ATTACK_SHARE)


@register("hash_sample")
def hash_sample(spark, sf):
    benign = _conn(spark, sf).filter(F.col(C.LABEL_COL) == C.BENIGN_LABEL).select("key", C.LABEL_COL)
    return balance.hash_sample(benign, 0.25)


@register("label_slices")
def label_slices(spark, sf):
    return balance.label_slices(_conn(spark, sf), 3).select("slice", "key")


@register("single_slice")
def single_slice(spark, sf):
    return balance.single_slice(_conn(spark, sf)).select("key", "slice", C.LABEL_COL)


@register("rebalanced_rows")
def rebalanced_rows(spark, sf):
    reb = balance.rebalance(_conn(spark, sf), C.TOP_K_LABELS, C.ATTACK_SHARE)
    return reb.select("slice", "key", "copy", C.LABEL_COL)


@register("rebalanced_counts")
def rebalanced_counts(spark, sf):
    reb = balance.rebalance(_conn(spark, sf), C.TOP_K_LABELS, C.ATTACK_SHARE)
    return reb.groupBy("slice", C.LABEL_COL).agg(F.count(F.lit(1)).alias("n_rows"))


@register("min_rows_gate")
def min_rows_gate(spark, sf):
    reb = balance.rebalance(_conn(spark, sf), C.TOP_K_LABELS, C.ATTACK_SHARE)
    gated = balance.min_rows_gate(reb, C.MIN_SLICE_ROWS)
    return gated.groupBy("slice").agg(F.count(F.lit(1)).alias("n_rows"))


@register("hash_split")
def hash_split(spark, sf):
    return balance.hash_split(_conn(spark, sf), C.EVAL_TRAIN_FRACTION).select("key", "split")


@register("page_slice")
def page_slice(spark, sf):
    ev = tables.table(spark, sf, "events").select("event_id", "event_type")
    return balance.pages(ev, "event_id", C.FETCH_BATCH_SIZE)


# --- features ----------------------------------------------------------------


@register("column_quantiles")
def column_quantiles(spark, sf):
    qt = features.quantile_table(_clean_f12(spark, sf), F12_NUMERIC, Q_PROBS, relative_error=0.0)
    return qt.select("feature", F.posexplode("q").alias("i", "q")).select(
        "feature", ((F.col("i") + 1) / 8.0).alias("p"), "q"
    )


@register("quantile_bins")
def quantile_bins(spark, sf):
    df = _clean_f12(spark, sf)
    out = features.quantile_bins(df, F12_NUMERIC, C.QUANTILE_BUCKETS_F12, relative_error=0.0)
    return out.select("key", *[f"{c}_bin" for c in F12_NUMERIC])


@register("fixed_edge_bins")
def fixed_edge_bins(spark, sf):
    df = _clean_f12(spark, sf)
    splits = {c: [float("-inf"), *e, float("inf")] for c, e in GOLDEN_INNER_EDGES.items()}
    out = features.fixed_edge_bins(df, splits, handle_invalid="keep")
    return out.select("key", *[f"{c}_bin" for c in splits])


@register("trimmed_numeric_bins")
def trimmed_numeric_bins(spark, sf):
    out = features.trimmed_numeric_bins(_conn(spark, sf), list(C.NUMERIC_COLS), relative_error=0.0)
    return out.select("key", *[f"{c}_bin" for c in C.NUMERIC_COLS])


@register("nominal_bins")
def nominal_bins(spark, sf):
    out = features.nominal_bins(_conn(spark, sf), list(C.CATEGORICAL_COLS), C.NOMINAL_SHARE)
    return out.select("key", *[f"{c}_bin" for c in C.CATEGORICAL_COLS])


@register("ip_bins")
def ip_bins(spark, sf):
    conn = _conn(spark, sf)
    return conn.select("key", *[features.ip_class(F.col(c)).alias(f"{c}_bin") for c in C.IP_COLS])


@register("port_bins")
def port_bins(spark, sf):
    conn = _conn(spark, sf)
    return conn.select("key", *[features.port_class(F.col(c)).alias(f"{c}_bin") for c in C.PORT_COLS])


@register("bool_bins")
def bool_bins(spark, sf):
    conn = _conn(spark, sf)
    return conn.select("key", *[features.bool_class(F.col(c)).alias(f"{c}_bin") for c in C.BOOLEAN_COLS])


@register("full_binning")
def full_binning(spark, sf):
    out = features.full_binning(
        _conn(spark, sf),
        C.IP_COLS,
        C.PORT_COLS,
        C.BOOLEAN_COLS,
        C.CATEGORICAL_COLS,
        C.NOMINAL_SHARE,
        C.NUMERIC_COLS,
        C.NUMERIC_TRIM,
        relative_error=0.0,
    )
    return out.select("key", *[c for c in out.columns if c.endswith("_bin")])


@register("distinct_per_feature")
def distinct_per_feature(spark, sf):
    return features.distinct_per_feature(_conn(spark, sf), list(C.PRESETS["f16"]))


# --- metrics -------------------------------------------------------------------


@register("confusion_matrix")
def confusion_matrix(spark, sf):
    scored, _ = _scored(spark, sf)
    return metrics.confusion_counts(scored)


@register("overall_metrics")
def overall_metrics(spark, sf):
    scored, _ = _scored(spark, sf)
    return metrics.overall(metrics.confusion_counts(scored))


@register("per_class_metrics")
def per_class_metrics(spark, sf):
    scored, d = _scored(spark, sf)
    pc = metrics.per_class(metrics.confusion_counts(scored))
    return labels.index_to_name(pc, d, "label", C.LABEL_COL, "label_name")


@register("metrics_at_label")
def metrics_at_label(spark, sf):
    scored, _ = _scored(spark, sf)
    return metrics.at_label(metrics.confusion_counts(scored), 1.0)


@register("hard_auc")
def hard_auc(spark, sf):
    conn = _conn(spark, sf)
    scored = conn.select(
        labels.binary_label_a(C.LABEL_COL).alias("label"), labels.binary_label_a("rule_label").alias("prediction")
    )
    return metrics.hard_auc(metrics.confusion_counts(scored), 1.0)


@register("matrix_text")
def matrix_text(spark, sf):
    scored, _ = _scored(spark, sf)
    return metrics.matrix_text(metrics.confusion_counts(scored))


@register("run_report")
def run_report(spark, sf):
    scored, d = _scored(spark, sf)
    return metrics.run_report(metrics.confusion_counts(scored), d, f"{C.LABEL_COL}_idx", C.LABEL_COL)


# --- routing -------------------------------------------------------------------


@register("route_binary")
def route_binary(spark, sf):
    conn = _conn(spark, sf).select("key", labels.binary_label_a("rule_label").alias("prediction"))
    return routing.with_topics(conn, routing.route_binary(F.col("prediction"))).select("key", "prediction", "topic")


@register("route_multiclass")
def route_multiclass(spark, sf):
    scored, _ = _scored(spark, sf)
    out = routing.with_topics(scored, routing.route_multiclass(F.col("prediction")))
    return out.select("key", "prediction", "topic")


@register("route_by_name")
def route_by_name(spark, sf):
    scored, d = _scored(spark, sf)
    named = labels.index_to_name(scored, d, "prediction", C.LABEL_COL, "predicted_label")
    out = routing.with_topics(named, routing.route_by_name(F.col("predicted_label")))
    return out.select("key", "predicted_label", "topic")
