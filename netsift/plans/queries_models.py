"""Registered queries that train models (rows-only checks: no SQL twin)."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import config as C
from ..operators import balance, clean, features, forest, labels, metrics
from ..session import cut_lineage, scratch_path
from ..sources import tables
from . import training
from .queries import register

#: Levels of the tree that SQL grows as well.
TREE_DEPTH = 4


@register("rf_multiclass")
def rf_multiclass(spark, sf):
    """12-attribute multiclass forest (10 trees, depth 10): per-class metrics on the 30 % hold-out."""
    return training.flagship(spark, sf)


@register("rf_binary")
def rf_binary(spark, sf):
    """16-attribute binary forest (20 trees, depth 10, 32 quantile bins), 0.8 hash split."""
    conn = clean.cast_columns(tables.conn_records(spark, sf)).withColumn("label_bin", labels.binary_label_a())
    conn = cut_lineage(conn.select("key", *C.PRESETS["f16"], C.LABEL_COL, "label_bin"))
    train, test = balance.split_frames(conn, C.TRAIN_FRACTION)
    train = clean.drop_null_subset(train, [*C.PRESETS["f16"], C.LABEL_COL])
    pipeline, _, label_col = training.build_pipeline_f16("binary")
    model = training.fit_staged(pipeline, train)
    scored = model.transform(test)
    return metrics.summary(metrics.confusion_counts(scored, label_col, "prediction"), 1.0)


@register("rf_default")
def rf_default(spark, sf):
    """Forest with library defaults on the 18 binned attributes."""
    return training.compare_models(spark, sf, learners=("rf",))


@register("gbt_binary")
def gbt_binary(spark, sf):
    return training.compare_models(spark, sf, learners=("gbt",))


@register("compare_models")
def compare_models(spark, sf):
    return training.compare_models(spark, sf, learners=("rf", "gbt"))


@register("feature_sweep")
def feature_sweep(spark, sf):
    return training.feature_sweep(spark, sf)


@register("per_label_experiment")
def per_label_experiment(spark, sf):
    return training.per_label_experiment(spark, sf)


@register("scored_prediction_int")
def scored_prediction_int(spark, sf):
    """Batch scoring (L5) with the prediction cast to int."""
    model, scored, _ = training.train_eval_f12(spark, sf)
    scored = training.add_predicted_label(model, scored)
    return scored.select("key", F.col("prediction").cast("int").alias("prediction"), "predicted_label", C.LABEL_COL)


@register("forest_scored")
def forest_scored(spark, sf):
    """Every held-out record scored by the forest's node table (built-in functions only)."""
    model, scored, _ = training.train_eval_f12(spark, sf)
    nodes = forest.node_table(spark, model, scratch_path(spark, f"forest-{uuid.uuid4().hex[:12]}"))
    rows = scored.select("key", vector_to_array("features").alias("features"))
    named = training.add_predicted_label(model, forest.score(rows, nodes, model))
    return named.select("key", F.col("prediction").cast("int").alias("prediction"), "predicted_label")


@register("tree_scored")
def tree_scored(spark, sf):
    """L1/L5 with an SQL twin: one exact tree on the quantile bins, grown on the training part, scores every record."""
    df = clean.drop_null_subset(
        clean.cast_columns(tables.conn_records(spark, sf).select("key", *C.F12_FEATURES, C.LABEL_COL)), [*C.F12_FEATURES, C.LABEL_COL]
    )
    numeric = [c for c in C.F12_FEATURES if c not in C.CATEGORICAL_COLS]
    bins = [f"{c}_bin" for c in numeric]
    binned = features.quantile_bins(df, numeric, C.QUANTILE_BUCKETS_F12, relative_error=0.0)
    binned = cut_lineage(binned.select("key", labels.binary_label_a().alias("label_bin"), *bins))
    train, _ = balance.split_frames(binned, C.EVAL_TRAIN_FRACTION)
    assembler = VectorAssembler(inputCols=bins, outputCol="features")
    model = forest.exact_tree(assembler.transform(train), "features", "label_bin", TREE_DEPTH)
    nodes = forest.node_table(spark, model, scratch_path(spark, f"tree-{uuid.uuid4().hex[:12]}"))
    out = forest.score(binned.select("key", F.array(*bins).alias("features")), nodes, model)
    return out.select("key", "prediction", F.col("votes")[1].alias("benign_share"))
