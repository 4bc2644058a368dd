"""Plans that hold at scale, and edge values the tables lack."""

import pytest
from pyspark.sql import functions as F

from netsift import config as C
from netsift.functions.casts import wire_bool, wire_number
from netsift.operators import balance, clean, features
from netsift.plans import training
from netsift.sources import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_wire_edges(spark):
    df = spark.createDataFrame([("\ttrue\n", "1d"), (" YES ", "\t2.5\n"), ("0", "-1e2"), (None, None), ("", ".5")], "b string, n string")
    got = df.select(wire_bool("b").alias("b"), wire_number("n").alias("n")).collect()
    assert [r["b"] for r in got][2:] == [False, False, False] and got[0]["b"]
    assert [r["n"] for r in got] == [0.0, 2.5, -100.0, 0.0, 0.5]


def test_null_tests_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    df.write.parquet(str(tmp_path / "t"))
    got = clean.drop_null_any(spark.read.parquet(str(tmp_path / "t")))
    assert [tuple(r) for r in got.collect()] == [(1.0, "a")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(x)" in plan and "IsNotNull(s)" in plan


def test_rebalance_scans_its_input_twice(spark, sf_small):
    reb = balance.rebalance(tables.conn_records(spark, sf_small), C.TOP_K_LABELS, C.ATTACK_SHARE)
    assert plan_of(reb).count("l_partkey#") > 0
    plan = reb._jdf.queryExecution().executedPlan().toString()
    assert plan.split("===== Subqueries =====")[0].count("lineitem.parquet") <= 2


def test_rebalance_edges(spark):
    df = spark.createDataFrame([("a", "none"), ("b", "T1"), ("c", None), ("d", "T2"), ("e", "T2")], "key string, label_multi string")
    got = {(r["slice"], r["key"], r["copy"]) for r in balance.rebalance(df, 1, 0.5).collect()}
    assert got == {("T2", "d", 0), ("T2", "e", 0), ("T2", "a", 1), ("T2", "a", 2)}


def test_exact_quantiles_hold_no_whole_column(spark):
    rows = [(float(i % 977) if i % 3 else 5.0,) for i in range(5000)] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    values = sorted(v for (v,) in rows if v is not None and v == v)
    want = [values[max(1, -int(-p * len(values) // 1)) - 1] for p in probs]
    assert features.quantile_table(df, ["x"], probs, 0.0).first()["q"] == want
    assert "Generate" not in plan_of(features.quantile_table(df, ["x"], probs, 0.001).select("q")).split("Aggregate")[-1]
    assert features.quantile_table(df.filter("false"), ["x"], probs, 0.001).count() == 0
    assert features.quantile_table(df.filter("false"), ["x"], probs, 0.0).count() == 0


def test_estimated_distinct_counts(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("x"), F.when(F.col("id") > 0, "a").alias("y"))
    got = {r["feature"]: r["n_distinct"] for r in features.distinct_per_feature(df, ["x", "y"], 0.02).collect()}
    assert 90 <= got["x"] <= 110 and got["y"] == 2


def test_forest_holds_wide_categories(spark):
    df = spark.range(400).select(
        F.lit("none").alias("label_multi"),
        *[F.concat(F.lit("v"), F.col("id") % 100).alias(c) for c in C.CATEGORICAL_COLS],
        *[(F.col("id") % 7).cast("double").alias(c) for c in (*C.NUMERIC_COLS, *C.PORT_COLS, *C.BOOLEAN_COLS)],
    )
    df = df.withColumn("label_multi", F.when(F.col("src_port") > 3, "T1").otherwise("none"))
    pipeline, _, label = training.build_pipeline_f16("multiclass", num_trees=2, max_depth=3)
    model = training.fit_staged(pipeline, df)
    assert model.stages[-1].getMaxBins() == 101
    scored = model.transform(df)
    assert scored.filter(F.col(label) == F.col("prediction")).count() > 300


def test_a_slice_under_the_gate_has_a_row(spark, sf_small):
    got = training.per_label_experiment(spark, sf_small, k=2, min_rows=10**9)
    assert [r["status"] for r in got.collect()] == ["skipped", "skipped"]
    assert {"accuracy", "area_under_roc", "n_rows"} <= set(got.columns)


def test_staged_fit_equals_the_pipeline_fit(spark, sf_small):
    df = training.load_eval_table(spark, sf_small).coalesce(1).cache()
    pipeline, _ = training.build_pipeline_f12(df, num_trees=3, max_depth=4)
    whole, staged = pipeline.fit(df), training.fit_staged(pipeline, df)
    assert [type(a) for a in whole.stages] == [type(b) for b in staged.stages]
    assert training.label_dictionary(whole, spark).collect() == training.label_dictionary(staged, spark).collect()
    a, b = (m.transform(df).select("key", "prediction") for m in (whole, staged))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_error_mode_refuses_unseen_and_null_categories(spark, sf_small):
    from pyspark.errors import PySparkException
    from netsift.operators import clean, labels
    from netsift.sources import tables

    df = clean.cast_columns(tables.conn_records(spark, sf_small)).withColumn("label_bin", labels.binary_label_a())
    df = clean.drop_null_subset(df, [*C.PRESETS["f16"]]).limit(500).cache()
    pipeline, _, _ = training.build_pipeline_f16("binary", num_trees=1, max_depth=2, invalid="error")
    model = training.fit_staged(pipeline, df)
    assert model.transform(df).count() == df.count()
    for value in ("sctp", None):
        with pytest.raises((PySparkException, Exception), match="(?i)unseen label|null|invalid"):
            model.transform(df.limit(3).withColumn("protocol", F.lit(value).cast("string"))).select("prediction").collect()


def test_discovered_features_and_console_sink(spark, sf_small, capfd):
    from netsift.operators import schema
    from netsift.session import scratch_path
    from netsift.streaming import inference

    df = spark.createDataFrame([(1, 2, 3, 4)], "a_bin int, b_processed int, label_bin int, c int")
    assert schema.discover_features(df, ("_bin", "_processed")) == ["a_bin", "b_processed"]
    base = scratch_path(spark, f"console-{id(df)}")
    inference.stage_kafka_twin(spark.range(3).select(F.lit("k").alias("key"), F.lit("shown in full " * 5).alias("value")), f"{base}/in")
    stream = inference.read_stream(spark, fmt="parquet", path=f"{base}/in").select(F.col("value").cast("string"))
    q = inference.console_sink(stream, f"{base}/ckpt")
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None and q.recentProgress[0]["numInputRows"] == 3
