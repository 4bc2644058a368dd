"""Unit tests of operator contracts and edge cases (FIXTURES §2.2)."""

import math

import pytest
from pyspark.sql import functions as F

from netsift import config as C
from netsift.functions.casts import bool_to_double, bool_to_int, to_double, wire_bool, wire_number
from netsift.operators import balance, clean, features, labels, schema


def test_rename_strict_raises_on_missing(spark):
    df = spark.createDataFrame([(1, 2)], "proto int, x int")
    with pytest.raises(ValueError):
        schema.rename_strict(df, {"proto": "protocol", "uid": "uid"})
    assert schema.rename_strict(df, {"proto": "protocol"}).columns == ["protocol", "x"]


def test_rename_tolerant_label_fallback_and_clash(spark):
    df = spark.createDataFrame([(1, "a")], "proto int, label_technique string")
    out = schema.rename_tolerant(df)
    assert out.columns == ["protocol", "label_multi"]
    with pytest.raises(ValueError):
        schema.rename_tolerant(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError):
        schema.rename_tolerant(spark.createDataFrame([(1, 2, "a")], "proto int, protocol int, label_multi string"))


def test_drop_and_keep(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    with pytest.raises(ValueError):
        schema.drop_columns(df, ["zz"], strict=True)
    assert schema.keep_present(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert schema.add_missing(df, "label_multi", "none").columns[-1] == "label_multi"
    assert schema.ranked_prefix(df.toDF("x_bin", "b", "y_bin"), ["y_bin", "x_bin"], 1) == ["y_bin"]
    assert schema.detect_roles(df.withColumn("s", F.lit("t")), ["a", "s"]) == {"string": ["s"], "numeric": ["a"], "boolean": []}


def test_casts_edge_values(spark):
    vals = ["-", "", "1e3", " TRUE ", "true", "false", None, "7"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    r = df.select(
        to_double("v").alias("d"), bool_to_double("v").alias("b"), wire_number("v").alias("w"), wire_bool("v").alias("wb")
    ).collect()
    assert [x.d for x in r] == [None, None, 1000.0, None, None, None, None, 7.0]
    assert [x.b for x in r] == [None, None, 1000.0, None, 1.0, 0.0, 0.0, 7.0]
    assert [x.w for x in r] == [0.0, 0.0, 1000.0, 0.0, 0.0, 0.0, 0.0, 7.0]
    assert [x.wb for x in r] == [False, False, False, True, True, False, False, False]
    b = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").select(bool_to_int("b").alias("i"))
    assert [x.i for x in b.collect()] == [1, 0, 1]


def test_dropna_removes_nan_and_checks_columns(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert clean.drop_null_subset(df, ["x"]).count() == 1
    with pytest.raises(ValueError):
        clean.drop_null_subset(df, ["nope"])


def test_json_roundtrip_and_corrupt(spark):
    df = spark.createDataFrame([('{"src_port": 80, "duration": "-", "local_orig": "True"}',), ("junk",)], "value string")
    out = clean.decode_json(df, C.conn_schema(), corrupt_col="_corrupt").collect()
    assert out[0].src_port == 80.0 and out[0].duration is None and out[0].local_orig is None and not out[0]._corrupt
    assert out[1]._corrupt and out[1].src_port is None
    enc = clean.encode_keyed(spark.createDataFrame([("", 1.0, None)], "src_ip string, p double, q string"), ["p", "q"])
    r = enc.first()
    assert r.key is None and r.value == '{"p":1.0}'


def test_ip_port_bool_classes(spark):
    ips = ["10.0.0.1", "128.1.1.1", "192.168.0.1", "224.0.0.1", "250.1.1.1", "256.1.1.1", "fe80::1", "1.2.3", None]
    r = spark.createDataFrame([(i,) for i in ips], "ip string").select(features.ip_class(F.col("ip")).alias("c")).collect()
    assert [x.c for x in r] == [1, 2, 3, 4, 5, 0, 0, 0, 0]
    ports = [-1.0, 0.0, 1023.0, 1024.0, 49151.0, 49152.0, 65535.0, 65536.0, None]
    r = spark.createDataFrame([(p,) for p in ports], "p double").select(features.port_class(F.col("p")).alias("c")).collect()
    assert [x.c for x in r] == [0, 1, 1, 2, 2, 3, 3, 0, 0]
    r = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").select(features.bool_class(F.col("b")).alias("c"))
    assert [x.c for x in r.collect()] == [1, 0, 2]


def test_quantile_bins_equal_spark_ml(spark):
    from pyspark.ml.feature import QuantileDiscretizer

    data = [(float(v),) for v in [0, 0, 0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610]]
    df = spark.createDataFrame(data, "x double")
    ours = features.quantile_bins(df, ["x"], 4, relative_error=0.0).select("x", "x_bin").collect()
    qd = QuantileDiscretizer(inputCol="x", outputCol="x_bin", numBuckets=4, relativeError=0.0).fit(df)
    theirs = qd.transform(df).select("x", "x_bin").collect()
    assert [r.x_bin for r in ours] == [r.x_bin for r in theirs]


def test_bucket_edges_nan_null(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (float("nan"),), (None,), (float("inf"),)], "x double")
    splits = F.array(F.lit(-math.inf), F.lit(5.0), F.lit(math.inf))
    r = [x.b for x in df.select(features.bucket_of(F.col("x"), splits).alias("b")).collect()]
    assert r == [0.0, 1.0, 1.0, 2.0, None, 1.0]


def test_nominal_share_rule(spark):
    vals = ["a"] * 50 + ["b"] * 30 + ["c"] * 15 + ["d"] * 4 + ["e"] * 1 + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = {r.v: r.v_bin for r in features.nominal_bins(df, ["v"], 0.98).select("v", "v_bin").distinct().collect()}
    # before-shares: a 0, b .50, c .80, d .95, e .99 -> e folds into "other" (= 4)
    assert out == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, None: 4}


def test_trimmed_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)], "x double")
    out = features.trimmed_numeric_bins(df, ["x"], 0.02, 10, relative_error=0.0)
    got = {r.x: r.x_bin for r in out.collect()}
    assert got[None] == -1 and got[0.0] == 0 and got[99.0] == 11 and got[2.0] == 1 and got[97.0] == 10


def test_share_validation_and_no_benign(spark):
    for bad in (0.0, 1.1, -0.5):
        with pytest.raises(ValueError):
            balance.check_share(bad)
    df = spark.createDataFrame([("k1", "T1"), ("k2", "T1")], "key string, label_multi string")
    with pytest.raises(Exception):
        balance.slice_plan(df, 3, 0.3).collect()


def test_rebalance_share_one_needs_no_benign(spark):
    rows = [(f"a{i}", "T1") for i in range(10)] + [(f"b{i}", "none") for i in range(40)]
    df = spark.createDataFrame(rows, "key string, label_multi string")
    out = balance.rebalance(df, 3, 1.0)
    assert out.filter(F.col("label_multi") == "none").count() == 0
    assert out.count() == 10


def test_rebalance_full_copies(spark):
    rows = [(f"a{i}", "T1") for i in range(30)] + [(f"b{i}", "none") for i in range(20)]
    df = spark.createDataFrame(rows, "key string, label_multi string")
    plan = balance.slice_plan(df, 3, 0.3).first()
    assert plan.benign_needed == pytest.approx(70.0) and plan.copies == 3 and plan.fraction == pytest.approx(0.5)
    out = balance.rebalance(df, 3, 0.3).filter(F.col("label_multi") == "none")
    per_key = {r.key: r.n for r in out.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert set(per_key.values()) <= {3, 4} and len(per_key) == 20


def test_frequency_index_ties_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "v string")
    d = {r.v: r.v_idx for r in labels.frequency_index(df, "v").collect()}
    assert d == {"c": 0.0, "a": 1.0, "b": 2.0}
    out = labels.apply_index(spark.createDataFrame([("a",), ("zz",), (None,)], "v string"), labels.frequency_index(df, "v"), "v")
    assert sorted((r.v or "", r.v_idx) for r in out.collect()) == [("", 3.0), ("a", 1.0), ("zz", 3.0)]


def test_label_encodings_polarity(spark):
    df = spark.createDataFrame([("none",), ("T1",), (None,)], "label_multi string")
    r = df.select(labels.binary_label_a().alias("a"), labels.binary_label_b().alias("b")).collect()
    assert [(x.a, x.b) for x in r] == [(1.0, 1.0), (0.0, 0.0), (0.0, 1.0)]
