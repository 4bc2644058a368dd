"""Work that grows no faster than the input: joins, scans and files of bounded size."""

import time

import pytest
from pyspark.sql import functions as F

from netsift import config as C
from netsift.operators import features
from netsift.plans import concurrent, queries_runs, queries_stream, training
from netsift.session import STAGING_CONF, cut_lineage, scratch_path, small_scans, staging, storage_memory
from netsift.sources import shared
from netsift.streaming import delivery, inference


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def words(spark):
    rows = [(i, f"v{min(i % 40, i % 17)}" if i % 9 else None, float(i % 23) if i % 5 else None) for i in range(900)]
    return spark.createDataFrame(rows, "id int, s string, x double").cache()


def test_nominal_bins_do_not_shuffle_rows(spark, words):
    assert "SortMergeJoin" not in plan_of(features.nominal_bins(words, ["s"]))


def test_rare_values_beyond_the_broadcast_head(spark, words, monkeypatch):
    want = {r["id"]: r["s_bin"] for r in features.nominal_bins(words, ["s"], 1.0).collect()}
    monkeypatch.setattr(features, "HEAD", 4)
    got = features.nominal_bins(words, ["s"], 1.0)
    assert got.columns == [*words.columns, "s_bin"]
    assert got.count() == 900 and {r["id"]: r["s_bin"] for r in got.collect()} == want
    assert len(set(want.values())) == 18  # 17 values and the index of null


def test_trimmed_edges_are_columns(spark, words):
    got = features.trimmed_numeric_bins(words, ["x"], relative_error=0.0)
    assert "scalar-subquery" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert got.count() == 900 and got.columns == [*words.columns, "x_bin"]
    assert got.where("x IS NULL AND x_bin <> -1").count() == 0


def test_ip_class_takes_octets_up_to_255(spark):
    ips = {"0.0.0.0": 1, "127.255.001.09": 1, "128.0.0.1": 2, "223.1.1.1": 3, "239.0.0.0": 4, "255.255.255.255": 5,
           "256.1.1.1": 0, "1.1.1.300": 0, "1.1.1": 0, "0001.1.1.1": 0, "fe80::1": 0, "": 0, "1.2.3.4 ": 0, "1.2.999.4": 0}
    df = spark.createDataFrame([*((k, v) for k, v in ips.items()), (None, 0)], "ip string, want int")
    assert df.select("ip", "want", features.ip_class(F.col("ip")).alias("got")).where("got <> want").collect() == []


def test_loads_read_one_staged_table(spark, words):
    df = queries_runs._in_loads(words.withColumn("key", F.col("id").cast("string")), ["s", "x"])
    assert df.columns == ["s", "x", "load"] and df.count() == 900
    assert "PartitionFilters: [isnotnull(load" in plan_of(df.filter("load = 1"))


def test_staged_files_hold_a_bounded_number_of_records(spark, monkeypatch):
    monkeypatch.setattr(inference, "FILE_RECORDS", 100)
    from netsift.session import scratch_path

    path = inference.stage_kafka_twin(spark.range(1000).coalesce(1).select(F.lit("k").alias("key"), F.lit("v").alias("value")), scratch_path(spark, "bounded-files"))
    files = [n for n in shared.names(spark, path) if n.endswith(".parquet")]
    assert len(files) == 10 and spark.read.parquet(path).count() == 1000


def test_cut_lineage_computes_once_and_keeps_metadata(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(50).select(F.col("id").alias("x", metadata={"a": 1})).mapInPandas(count, "x long")
    df = cut_lineage(df.withMetadata("x", {"a": 1}))
    assert seen.value == 50 and df.count() == 50 and df.schema["x"].metadata == {"a": 1}


def test_small_scans_keep_the_settings(spark):
    own = small_scans(spark, 1 << 20)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") in ("1048576", "1048576b")
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != own.conf.get("spark.sql.files.maxPartitionBytes")
    assert own.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")


def test_split_parts_hold_bins_and_label_alone(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("key"), *[(F.col("id") % 5).cast("int").alias(c) for c in C.F18_RANKED], F.lit(1.0).alias("label_bin"))
    train, test = training.split_parts(df)
    assert train.count() + test.count() == 200 and set(train.columns) == {*C.F18_RANKED, "label_bin", "split"}


def test_stream_score_joins_once_and_writes_each_value_once(spark, sf_small, monkeypatch):
    from netsift.plans import queries_stream
    from netsift.sources import tables

    joins, kept, join, run = [], [], tables.joined_rows, inference.run_to_table
    monkeypatch.setattr(tables, "joined_rows", lambda *a: joins.append(1) or join(*a))
    monkeypatch.setattr(inference, "run_to_table", lambda df, name: kept.append(df.columns) or run(df, name))
    got = queries_stream.stream_score(spark, sf_small)
    assert len(joins) == 1 and kept == [["topic", "key", "value", "predicted_label", "prediction"]]
    assert got.count() > 6000
    df = spark.createDataFrame([("k", "none", 1.0), ("l", "T1", 0.0)], "key string, predicted_label string, prediction double")
    plan = inference.routed(df, "by_name")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("StructsToJson")  # plans are printed from the top


def test_training_records_drop_nulls_after_they_are_staged(spark, sf_small, monkeypatch):
    staged = []
    monkeypatch.setattr(training, "cut_lineage", lambda df, split=None: staged.append(plan_of(df)) or cut_lineage(df, split))
    training.train_eval_f12(spark, sf_small)
    assert "isnan" not in staged[0]


def test_staged_trees_keep_the_node_of_each_row(spark):
    df = spark.range(600).select(
        ((F.col("id") * 7919) % 97 % 3 == 0).cast("double").alias("label_bin"),
        F.lit("none").alias(C.LABEL_COL),
        *[F.concat(F.lit("v"), F.col("id") % (i + 3)).alias(c) for i, c in enumerate(C.CATEGORICAL_COLS)],
        *[(F.col("id") * (i + 3) % 101).cast("double").alias(c) for i, c in enumerate((*C.NUMERIC_COLS, *C.PORT_COLS))],
        *[(F.col("id") % (i + 2) == 0).alias(c) for i, c in enumerate(C.BOOLEAN_COLS)],
    )
    pipeline, _, _ = training.build_pipeline_f16("binary", num_trees=4, max_depth=7)
    df = df.coalesce(1)
    walked, kept = pipeline.fit(df).stages[-1], training.fit_staged(pipeline, df).stages[-1]
    assert kept.getCacheNodeIds() and kept.getCheckpointInterval() == -1
    assert not pipeline.getStages()[-1].getCacheNodeIds()
    assert max(t.depth for t in kept.trees) > 4
    # the first line names the model
    nodes = lambda model: [t.toDebugString.splitlines()[1:] for t in model.trees]
    assert nodes(kept) == nodes(walked)


def test_nodes_are_not_kept_beyond_the_executors_memory(spark, monkeypatch):
    df = spark.range(300).select(
        (F.col("id") % 3 == 0).cast("double").alias("label_bin"),
        F.lit("none").alias(C.LABEL_COL),
        *[F.concat(F.lit("v"), F.col("id") % (i + 3)).alias(c) for i, c in enumerate(C.CATEGORICAL_COLS)],
        *[(F.col("id") * (i + 3) % 101).cast("double").alias(c) for i, c in enumerate((*C.NUMERIC_COLS, *C.PORT_COLS))],
        *[(F.col("id") % (i + 2) == 0).alias(c) for i, c in enumerate(C.BOOLEAN_COLS)],
    ).coalesce(1)
    pipeline, _, _ = training.build_pipeline_f16("binary", num_trees=3, max_depth=4)
    kept = training.fit_staged(pipeline, df).stages[-1]
    assert storage_memory(spark) > 100 << 20
    width = len(pipeline.getStages()[-2].getInputCols())
    monkeypatch.setattr(training, "storage_memory", lambda _: 300 * training.cached_bytes(width, 3, nodes=True) - 1)
    walked = training.fit_staged(pipeline, df).stages[-1]
    assert kept.getCacheNodeIds() and not walked.getCacheNodeIds()
    assert [t.toDebugString.splitlines()[1:] for t in walked.trees] == [t.toDebugString.splitlines()[1:] for t in kept.trees]


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_by(spark, work) -> set[str]:
    """Shuffle files that are still there some seconds after ``work`` (they are removed in the background)."""
    before = shuffle_files(spark)
    work()
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_staged_tables_leave_no_shuffle_files(spark):
    df = spark.range(4000).groupBy((F.col("id") % 97).alias("k")).count()
    assert left_by(spark, lambda: cut_lineage(df)) == set()
    assert left_by(spark, lambda: concurrent.staged_by(df.withColumn("half", F.col("k") % 2), "half", "release-test")) == set()
    wire = df.repartition(3).select(F.lit("k").alias("key"), F.col("k").cast("string").alias("value"))
    path = scratch_path(spark, "release-wire")
    assert left_by(spark, lambda: inference.stage_kafka_twin(wire, path)) == set()
    assert all(n.endswith(".zstd.parquet") for n in shared.names(spark, path)) and spark.read.parquet(path).count() == 97


def test_delivered_batches_leave_no_shuffle_files(spark):
    df, base = spark.range(500).select(F.col("id").cast("string").alias("value")), scratch_path(spark, "release-delivery")
    assert left_by(spark, lambda: delivery.deliver_batch(df, 0, delivery.FolderTransport(f"{base}/sink"), f"{base}/log")) == set()
    assert delivery.read_delivered(spark, f"{base}/sink", f"{base}/log").count() == 500


def test_staging_settings_hold_inside_alone(spark):
    now = lambda: {k: spark.conf.get(k, None) for k in STAGING_CONF}
    was = now()
    with staging(spark):
        with staging(spark):
            pass
        assert now() == STAGING_CONF
    assert now() == was != STAGING_CONF


def test_fits_at_once_share_the_executors_memory(spark, monkeypatch):
    monkeypatch.setattr(training, "storage_memory", lambda _: 1000 * training.cached_bytes(18, 20))
    assert [training.fits_at_once(spark, rows, 18, 4) for rows in (0, 200, 400, 1000, 10**9)] == [4, 4, 2, 1, 1]


def test_wire_files_go_with_their_batches(spark, sf_small, monkeypatch):
    monkeypatch.setattr(inference, "FILE_RECORDS", 50)
    folders, stage = [], inference.stage_kafka_twin
    monkeypatch.setattr(inference, "stage_kafka_twin", lambda df, path: folders.append(path) or stage(df, path))
    raw = queries_stream._wire_stream(spark, sf_small)
    records, files = spark.read.parquet(folders[0]).count(), len(shared.names(spark, folders[0]))
    assert files > 64
    got = inference.run_to_table(raw.select("key", "value"), "wire-files")
    assert got.count() == records
    for _ in range(100):
        if len(shared.names(spark, folders[0])) <= files - 64:
            break
        time.sleep(0.1)
    assert len(shared.names(spark, folders[0])) <= files - 64
