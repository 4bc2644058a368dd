"""Stored sketches, the run ledger, observed stages, ranks over ranges and the CSV replay."""

import math
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from netsift.operators import features, sketches
from netsift.operators.util import ranked
from netsift.plans import ledger
from netsift.session import scratch_path
from netsift.sources import files
from netsift.streaming import replay


def folder(spark, name):
    return scratch_path(spark, f"{name}-{os.urandom(4).hex()}")


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(1)
    rows = [(i % 5, rnd.gauss(0, 1) if i % 4 else float(i % 3), f"v{min(rnd.randrange(2000), rnd.randrange(2000))}") for i in range(20_000)]
    rows += [(0, None, None), (1, float("nan"), "x")]
    return spark.createDataFrame(rows, "load int, x double, s string").cache()


def test_merged_sketches_keep_their_error(spark, numbers):
    store = folder(spark, "sketch-store")
    for load in (0, 1, 2, 3, 4, 2):
        sketches.store_load(sketches.summarise(numbers.filter(F.col("load") == load), ["x"], ["s"]), store, f"l{load}")
    stored = sketches.stored(spark, store)
    assert stored.count() == 10
    summary = sketches.merged(stored).cache()
    values = sorted(r["x"] for r in numbers.select("x").collect() if r["x"] is not None and not math.isnan(r["x"]))
    probs = [i / 20 for i in range(21)]
    (row,) = sketches.quantiles(summary, probs).collect()
    assert (row["feature"], row["n"]) == ("x", len(values))
    for p, q in zip(probs, row["q"]):
        below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
        assert below - sketches.rank_error() <= p <= upto + sketches.rank_error()
    got = {r["feature"]: r["n_distinct"] for r in sketches.distinct_counts(summary).collect()}
    exact = {r["feature"]: r["n_distinct"] for r in features.distinct_per_feature(numbers, ["x", "s"]).collect()}
    assert all(abs(got[c] - exact[c]) <= 4 * sketches.distinct_error() * exact[c] + 1 for c in exact)
    edges = {r["feature"]: r["splits"] for r in sketches.splits(summary, 8).collect()}["x"]
    assert edges[0] == -math.inf and edges[-1] == math.inf and edges == sorted(set(edges))
    # two loads alone, without reading the data again
    two = sketches.quantiles(sketches.merged(stored.filter("load IN ('l0', 'l1')")), [0.5]).first()
    assert two["n"] == numbers.filter("load < 2 AND x IS NOT NULL AND NOT isnan(x)").count()


def test_sketches_of_columns_without_values(spark, numbers):
    rows = sketches.summarise(numbers.select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("s")), ["x"], ["s"])
    assert sketches.quantiles(rows, [0.5]).collect() == []
    assert {r["feature"]: r["n_distinct"] for r in sketches.distinct_counts(rows).collect()} == {"x": 1, "s": 1}
    empty = sketches.summarise(numbers.limit(0), ["x"], ["s"])
    assert {r["n_distinct"] for r in sketches.distinct_counts(empty).collect()} == {0}


def test_ranks_over_ranges_equal_one_window(spark, numbers):
    counts = numbers.filter("s IS NOT NULL").groupBy("load", F.col("s").alias("value")).agg(F.count("*").alias("n"))
    counts = counts.unionByName(counts.withColumn("value", F.concat("value", F.lit("'"))).withColumn("n", F.lit(1).cast("long"))).cache()
    for group in ([], ["load"]):
        got = ranked(counts, group)
        order = Window.partitionBy(*group).orderBy(F.desc("n"), "value", *(["load"] if not group else []))
        want = counts.select(
            "*",
            (F.row_number().over(order) - 1).alias("rank"),
            (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
            F.sum("n").over(Window.partitionBy(*group)).alias("tot"),
        )
        if group:
            assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
        else:  # values repeat over loads here: their order among equals is open
            assert sorted(r["rank"] for r in got.collect()) == list(range(counts.count()))
            assert [(r["n"], r["value"]) for r in got.orderBy("rank").collect()] == [(r["n"], r["value"]) for r in want.orderBy("rank").collect()]


def test_a_run_is_recorded_once(spark):
    path = folder(spark, "ledger")
    assert ledger.runs(spark, path).collect() == []
    row = lambda **v: spark.createDataFrame([v])
    ledger.append_run(row(experiment="a", accuracy=0.5), path, "r1")
    ledger.append_run(row(experiment="a", accuracy=0.6), path, "r2")
    ledger.append_run(row(experiment="a", accuracy=0.6), path, "r2")
    ledger.append_run(row(experiment="b", auc=0.9, features=["x", "y"]), path, "007")
    runs = {r["run_id"]: r for r in ledger.runs(spark, path).collect()}
    assert set(runs) == {"r1", "r2", "007"}
    assert runs["007"]["accuracy"] is None and runs["007"]["features"] == ["x", "y"] and runs["r1"]["auc"] is None
    newest = {r["experiment"]: r for r in ledger.latest(ledger.runs(spark, path), ["experiment"]).collect()}
    assert newest["a"]["run_id"] == "r2" and newest["b"]["auc"] == 0.9
    with pytest.raises(ValueError):
        ledger.append_run(row(run_id="x"), path, "r4")


def test_stages_count_and_time_real_work(spark):
    run = ledger.Stages(spark, "test")
    df = run.table("load", spark.range(1000))
    assert run.call("fit", lambda: df.count()) == 1000
    run.table("filter", df.filter("id < 10"))
    with pytest.raises(ZeroDivisionError):
        run.call("wrong", lambda: 1 // 0)
    rows = run.report().orderBy("position").collect()
    assert [(r["stage"], r["rows"]) for r in rows] == [("load", 1000), ("fit", None), ("filter", 10)]
    assert all(r["seconds"] > 0 for r in rows) and spark.sparkContext.getLocalProperty("spark.job.description") is None


def test_replay_equals_the_batch_and_keeps_broken_rows(spark, tmp_path):
    lines = ["duration,local_orig,service", "1.5,True,http", "-,yes,", ",,dns", "x,no,\"a,b\"", "7", "1,1,ssh,too,many", "3,TRUE ,ü"]
    for i in range(3):
        (tmp_path / f"part-{i}.csv").write_text("\n".join(lines) + "\n")
    columns = ["duration", "local_orig", "service"]
    batch = replay.records(replay.read(spark, str(tmp_path), columns, stream=False)).withColumn("corrupt", F.col(replay.CORRUPT).isNotNull())
    stream = replay.records(replay.read(spark, str(tmp_path), columns, files_per_batch=1)).withColumn("corrupt", F.col(replay.CORRUPT).isNotNull())
    out, checkpoint = folder(spark, "replay-out"), folder(spark, "replay-ckpt")
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == batch.count() == 21 and got.exceptAll(batch.select(*got.columns)).count() == 0
    assert len([n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]) == 3
    rows = {(r["duration"], r["local_orig"], r["service"], r["corrupt"]) for r in batch.collect()}
    assert {(1.5, True, "http", False), (0.0, True, None, False), (0.0, False, "dns", False), (0.0, False, "a,b", False), (7.0, False, None, True)} <= rows
    assert sum(r["corrupt"] for r in batch.collect()) == 6


def test_written_datasets_read_back_in_field_order(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", "x"), (2.0, None, "y")], "duration double, src_ip string, unknown string")
    files.write_dataset(df, str(tmp_path / "d"))
    back = files.read_csv(spark, str(tmp_path / "d"), "src_ip string, duration double")
    assert back.columns == ["src_ip", "duration"] and sorted(r["duration"] for r in back.collect()) == [1.0, 2.0]
