"""Registered queries of stored statistics, recorded runs and the CSV replay."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from .. import config as C
from ..functions.hashing import hash_bucket
from ..operators import balance, clean, features, forest, labels, metrics, sketches
from ..session import scratch_path
from ..sources import tables
from ..streaming import inference, replay
from . import concurrent, ledger
from .queries import register, row_counts
from .queries_more import F12_NUMERIC, _clean_f12, _scored

LOADS = 4
SKETCH_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9)
#: Columns of a replayed file, in order.
REPLAY_COLUMNS = ("key", *C.CONN_COLUMNS)


def _in_loads(df, columns):
    """``df`` written once, in a folder per load: its joins are not repeated for each load and check."""
    return concurrent.staged_by(df.select(*columns, hash_bucket("key", LOADS, "load|").alias("load")), "load", "loads")


def _sketch_store(spark, df, numeric, nominal=()):
    """The sketches of ``df`` in four loads; the first arrives twice and counts once."""
    store = scratch_path(spark, f"sketches-{uuid.uuid4().hex[:12]}")
    for load in [*range(LOADS), 0]:
        part = df.filter(F.col("load") == load)
        sketches.store_load(sketches.summarise(part, numeric, nominal), store, f"l{load}")
    return sketches.stored(spark, store)


@register("sketched_quantiles")
def sketched_quantiles(spark, sf):
    """Quantiles from merged sketches of several loads, and whether their true ranks are within the stated error."""
    df = _in_loads(_clean_f12(spark, sf), F12_NUMERIC)
    merged = sketches.merged(_sketch_store(spark, df, F12_NUMERIC))
    # features x probabilities, at most
    found = {r["feature"]: r for r in sketches.quantiles(merged, SKETCH_PROBS).collect()}
    checks = []
    for c, r in found.items():
        x, n = F.col(c).cast("double"), F.count(c)
        for p, q in zip(SKETCH_PROBS, r["q"]):
            below, upto = F.count(F.when(x < q, 1)) / n, F.count(F.when(x <= q, 1)) / n
            error = F.lit(sketches.rank_error())
            within = (below - error <= p) & (F.lit(p) <= upto + error)
            checks.append(F.struct(F.lit(c).alias("feature"), F.lit(p).alias("p"), F.lit(r["n"]).alias("n"), within.alias("within_error")))
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@register("sketched_distinct")
def sketched_distinct(spark, sf):
    """A3: distinct counts from merged sketches, and whether they are within four standard errors of the exact ones."""
    numeric, nominal = [*C.NUMERIC_COLS, *C.PORT_COLS], [*C.CATEGORICAL_COLS, *C.BOOLEAN_COLS]
    df = _in_loads(tables.conn_records(spark, sf), [*numeric, *nominal])
    summary = sketches.merged(_sketch_store(spark, df, numeric, nominal))
    exact = features.distinct_per_feature(df, [*numeric, *nominal])
    both = sketches.distinct_counts(summary).withColumnRenamed("n_distinct", "estimate").join(exact, "feature")
    allowed = F.greatest(F.lit(1.0), F.col("n_distinct") * 4 * sketches.distinct_error())
    rows = summary.select("feature", (F.col("n") + F.col("nulls")).alias("n_rows"))
    return both.select("feature", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= allowed).alias("within_error")).join(rows, "feature")


@register("run_summary")
def run_summary(spark, sf):
    """Two experiments on record, one recorded again; the latest row of each, with the columns of both."""
    scored, _ = _scored(spark, sf)
    folder = scratch_path(spark, f"ledger-{uuid.uuid4().hex[:12]}")
    keys = [F.lit("rule").alias("experiment"), F.lit(len(C.F12_FEATURES)).alias("num_features"), F.array(*map(F.lit, C.F12_FEATURES)).alias("features")]
    summary = metrics.overall(metrics.confusion_counts(scored)).select(*keys, "*")
    ledger.append_run(row_counts(spark, sf).select(F.lit("counts").alias("experiment"), "n_rows", "n_train", "n_test"), folder, "r1")
    ledger.append_run(summary.withColumn("accuracy", F.lit(0.0)), folder, "r2")
    for _ in range(2):  # the second time is a retry of the same run
        ledger.append_run(summary, folder, "r3")
    newest = ledger.latest(ledger.runs(spark, folder), ["experiment"])
    return newest.drop("recorded_at").withColumn("features", F.array_join("features", ","))


def _staged_run(spark, sf):
    """Binning, training and prediction of the exact tree, as observed stages."""
    run = ledger.Stages(spark, "tree")
    loaded = run.table("load", tables.conn_records(spark, sf).select("key", *C.F12_FEATURES, C.LABEL_COL))
    cleaned = clean.drop_null_subset(clean.cast_columns(loaded), [*C.F12_FEATURES, C.LABEL_COL])
    bins = [f"{c}_bin" for c in F12_NUMERIC]
    binned = features.quantile_bins(cleaned, F12_NUMERIC, C.QUANTILE_BUCKETS_F12)
    binned = run.table("binning", binned.select("key", labels.binary_label_a().alias("label_bin"), *bins))
    train, test = balance.split_frames(binned, C.EVAL_TRAIN_FRACTION)
    assembler = VectorAssembler(inputCols=bins, outputCol="features")
    model = run.call("training", lambda: forest.exact_tree(assembler.transform(train), "features", "label_bin", 4))
    run.table("prediction", model.transform(assembler.transform(test)).select("key", "prediction"))
    return run.report()


@register("stage_timings")
def stage_timings(spark, sf):
    """Rows and seconds of every stage of a run, each measured around the action that does the work."""
    return _staged_run(spark, sf)


@register("stage_rows")
def stage_rows(spark, sf):
    """L9 without the times, which no two runs share."""
    return _staged_run(spark, sf).drop("seconds")


@register("csv_replay")
def csv_replay(spark, sf):
    """Record files replayed as a stream in bounded batches; fields coerced, rows that do not parse kept and marked."""
    folder = scratch_path(spark, f"replay-{uuid.uuid4().hex[:12]}")
    text = tables.text_records(spark, sf)
    text.select(*REPLAY_COLUMNS).write.option("header", "true").csv(folder)
    # one order in 97 also sends a row that breaks off after its key
    broken = text.where(F.split("key", "[|]")[0].cast("long") % 97 == 0)
    broken.select("key", F.lit("junk").alias("src_ip")).write.mode("append").option("header", "true").csv(folder)
    raw = replay.read(spark, folder, REPLAY_COLUMNS, files_per_batch=8)
    typed = replay.records(raw).withColumn("corrupt", F.col(replay.CORRUPT).isNotNull())
    return inference.run_to_table(typed.select("key", *C.NUMERIC_COLS, *C.PORT_COLS, *C.BOOLEAN_COLS, "corrupt"), "csv-replay")
