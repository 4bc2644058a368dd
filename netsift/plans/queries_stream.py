"""Registered streaming and source queries.

Streaming queries stage their input (derived by Spark from the driver
tables) as a Kafka-layout Parquet folder under the shared checkpoint
folder, run the streaming plan once with an available-now trigger into a
Parquet sink, and return the sink. The oracle is the batch equivalent.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import balance, clean, labels
from ..session import cut_lineage, scratch_path
from ..sources import shared, tables
from ..streaming import delivery, inference, recovery
from .queries import register

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _stage(spark, name: str, df) -> str:
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    return inference.stage_kafka_twin(df, path)


def _wire_stream(spark, sf, joined=None):
    src = _stage(spark, "wire", tables.wire_records(spark, sf, joined).select("key", "value"))
    # the twin is read by this stream alone: files of committed batches go, so disk holds the stream or its results and not both
    return inference.read_stream(spark, fmt="parquet", options={"cleanSource": "delete"}, path=src, max_files_per_trigger=64)


@register("stream_decode")
def stream_decode(spark, sf):
    """Decode + cast the record stream."""
    decoded = inference.decode(_wire_stream(spark, sf))
    return inference.run_to_table(decoded, "stream-decode")


@register("stream_route")
def stream_route(spark, sf):
    """Events scored by a stand-in rule, routed to predictions + benign/attack in one query."""
    ev = tables.table(spark, sf, "events")
    src = _stage(
        spark,
        "events",
        ev.select(
            F.col("user_id").cast("string").alias("key"),
            F.to_json(F.struct("event_id", "event_type", "value")).alias("value"),
        ),
    )
    raw = inference.read_stream(spark, fmt="parquet", path=src, max_files_per_trigger=64)
    dec = clean.decode_json(raw.withColumn("key", F.col("key").cast("string")), EVENT_SCHEMA, keep=["key"])
    dec = dec.withColumnRenamed("value", "event_value")
    scored = dec.withColumn("prediction", F.when(F.col("event_type") == "error", 0.0).otherwise(1.0))
    out = inference.routed(scored, "binary", value_cols=["event_id", "event_type", "prediction"], corrupt_col=None)
    res = inference.run_to_table(out, "stream-route", partition_by=["topic"])
    return res.select("topic", "event_id", "prediction")


@register("stream_deadletter")
def stream_deadletter(spark, sf):
    """Undecodable records go to the dead-letter topic, the rest are scored and routed."""
    decoded = inference.decode(_wire_stream(spark, sf))
    scored = inference.rule_scorer(decoded)
    out = inference.routed(scored, "binary")
    res = inference.run_to_table(out, "stream-deadletter")
    return res.select("topic", F.col("key").cast("string").alias("key"), "prediction")


@register("stream_score")
def stream_score(spark, sf):
    """A saved-and-reloaded 12-attribute pipeline scores the stream; routed by label name."""
    from pyspark.ml import PipelineModel

    from .training import train_eval_f12

    joined = cut_lineage(tables.joined_rows(spark, sf))  # for the training records and the stream
    model, _, _ = train_eval_f12(spark, sf, joined=joined)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex[:12]}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    decoded = inference.decode(_wire_stream(spark, sf, joined))
    # undecodable records pass the scorer with empty fields; they go on to the dead letters without a prediction
    scored = inference.score(decoded, loaded)
    scored = scored.withColumns({c: F.when(~F.col("_corrupt"), F.col(c)) for c in ("prediction", "predicted_label")})
    out = inference.routed(inference.output_projection(scored, extra=["key", "_corrupt"]), "by_name")
    # the columns a topic carries and those returned; all others are in the value
    res = inference.run_to_table(out.select("topic", "key", "value", "predicted_label", "prediction"), "stream-score")
    return res.select("topic", F.col("key").cast("string").alias("key"), "predicted_label", "prediction")


@register("stream_deliver")
def stream_deliver(spark, sf):
    """Routed predictions delivered in ≤1000-record chunks; returns what the sink received."""
    decoded = inference.decode(_wire_stream(spark, sf))
    out = inference.routed(inference.rule_scorer(decoded), "binary").filter(F.col("topic") == C.TOPIC_PREDICTIONS)
    base = scratch_path(spark, f"deliver-{uuid.uuid4().hex[:12]}")
    transport = delivery.FolderTransport(os.path.join(base, "sink"))
    q = delivery.start_delivery(out, transport, os.path.join(base, "_checkpoint"), trigger={"availableNow": True})
    q.awaitTermination()
    return delivery.read_delivered(spark, os.path.join(base, "sink"))


@register("deliver_once")
def deliver_once(spark, sf):
    """Every batch is posted, its commit is lost, and it is posted again from other partitions: each record is there once."""
    decoded = inference.decode(_wire_stream(spark, sf))
    out = inference.routed(inference.rule_scorer(decoded), "binary").filter(F.col("topic") == C.TOPIC_PREDICTIONS)
    base = scratch_path(spark, f"once-{uuid.uuid4().hex[:12]}")
    transport, log = delivery.FolderTransport(f"{base}/sink"), f"{base}/log"

    others = max(7, 2 * spark.sparkContext.defaultParallelism - 1)

    def twice(batch, batch_id):
        batch = batch.select("value").persist()  # decoded and scored once for both
        try:
            delivery.deliver_batch(batch, batch_id, transport, f"{base}/lost")
            delivery.deliver_batch(batch.repartition(others), batch_id, transport, log)
        finally:
            batch.unpersist()

    q = out.writeStream.option("checkpointLocation", f"{base}/_checkpoint").foreachBatch(twice).trigger(availableNow=True).start()
    q.awaitTermination()
    record = "src_ip string, dest_ip string, src_port double, dest_port double, label_multi string, prediction double"
    lines = delivery.read_delivered(spark, f"{base}/sink", log)
    return lines.select(F.from_json("value_json", record).alias("r")).select("r.*")


@register("stream_restart")
def stream_restart(spark, sf):
    """The routed stream, stopped between write and commit and restarted; the same rows as an unbroken run."""
    wire = tables.wire_records(spark, sf).select("key", "value")
    # a small input is dealt over six files; a larger one has them anyway, each of bounded size
    if tables.table(spark, sf, "lineitem").count() < 6 * inference.FILE_RECORDS:
        wire = wire.repartition(6)
    src = _stage(spark, "wire", wire)
    files = [n for n in shared.names(spark, src) if n.endswith(".parquet")]
    raw = inference.read_stream(spark, fmt="parquet", path=src, max_files_per_trigger=max(2, -(-len(files) // 3)))
    out = inference.routed(inference.rule_scorer(inference.decode(raw)), "binary").select("topic", F.col("key").cast("string").alias("key"), "prediction")
    base = scratch_path(spark, f"restart-{uuid.uuid4().hex[:12]}")
    failed = set()

    def fail_once(batch_id):
        if batch_id in (0, 1) and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError(f"stopped after batch {batch_id} was written and before its commit")

    def start():
        return recovery.start_batch_sink(
            out, f"{base}/out", f"{base}/_checkpoint", ["topic"], trigger={"availableNow": True}, after_write=fail_once
        )

    recovery.run_with_restarts(start)
    return recovery.read_committed(spark, f"{base}/out", f"{base}/_checkpoint", "topic string, key string, prediction double").select(
        "topic", "key", "prediction"
    )


@register("wire_hash_split_counts")
def wire_hash_split_counts(spark, sf):
    """R6 at the label level: train/test rows per label (the split's class balance)."""
    conn = balance.hash_split(tables.conn_records(spark, sf), C.EVAL_TRAIN_FRACTION)
    return conn.groupBy("split", C.LABEL_COL).agg(F.count(F.lit(1)).alias("n"), F.sum(labels.binary_label_a()).alias("n_benign"))
