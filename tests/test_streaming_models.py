"""Streaming scorer, delivery, model persistence and the driver entry point."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from netsift.streaming import inference


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and {"label_name", "precision", "recall", "f1"} <= set(df.columns)


def test_stream_score_equals_batch(spark, sf_small):
    """Predictions of the stream equal those of the same model on the same records as a batch."""
    from pyspark.sql import DataFrame

    from netsift.plans import queries_stream

    kept = {}
    score = inference.score

    def remembering(decoded: DataFrame, model):
        kept["model"] = model
        return score(decoded, model)

    queries_stream.inference.score = remembering
    try:
        out = entry.queries()["stream_score"](spark, sf_small)
    finally:
        queries_stream.inference.score = score
    from netsift.sources import tables

    batch = inference.decode(tables.wire_records(spark, sf_small).select("key", "value")).filter(~F.col("_corrupt"))
    want = score(batch, kept["model"]).select("key", "predicted_label", "prediction")
    got = out.filter(F.col("topic") == "predictions").select("key", "predicted_label", "prediction")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    topics = {r.topic: r.n for r in out.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert topics["predictions"] == topics.get("benign", 0) + topics.get("attack", 0)


def test_routing_counts_add_up(spark, sf_small):
    out = entry.queries()["stream_deadletter"](spark, sf_small)
    c = {r.topic: r.n for r in out.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    assert c["predictions"] == c["benign"] + c["attack"]
    assert c["deadletter"] > 0


def test_console_and_kafka_options():
    o = inference.kafka_options("b:9092", "network-conn")
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
