"""Records that must not be lost: dead letters, partition columns, held-out rows."""

import pytest
from pyspark.sql import functions as F

from netsift.operators.clean import decode_json
from netsift.session import checkpoint_dir
from netsift.sources.files import read_records
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_only_objects_with_a_known_field_are_records(spark):
    bad = [None, "", "junk", '{"a": 1', "123", "[]", "{}", "null", '""', '{"c": 1}', '[{"a": 1}, {"a": 2}]']
    good = ['{"a": 1}', '{"b": null}', '{"a": "x"}', ' {"b": "y", "c": 2} ']
    df = spark.createDataFrame([(t,) for t in bad + good], "value string")
    got = decode_json(df, SCHEMA, keep=["value"], corrupt_col="_corrupt").collect()
    assert {r["value"]: r["_corrupt"] for r in got} == {t: t in bad for t in bad + good}


def test_read_records_keeps_partitions_and_reads_csv_folders(spark, tmp_path):
    df = spark.range(4).withColumn("day", F.lit("d") )
    df.write.partitionBy("day").parquet(str(tmp_path / "p"))
    assert read_records(spark, str(tmp_path / "p")).columns == ["id", "day"]
    df.write.option("header", "true").csv(str(tmp_path / "c"))
    assert read_records(spark, str(tmp_path / "c"), fmt="csv").count() == 4


def test_checkpoint_folder_is_named_on_a_cluster(spark):
    class Remote:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Remote)


def test_stream_score_returns_every_record(spark, sf_small):
    from netsift.plans.queries import queries

    q = queries()
    topics = {r["topic"]: r["count"] for r in q["stream_score"](spark, sf_small).groupBy("topic").count().collect()}
    rules = {r["topic"]: r["count"] for r in q["stream_deadletter"](spark, sf_small).groupBy("topic").count().collect()}
    assert topics["deadletter"] == rules["deadletter"] and topics["predictions"] == rules["predictions"]
