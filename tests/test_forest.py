"""Node-table scoring equals Spark ML's own, natively and as SQL."""

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from netsift.operators import forest
from netsift.session import scratch_path

COLS = ["orig_bytes", "resp_pkts", "duration"]


@pytest.fixture(scope="module")
def records(spark, sf_small):
    from netsift.sources import tables

    df = tables.conn_records(spark, sf_small).select("key", "protocol", "conn_state", "service", "label_multi", *COLS)
    extra = [("nan", "tcp", "S0", "x", "none", float("nan"), float("inf"), -0.0), ("none", "tcp", "S0", "x", "none", None, 1.0, 2.0)]
    more = spark.createDataFrame(extra, df.schema)
    return df.dropDuplicates(["key"]).unionByName(more).withColumn("y", F.when(F.col("label_multi") == "none", 1.0).otherwise(0.0)).cache()


def fitted(records, learner):
    cats = ["protocol", "conn_state", "service"]
    stages = [
        StringIndexer(inputCol="label_multi", outputCol="label", handleInvalid="keep"),
        StringIndexer(inputCols=cats, outputCols=[f"{c}_i" for c in cats], handleInvalid="keep"),
        VectorAssembler(inputCols=[*[f"{c}_i" for c in cats], *COLS], outputCol="features", handleInvalid="keep"),
        learner,
    ]
    return Pipeline(stages=stages).fit(records.na.drop())


LEARNERS = {
    "forest": lambda: RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=7, maxBins=256, seed=3),
    "two classes": lambda: RandomForestClassifier(labelCol="y", numTrees=3, maxDepth=5, maxBins=256, seed=3),
    "boosted": lambda: GBTClassifier(labelCol="y", maxIter=4, maxDepth=3, maxBins=256, seed=3),
    "stump": lambda: RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=0, maxBins=256, seed=3),
}


@pytest.mark.parametrize("name", sorted(LEARNERS))
def test_node_table_scores_like_the_model(spark, records, name):
    model = fitted(records, LEARNERS[name]())
    scored = model.transform(records).select(
        "key", vector_to_array("features").alias("features"), vector_to_array("rawPrediction").alias("raw"), F.col("prediction").alias("ml")
    )
    nodes = forest.node_table(spark, model, scratch_path(spark, f"forest-test-{name.replace(' ', '-')}")).cache()
    if name in ("forest", "boosted"):
        assert nodes.where("categories IS NOT NULL").count() and nodes.where("threshold IS NOT NULL").count()
    got = forest.score(scored, nodes, model)
    assert got.count() == records.count()
    assert got.where("prediction <> ml OR prediction IS NULL").count() == 0
    assert got.where(F.col("votes") != F.col("raw")).count() == 0

    rows = scored.select("key", "features").toArrow()
    table = nodes.toArrow()
    con = duckdb.connect()
    con.register("scored_rows", rows)
    con.register("node_rows", table)
    leaves = con.execute(
        f"WITH leaves AS ({forest.walk_sql('scored_rows', 'node_rows')}) "
        "SELECT key, tree, weight, prediction, votes FROM leaves JOIN node_rows USING (tree, node) ORDER BY key, tree"
    ).fetchall()
    want = {r["key"]: r["votes"] for r in got.collect()}
    sums = {}
    for key, _, weight, prediction, votes in leaves:
        add = [-weight * prediction, weight * prediction] if name == "boosted" else votes
        sums[key] = [a + b for a, b in zip(sums.get(key, [0.0] * len(add)), add)]
    assert sums == want


def test_only_ensembles_have_a_node_table(spark):
    with pytest.raises(ValueError, match="tree ensemble"):
        forest.ensemble_of(StringIndexer(inputCol="id", outputCol="i").fit(spark.range(2)))


def test_forest_scored_equals_batch_scoring(spark, sf_small):
    from netsift.plans.queries import queries

    q = queries()
    own = q["forest_scored"](spark, sf_small)
    ml = q["scored_prediction_int"](spark, sf_small).select("key", F.col("prediction").alias("p"), F.col("predicted_label").alias("l"))
    assert own.count() == ml.count() > 0
    assert own.exceptAll(ml.toDF("key", "prediction", "predicted_label")).count() == 0
