"""Tree ensembles as node tables: export, native scoring and SQL text.

A fitted forest is written by Spark ML as one row per node. :func:`node_table`
reads those files back as a typed table, so no node passes the
driver, and :func:`score` evaluates the table over feature arrays with built-in
higher-order functions: a walk of at most ``depth`` steps per tree and a vote,
with the sums in the order of Spark ML, so predictions and votes are equal to
``model.transform`` bit by bit. :func:`walk_sql` is the same walk as SQL over
the same table, for engines that only see tables.

The ensemble reaches the rows as one scalar subquery (trees x nodes, bounded by
the learner's parameters, not by the data); rows are not shuffled.
``model.transform`` is faster and stays the default scorer.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Ensemble = RandomForestClassificationModel | GBTClassificationModel


def ensemble_of(model: PipelineModel | Ensemble) -> Ensemble:
    """The tree ensemble of a fitted pipeline (its last stage) or the ensemble itself."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not isinstance(last, (RandomForestClassificationModel, GBTClassificationModel)):
        raise ValueError(f"not a tree ensemble: {type(last).__name__}")
    return last


def node_table(spark: SparkSession, model: PipelineModel | Ensemble, path: str) -> DataFrame:
    """One row per node of the ensemble, which is saved under ``path``.

    ``tree, weight, node, feature, threshold, categories, left, right,
    prediction, votes``: ``left``/``right`` are null on leaves; ``threshold`` is
    set on numeric splits (left when x <= threshold), ``categories`` on nominal
    ones (left when x is listed); ``votes`` are the node's class shares.
    """
    ensemble_of(model).write().overwrite().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    n = F.col("nodeData")
    split = n["split"]
    inner, nominal = n["leftChild"] >= 0, split["numCategories"] >= 0
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & ~nominal, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & nominal, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("prediction"),
        F.when(total != 0, F.transform(n["impurityStats"], lambda x: x / total)).alias("votes"),
    )
    return nodes.join(weights, "tree")


def _packed(nodes: DataFrame) -> Column:
    """The whole table as one array of trees, each an array of nodes in order of their numbers."""
    fields = ["feature", "threshold", "categories", "left", "right", "prediction", "votes"]
    by_number = F.sort_array(F.collect_list(F.struct("node", F.struct(*fields).alias("is"))))
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.transform(by_number, lambda x: x["is"]).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()


def _leaf(nodes: Column, features: Column, depth: int) -> Column:
    # the node itself is carried along: its number would be looked up again for each of its fields
    def step(node: Column, _: Column) -> Column:
        x = features[node["feature"]]
        goes_left = F.when(node["threshold"].isNotNull(), x <= node["threshold"]).otherwise(F.array_contains(node["categories"], x))
        return F.when(node["left"].isNull(), node).otherwise(nodes[F.when(goes_left, node["left"]).otherwise(node["right"])])

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), nodes[0], step)


def score(df: DataFrame, nodes: DataFrame, model: PipelineModel | Ensemble, features: str = "features") -> DataFrame:
    """Add ``prediction`` and ``votes`` (class votes of a forest, ``[-margin, margin]`` of boosted trees).

    ``features`` is an array of doubles (``vector_to_array`` of a vector column). Ties go to the class with the
    smaller number, as in Spark ML; a NaN goes right at a numeric split.
    """
    ensemble = ensemble_of(model)
    depth = ensemble.getMaxDepth()
    leaves = F.transform(
        F.col("__trees"), lambda t: F.struct(t["weight"].alias("weight"), _leaf(t["nodes"], F.col(features), depth).alias("leaf"))
    )
    out = df.withColumn("__trees", _packed(nodes)).withColumn("__leaves", leaves)
    if isinstance(ensemble, GBTClassificationModel):
        margin = F.aggregate("__leaves", F.lit(0.0), lambda a, x: a + x["leaf"]["prediction"] * x["weight"])
        out = out.withColumn("__margin", margin)
        out = out.withColumns(
            {"votes": F.array(-F.col("__margin"), F.col("__margin")), "prediction": F.when(F.col("__margin") > 0, 1.0).otherwise(0.0)}
        )
    else:
        none = F.array_repeat(F.lit(0.0), ensemble.numClasses)
        add = lambda a, x: F.when(x["leaf"]["votes"].isNull(), a).otherwise(F.zip_with(a, x["leaf"]["votes"], lambda p, q: p + q))
        out = out.withColumn("votes", F.aggregate("__leaves", none, add))
        out = out.withColumn("prediction", (F.array_position("votes", F.array_max("votes")) - 1).cast("double"))
    return out.drop("__trees", "__leaves", "__margin")


def walk_sql(rows: str, nodes: str, key: str = "key", features: str = "features") -> str:
    """SQL text (DuckDB) of the walk: ``key, tree, node`` of every leaf reached.

    ``rows`` has ``key`` and a list of doubles, ``nodes`` is a :func:`node_table`.
    """
    x = f"r.{features}[n.feature + 1]"
    return f"""
WITH RECURSIVE walk AS (
  SELECT r.{key}, t.tree, 0 AS node FROM {rows} r CROSS JOIN (SELECT DISTINCT tree FROM {nodes}) t
  UNION ALL
  SELECT w.{key}, w.tree, CASE WHEN (CASE WHEN n.threshold IS NOT NULL THEN {x} <= n.threshold
      ELSE list_contains(n.categories, {x}) END) THEN n."left" ELSE n."right" END
  FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.node = w.node AND n."left" IS NOT NULL
  JOIN {rows} r ON r.{key} = w.{key}
)
SELECT w.{key}, w.tree, w.node FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.node = w.node WHERE n."left" IS NULL"""


def exact_tree(df: DataFrame, features: str, label: str, depth: int, min_rows: int = 1):
    """One tree without sampling of rows or features: the same rows always give the same tree.

    With few distinct values per feature every boundary between two of them is
    a candidate split, so SQL can grow the same tree with groupings alone.
    """
    from pyspark.ml.classification import RandomForestClassifier

    learner = RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=1, maxDepth=depth, bootstrap=False, featureSubsetStrategy="all",
        subsamplingRate=1.0, minInstancesPerNode=min_rows, impurity="gini", seed=0,
    )
    return learner.fit(df)


def exact_tree_sql(rows: str, columns: list[str], depth: int, source_ctes: str) -> str:
    """DuckDB text that grows :func:`exact_tree` and scores every row with it.

    ``rows`` has ``key``, ``train`` (boolean), ``y`` (0 or 1) and the binned ``columns``. Gini gain over all boundaries,
    best per node, ties by feature and then boundary; nodes are numbered 2n (left) and 2n + 1. Sibling leaves
    that predict the same class are one leaf, as Spark ML makes them.
    Returns ``key, prediction, benign_share``.
    """
    ctes = [source_ctes, f"level0 AS (SELECT *, 1 AS node FROM {rows})"]
    listed = ", ".join(f"{{'f': {i}, 'v': {c}}}" for i, c in enumerate(columns))

    def gini(a: str, b: str) -> str:
        return f"(1.0 - ({a} / ({a} + {b})) * ({a} / ({a} + {b})) - ({b} / ({a} + {b})) * ({b} / ({a} + {b})))"

    for d in range(depth):
        values = ", ".join(f"r.{c}" for c in columns)
        ctes += [
            f"cells{d} AS (SELECT node, u.f AS f, u.v AS v, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS c0, "
            f"CAST(count(*) FILTER (y = 1) AS DOUBLE) AS c1 FROM (SELECT node, y, unnest([{listed}]) AS u FROM level{d} WHERE train) "
            f"GROUP BY ALL)",
            f"sides{d} AS (SELECT node, f, v, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, "
            f"sum(c0) OVER (PARTITION BY node, f) AS t0, sum(c1) OVER (PARTITION BY node, f) AS t1 FROM cells{d} "
            f"WINDOW w AS (PARTITION BY node, f ORDER BY v))",
            f"gains{d} AS (SELECT node, f, v, {gini('t0', 't1')} - ((l0 + l1) / (t0 + t1)) * {gini('l0', 'l1')} "
            f"- ((t0 - l0 + t1 - l1) / (t0 + t1)) * {gini('(t0 - l0)', '(t1 - l1)')} AS gain FROM sides{d} "
            f"WHERE t0 + t1 > l0 + l1)",
            f"best{d} AS (SELECT node, f, v FROM gains{d} WHERE gain > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)",
            f"level{d + 1} AS (SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node "
            f"WHEN ([{values}])[b.f + 1] <= b.v THEN 2 * r.node ELSE 2 * r.node + 1 END AS node) "
            f"FROM level{d} r LEFT JOIN best{d} b ON r.node = b.node)",
        ]
    ctes.append(
        f"leaves{depth} AS (SELECT node, CAST(count(*) FILTER (y = 0) AS DOUBLE) AS c0, CAST(count(*) FILTER (y = 1) AS DOUBLE) AS c1 "
        f"FROM level{depth} WHERE train GROUP BY node)"
    )
    for d in range(depth, 2 * depth):
        merged = "CASE WHEN p.parent IS NULL THEN r.node ELSE p.parent END AS node"
        ctes += [
            f"twins{d} AS (SELECT node // 2 AS parent FROM leaves{d} GROUP BY ALL HAVING count(*) = 2 AND count(DISTINCT c1 > c0) = 1)",
            f"leaves{d + 1} AS (SELECT {merged}, sum(c0) AS c0, sum(c1) AS c1 "
            f"FROM leaves{d} r LEFT JOIN twins{d} p ON r.node // 2 = p.parent GROUP BY 1)",
            f"level{d + 1} AS (SELECT r.* REPLACE ({merged}) FROM level{d} r LEFT JOIN twins{d} p ON r.node // 2 = p.parent)",
        ]
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT r.key, CASE WHEN c1 > c0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, "
        f"c1 / (c0 + c1) AS benign_share FROM level{2 * depth} r JOIN leaves{2 * depth} l ON r.node = l.node"
    )
