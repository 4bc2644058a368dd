"""Hard-negative mining over anchor-clustered shared lists (operator 12).

Anchors are clustered by direction. A cluster with centroid ``c`` and widest
member angle ``w`` bounds the score of every member ``a`` with a candidate
``x`` by ``|a| |x| cos(max(0, angle(c, x) - w))``. For each cluster a block of
candidates is sorted by ``|x| cos(...)`` once; all members walk that list in
chunks, and a member leaves it when its bound there is below what it still
needs, which certifies that the rest of the list can't change its result.

Two walks: the first finds the anchors' positives (best ``positives`` other
rows of the same label, from the label's part of the list), the second the best
``negatives`` rows of other labels in each positive's band of scores. Blocks
report their best few, and a ranking per anchor merges them.

Partitioning: candidates are dealt by hash into blocks of about
``BLOCK_BYTES`` (at least ``LEAST_BLOCKS``, so that small tables use several
tasks); the anchors, a stated query set, visit every block sorted by cluster,
in batches of ``BATCH`` members. No task holds more than one block and one batch.
The centroids are fitted on at most ``FIT_ROWS`` anchors (in order of a hash);
every anchor is then assigned and every row is a candidate.

Rows that are equal in label and vector have equal scores with
everything, so ties by id leave only the smallest ``positives + 1`` ids of such a
group a place in any result; only these are kept as candidates. All
anchors are kept.

Edge cases: rows with a null label, a null id, a null vector or any null, NaN
or infinite component take no part; vectors of different lengths are
compared as if the shorter ended in zeros; an empty vector and a vector of
zeros score 0 with everything; rows that repeat an id are rows of their own
(an anchor's "other rows" leave out one row, itself); scores are exact integers
(32- or 64-bit floats where the norms prove every sum exact, Python integers
beyond) and are held at the limits of a long; an empty table, or one without anchors, gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import read, staged

POSITIVES, NEGATIVES = 5, 3
#: The band of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
BLOCK_BYTES, LEAST_BLOCKS = 128 << 20, 8
FIT_ROWS, CLUSTERS = 4096, 64
BATCH, CHUNK = 1024, 2048
NONE = -(1 << 62)


def scaled(rows: pa.Array, width: int) -> np.ndarray:
    """``floor(SCALE * x)`` of list rows as float64, padded with zeros to ``width``."""
    length = np.diff(rows.offsets.to_numpy())
    flat = np.floor(SCALE * rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(length) and (length == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(length), width))
    out[np.arange(width) < length[:, None]] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray, size: float) -> np.ndarray:
    """Exact integer products of the rows of ``a`` and ``b``; ``size`` bounds the product of their norms."""
    if size < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if size < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a).dot(whole(b).T), -(2**63) + 1, 2**63 - 1).astype(np.int64)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def angles(x: np.ndarray, length: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Angle of every row with every centroid (unit vectors); rows of zeros have angle 0."""
    cos = (x / np.maximum(length, 1e-300)[:, None]) @ centroids.T
    return np.where(length[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0.0)


def fit(x: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of a bounded sample by spherical k-means; the start is spread over the sample."""
    x = x[norms(x) > 0]
    if len(x) == 0:
        return np.eye(1, max(1, x.shape[1]))
    x = np.unique(x / norms(x)[:, None], axis=0)
    centroids = x[np.linspace(0, len(x) - 1, min(clusters, len(x))).astype(int)]
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        size = norms(sums)
        centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centroids)
    return centroids


def best(member: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each member's ``k`` best pairs: higher score, then smaller id."""
    order = np.lexsort((ids, -score, member))
    member = member[order]
    first = np.flatnonzero(np.r_[True, member[1:] != member[:-1]]) if len(member) else np.zeros(0, int)
    place = np.arange(len(member)) - np.repeat(first, np.diff(np.r_[first, len(member)]))
    return order[place < k]


def kth(member: np.ndarray, score: np.ndarray, members: int, k: int, otherwise: np.ndarray) -> np.ndarray:
    """Each member's ``k``-th best score among its at most ``k`` pairs, ``otherwise`` for fewer."""
    least = np.full(members, np.iinfo(np.int64).max)
    np.minimum.at(least, member, score)
    return np.where(np.bincount(member, minlength=members) >= k, least, otherwise)


class Block:
    """One block of candidates and its list for the cluster at hand."""

    def __init__(self, ids, rows, labels, x):
        self.ids, self.rows, self.labels, self.x = ids, rows, labels, x
        self.length = norms(x)
        self.longest = self.length.max(initial=0.0)

    def arrange(self, centroid: np.ndarray, width: float) -> None:
        """Sort by the bound for a cluster (with room for rounding), once for all its members."""
        angle = angles(self.x, self.length, centroid[None])[:, 0]
        bound = self.length * (np.cos(np.maximum(0.0, angle - width - 1e-6)) + 1e-6)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]

    def walk(self, part: np.ndarray, a: np.ndarray, wanted, need: np.ndarray, k: int):
        """Best ``k`` of ``part`` (places in the list) for each row of ``a``.

        ``wanted(members, candidates, scores)`` says which pairs count;
        ``need`` is the least score that can matter. Returns (member, candidate, score).
        """
        own = norms(a)
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        need = need.copy()
        for at in range(0, len(part), CHUNK):
            here = part[at : at + CHUNK]
            bound = self.bound[here]
            # the certificate: bounds only fall from here on
            active = np.flatnonzero(own * bound[0] + 1e-3 >= need)
            if len(active) == 0:
                break
            cand = self.order[here]
            s = scores(a[active], self.x[cand], float(own[active].max() * self.longest))
            good = wanted(active, cand, s) & (s >= need[active, None])
            if len(here) > k:  # a member with many new pairs: only those from its k-th best on can stay
                many = np.flatnonzero(good.sum(axis=1) > 4 * k)
                top = np.partition(np.where(good[many], s[many], NONE), -k, axis=1)[:, -k]
                good[many] &= s[many] >= top[:, None]
            i, j = np.nonzero(good)
            member = np.r_[found[0], active[i]]
            candidate = np.r_[found[1], cand[j]]
            score = np.r_[found[2], s[i, j]]
            stay = best(member, score, self.ids[candidate], k)
            found = (member[stay], candidate[stay], score[stay])
            need = np.maximum(need, kth(found[0], found[2], len(a), k, need))
        return found


def walks(width: int, centroids: np.ndarray, widest: dict[int, float], visit):
    """Function for ``mapInArrow`` over rows sorted by (block, cluster): a block's candidates (cluster -1), then
    its anchors; ``visit(block, anchors, x)`` gives a record batch per batch of one cluster's anchors."""

    def run(batches):
        number, block, held, arranged = None, None, [], None
        for batch in batches:
            key = batch.column("block").to_numpy().astype(np.int64) * (len(centroids) + 1) + batch.column("cluster").to_numpy() + 1
            cut = np.flatnonzero(np.diff(key)) + 1
            for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(key)]):
                rows = batch.slice(lo, hi - lo)
                cluster, of = rows.column("cluster")[0].as_py(), rows.column("block")[0].as_py()
                if of != number:
                    number, block, held, arranged = of, None, [], None
                if cluster < 0:
                    held.append(rows)
                    continue
                if block is None and held:
                    ids, names, labels = (
                        np.concatenate([h.column(c).to_numpy(zero_copy_only=False) for h in held]) for c in ("vec_id", "row", "label")
                    )
                    block = Block(ids, names, labels, np.concatenate([scaled(h.column("vector"), width) for h in held]))
                    held = []
                if block is None:
                    continue
                if arranged != cluster:
                    block.arrange(centroids[cluster], widest[cluster])
                    arranged = cluster
                for start in range(0, len(rows), BATCH):
                    anchors = rows.slice(start, BATCH)
                    yield visit(block, anchors, scaled(anchors.column("vector"), width))

    return run


def nearest_positives(k: int):
    def visit(block: Block, anchors, x: np.ndarray):
        own, labels = (anchors.column(c).to_numpy(zero_copy_only=False) for c in ("row", "label"))
        in_list = block.labels[block.order]
        out = []
        for label in np.unique(labels):
            mine = np.flatnonzero(labels == label)
            others = lambda m, c, s, mine=mine: own[mine[m], None] != block.rows[c]
            m, c, s = block.walk(np.flatnonzero(in_list == label), x[mine], others, np.full(len(mine), NONE), k)
            out.append((own[mine[m]], block.ids[c], block.rows[c], s))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out)], ["row", "positive_id", "positive_row", "positive_score"])

    return visit


def negatives_in_band(k: int, low: int, high: int):
    def visit(block: Block, anchors, x: np.ndarray):
        own, labels = (anchors.column(c).to_numpy(zero_copy_only=False) for c in ("row", "label"))
        bands = anchors.column("scores")
        whole = np.arange(len(block.ids))
        out = [(np.zeros(0, np.int64),) * 4]
        values, start = bands.flatten().to_numpy(zero_copy_only=False), bands.offsets.to_numpy() - bands.offsets[0].as_py()
        count = np.diff(start)
        for place in range(count.max(initial=0)):
            mine = np.flatnonzero(count > place)
            p = values[start[mine] + place]
            # 100 n >= low p and 100 n <= high p over integers, by division so that nothing overflows
            least = low * (p // 100) - (-low * (p % 100) // 100)
            most = high * (p // 100) + high * (p % 100) // 100
            usable = least <= most
            mine, p, least, most = mine[usable], p[usable], least[usable], most[usable]

            def wanted(m, c, s, mine=mine, most=most):
                return (labels[mine[m], None] != block.labels[c]) & (s <= most[m, None])

            m, c, s = block.walk(whole, x[mine], wanted, least, k)
            out.append((own[mine[m]], p[m], block.ids[c], s))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*out)], ["row", "positive_score", "negative_id", "negative_score"])

    return visit


def usable(table: DataFrame, relabel: Column | None = None) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & finite)
    label = (F.col("label") if relabel is None else relabel).cast("long")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector"))


def assigned(anchors: DataFrame, width: int, centroids: np.ndarray) -> DataFrame:
    """Anchors with their cluster and their angle to its centroid."""

    def assign(batches):
        for batch in batches:
            x = scaled(batch.column("vector"), width)
            angle = angles(x, norms(x), centroids)
            cluster = angle.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            own = angle[np.arange(len(x)), cluster]
            arrays = [pa.array(cluster.astype(np.int32)), pa.array(own), *batch.columns]
            yield pa.RecordBatch.from_arrays(arrays, ["cluster", "angle", *batch.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    return anchors.mapInArrow(assign, f"cluster int, angle double, {fields}")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
    least_blocks: int = LEAST_BLOCKS,
    clusters: int = CLUSTERS,
) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (vec_id, label, vector), see the module's text."""
    spark = vectors.sparkSession
    rows = staged(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = rows.agg(F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    width = max(1, found["width"] or 0)
    blocks = max(least_blocks, math.ceil(found["n"] * width * 8 / block_bytes))

    sample = rows.where(is_anchor).orderBy(F.xxhash64("vec_id", "row")).limit(FIT_ROWS).select("vector").toArrow()
    listed = [scaled(chunk, width) for chunk in sample.column("vector").chunks] or [np.zeros((0, width))]
    centroids = fit(np.concatenate(listed), clusters)
    anchors = staged(assigned(rows.where(is_anchor), width, centroids), "anchors")
    widest = {r["cluster"]: r["w"] for r in anchors.groupBy("cluster").agg(F.max("angle").alias("w")).collect()}

    # equal rows tie everywhere; of such a group only the first few ids can be in a result
    first = Window.partitionBy("label", "vector").orderBy("vec_id", "row")
    few = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= max(positives + 1, negatives))
    block = F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int")
    candidates = staged(few.select(block.alias("block"), F.lit(-1).alias("cluster"), "vec_id", "row", "label", "vector"), "candidates")

    def visits(queries: DataFrame, visit, schema: str) -> DataFrame:
        everywhere = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("angle")
        both = candidates.unionByName(everywhere, allowMissingColumns=True)
        dealt = both.repartitionById(blocks, "block").sortWithinPartitions("block", "cluster")
        return dealt.mapInArrow(walks(width, centroids, widest, visit), schema)

    near = visits(anchors, nearest_positives(positives), "row bigint, positive_id bigint, positive_row bigint, positive_score bigint")
    by_score = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    near = near.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    near = staged(near, "positives")

    bands = near.groupBy("row").agg(F.collect_set("positive_score").alias("scores"))
    hard = visits(
        anchors.join(bands, "row"), negatives_in_band(negatives, low, high),
        "row bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    by_score = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return (
        near.join(hard, ["row", "positive_score"])
        .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(read(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
