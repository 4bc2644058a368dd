"""Exact dedup through a persistent digest index (operator 2, DataFrame and SQL functions only).

The index is a table in a folder, bucketed and sorted by digest and
partitioned by load and part, which any later session opens by its path. A
load is dealt by a hash of its rows into the index's number of parts, and they go
through the index one after the other: a part is reduced to one candidate per
digest (partial aggregation, so a text with a third of all rows is no hot
key), a sort-merge anti-join against the index removes the candidates whose
text an earlier load holds, or of which this load holds a row that stays
before it, and the rest are appended. The index is read by its buckets in that
join and in the last one, and is never shuffled. Rows then look up the one
that stays; that join reads staged files, so Spark may split the partition of
a hot digest.

A load that failed can be repeated under its name: its own entries are not
held against it and are replaced part by part. One load writes to an index
at a time.

Edge cases: null text counts as empty; all empty and all-blank texts are one
group; among equal lengths the smallest ``doc_id`` stays and a null
``doc_id`` loses to any other; of rows that repeat id and text one stays. An
empty table gives no rows and leaves the index without new digests. Only ``doc_id`` and
``text`` are read, so other columns can have any names.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import BLANKS, read, shared_path, staged, whole_text

#: Parts of a load, each of which meets those before it in the index.
PARTS = 4


class DigestIndex:
    """Digests seen so far: ``digest``, ``n_chars``, ``keep_id``, ``keep_row``, ``load``, ``part``.

    ``path`` names a lasting folder; an index that it holds already is opened with the numbers of
    buckets and parts and the type of ids that it was made with. Without ``path`` the index lies
    among the staged tables and goes with them.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, parts: int = PARTS, id_type: str = "bigint"):
        self.spark = spark
        self.path = (path or shared_path(spark, "digest_index")).rstrip("/")
        self.name = f"digests_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        about = f"{self.path}/_index"
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{about}/_SUCCESS")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            made = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(parts).alias("parts"), F.lit(id_type).alias("id_type"))
            made.coalesce(1).write.mode("overwrite").json(about)
        found = spark.read.schema("buckets int, parts int, id_type string").json(about).first()
        self.buckets, self.parts, self.id_type = found["buckets"], found["parts"], found["id_type"]
        self.register()

    def register(self) -> None:
        """Name the folder in the session's catalog, with the loads that it holds."""
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, n_chars INT, keep_id {self.id_type}, keep_row BIGINT, load STRING, part INT) "
            f"USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (load, part) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, candidates: DataFrame, load: str, part: int) -> DataFrame:
        """Candidates (one row per digest) of a part that no other load holds and no earlier part outranks."""
        held = self.entries().where((F.col("load") != load) | (F.col("part") < part))
        held = held.select(F.col("digest").alias("d"), "load", rank().alias("held"))
        outranked = (F.col("load") != load) | (F.col("held") <= F.col("best"))
        ranked = candidates.withColumn("best", rank())
        return ranked.join(held.hint("merge"), (F.col("digest") == F.col("d")) & outranked, "left_anti").drop("best")

    def append(self, new: DataFrame, load: str, part: int) -> None:
        """Store ``new`` (staged) as what a part of a load brought, instead of what an earlier try left."""
        new = new.select("digest", "n_chars", "keep_id", "keep_row").repartition(self.buckets, "digest")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (load = :load, part = {part}) SELECT * FROM {{new}}", args={"load": load}, new=new
        )

    def staying(self, load: str) -> DataFrame:
        """digest, mine (stored by ``load``), keep_id, keep_row of every text; an earlier load's row stays before ``load``'s."""
        first = F.min(F.struct((F.col("load") == load).alias("mine"), rank().alias("best"))).alias("first")
        best = self.entries().groupBy("digest").agg(first)
        return best.select("digest", "first.mine", F.col("first.best.keep_id").alias("keep_id"), F.col("first.best.keep_row").alias("keep_row"))


def rank() -> Column:
    """Order in which rows of equal texts stay: longest, smallest id, first row."""
    return F.struct((-F.col("n_chars")).alias("shorter"), F.col("keep_id").isNull().alias("nameless"), "keep_id", "keep_row")


def digests(docs: DataFrame, id_type: str, parts: int) -> DataFrame:
    text = whole_text()
    rows = docs.select(
        "doc_id",
        F.col("doc_id").cast(id_type).alias("keep_id"),
        F.monotonically_increasing_id().alias("keep_row"),
        F.length(text).alias("n_chars"),
        F.unhex(F.sha2(F.translate(text, BLANKS, ""), 256)).alias("digest"),
    )
    return rows.withColumn("part", F.pmod(F.xxhash64("keep_row"), F.lit(parts)).cast("int"))


def dedup(docs: DataFrame, index: DigestIndex | None = None, load: str | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size (rows of this load), kept, text_sha256.

    A row is kept if no earlier load holds its text and it is the one of this
    load that stays; the index then holds it for later loads.
    """
    index = index or DigestIndex(docs.sparkSession, id_type=docs.schema["doc_id"].dataType.simpleString())
    load = load or uuid.uuid4().hex
    rows = staged(digests(docs, index.id_type, index.parts), "digests")
    sizes = None
    for part in range(index.parts):
        best = rows.where(F.col("part") == part).groupBy("digest").agg(F.count("*").alias("n"), F.min(rank()).alias("best"))
        texts = best.select("digest", "n", (-F.col("best.shorter")).alias("n_chars"), "best.keep_id", "best.keep_row")
        texts = staged(texts, "texts")
        index.append(staged(index.unseen(texts.drop("n"), load, part), "unseen"), load, part)
        sizes = texts.select("digest", "n") if sizes is None else sizes.unionByName(texts.select("digest", "n"))
    groups = staged(sizes.groupBy("digest").agg(F.sum("n").alias("group_size")), "groups")
    found = staged(groups.join(index.staying(load).hint("merge"), "digest"), "found")
    mine = rows.select("digest", "doc_id", F.col("keep_row").alias("row"))
    return mine.join(found, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("mine") & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
