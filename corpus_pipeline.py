"""Corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept; ``run`` writes each result as Parquet in the shared folder and
reads it back. The filtering stages return the columns of ``documents`` as
they are (extra columns too). Exact dedup names a row by its id and text; the other
filters name it by its id, so a decision on one of several rows with an id holds for all of them,
and rows without an id stay there. Near copies share 80 % or more of their
shingles of five words. An empty
``documents`` gives an empty result with the same schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm import decontaminate, exact_dedup, ngram_join, packing, toxicity
from netsift.llm.common import BLANKS, read, staged, whole_text

#: A document scoring this or more is rejected, as the toxicity operator itself predicts.
REJECT_TOXIC = 0.3


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``dropped`` (one column, doc_id)."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return without(docs, staged(scored.where(F.col("score") >= REJECT_TOXIC).select("doc_id"), "toxic"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the others go: rows are named by id and text, so one id may hold several texts."""
    digest = F.sha2(F.translate(whole_text(), BLANKS, ""), 256)
    rows = staged(exact_dedup.dedup(docs).select("doc_id", "kept", "text_sha256"), "copies")
    pair = ["doc_id", "text_sha256"]
    gone = rows.where("NOT kept").select(*pair).distinct()
    # of rows that repeat an id with its text, the longest stays
    again = gone.alias("g").join(rows.where("kept").alias("k"), F.expr("g.doc_id <=> k.doc_id AND g.text_sha256 = k.text_sha256"), "left_semi")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), "doc_id", digest.alias("text_sha256"))

    def joined(pairs: DataFrame, how: str) -> DataFrame:
        return named.alias("n").join(pairs.alias("p"), F.expr("n.doc_id <=> p.doc_id AND n.text_sha256 = p.text_sha256"), how)

    longest = Window.partitionBy(*pair).orderBy(F.length("whole.text").desc())
    once = joined(again, "left_semi").withColumn("place", F.row_number().over(longest)).where("place = 1")
    return joined(gone, "left_anti").select("whole.*").unionByName(once.select("whole.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = ngram_join.components(docs, words=5, percent=80)
    return without(docs, linked.where(F.col("component_id") != F.col("doc_id")).select("doc_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without(docs, decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Compression lengths, tokenizer ids and best-fit plans have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
