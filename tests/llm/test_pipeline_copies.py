"""The pipeline's exact dedup loses no text whose copy does not stay."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def kept(spark, rows, sf_small):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("whole", F.lit(1))
    got = corpus_pipeline.drop_copies(spark, docs, sf_small)
    assert got.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)


@pytest.mark.parametrize(
    "rows, stay",
    [
        (
            [(1, "a b"), (1, "a b"), (1, "zzz unique"), (2, "x"), (2, "q long"), (3, "q  long")],
            [(1, "a b"), (1, "zzz unique"), (2, "x"), (3, "q  long")],
        ),
        ([(1, "a b"), (1, "a  b"), (1, "ab"), (2, "ab")], [(1, "a  b")]),
        ([(None, "t"), (None, "t"), (5, "t"), (None, "u"), (None, None), (7, ""), (8, " ")], [(5, "t"), (8, " "), (None, "u")]),
        ([(1, None), (1, None)], [(1, None)]),
        ([(1, None), (1, "")], None),
        ([], []),
    ],
)
def test_every_text_stays_once(spark, sf_small, rows, stay):
    got = kept(spark, rows, sf_small)
    if stay is not None:
        assert got == sorted(stay, key=str)
    texts = {"".join((t or "").split()) for _, t in rows}
    assert sorted("".join((t or "").split()) for _, t in got) == sorted(texts)
