"""Line dedup by a log-template tree (operator 6).

Each line walks a tree of fixed depth: its number of words, then its leading
``LEADING`` words (lower case), then the leaf. In the leaf variable fields are
generalised: words with a digit become ``<*>``, and of the rest one of
``FIELDS`` runs of neighbouring words may vary (lines of ``LONG`` words or
more). A template is a leaf with its fixed words; a template that
``LEAST_DOCS`` documents or more hold recurs, and lines that match a
recurring template are dropped. Lines under ``LEAST_WORDS`` words stay.

A document counts once per template, so counts are exact sums, combined
before the shuffle; a line that a third of all documents hold is no hot task.
Edge cases: null counts as empty text (one empty line, kept); a document may
lose all its lines and then has an empty text; every row is a document of its
own, so rows that share a ``doc_id`` or have none count each and lose what recurs; an
empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import pieces, read, small_enough, staged, whole_text

LEADING, FIELDS, LONG, LEAST_WORDS, LEAST_DOCS = 2, 3, 8, 3, 5
#: Recurring templates (16 bytes each here) that are broadcast at most.
SET_BYTES = 32 << 20
VARIABLE = re.compile(rb"\S*[0-9]\S*")


def templates(line: str) -> list[int]:
    """Template hashes of a line, most specific first."""
    import xxhash

    words = VARIABLE.sub(b"<*>", line.lower().encode("utf-8", "replace")).split()
    n = len(words)
    if n < LEAST_WORDS:
        return []
    tree = b"%d " % n + b" ".join(words[:LEADING])
    out = [xxhash.xxh3_64_intdigest(tree + b"\n" + b" ".join(words[LEADING:]))]
    if n >= LONG:
        rest = words[LEADING:]
        cut = [len(rest) * k // FIELDS for k in range(FIELDS + 1)]
        runs = [b" ".join(rest[cut[k] : cut[k + 1]]) for k in range(FIELDS)]
        for k in range(FIELDS):
            out.append(xxhash.xxh3_64_intdigest(tree + b"\n%d\n" % k + b"\n".join(runs[:k] + [b"<*>"] + runs[k + 1 :])))
    return out


def parsed(docs: DataFrame) -> DataFrame:
    """Staged rows: doc_id, row, text, and the templates of its lines beside the lines' numbers. Every line is parsed here, once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for d in pieces(batches):
            found, where = [], []
            for t in d["text"]:
                lines = t.split("\n")
                known = {x: templates(x) for x in set(lines)}
                found.append(np.array([h for x in lines for h in known[x]], np.uint64).view(np.int64))
                where.append(np.array([k for k, x in enumerate(lines) for _ in known[x]], np.int32))
            yield d.assign(templates=found, lines=where)

    source = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), whole_text().alias("text"))
    return staged(source.mapInPandas(rows, f"doc_id {kind}, row bigint, text string, templates array<bigint>, lines array<int>"), "parsed")


def recurring(rows: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Templates that ``least`` rows or more hold."""
    each = rows.select(F.explode(F.array_distinct("templates")).alias("template"))
    return each.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("template")


def stripped(d: pd.DataFrame, drop) -> pd.DataFrame:
    """The rows without the lines whose numbers ``drop`` lists."""
    out = []
    for t, gone in zip(d["text"], drop):
        lines, gone = t.split("\n"), set(gone)
        stay = [x for k, x in enumerate(lines) if k not in gone]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    p = pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])
    p.insert(0, "doc_id", d["doc_id"].to_numpy())
    return p


def cleaned(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, text (the lines that stay).

    A recurring set within ``SET_BYTES`` is broadcast and no text is shuffled;
    a larger one meets the exploded templates in a join, and the numbers of the hit lines their rows in another.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = parsed(docs)
    often = staged(recurring(rows, least), "recurring")

    def by_set(batches):
        keys = shared.value
        for d in pieces(batches):
            flat = np.concatenate([np.zeros(0, np.int64), *d["templates"]])
            spot = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            hit = keys[spot] == flat if len(keys) else np.zeros(len(flat), bool)
            ends = np.cumsum([len(x) for x in d["templates"]])[:-1]
            yield stripped(d, [n[h].tolist() for n, h in zip(d["lines"], np.split(hit, ends))])

    def by_join(batches):
        for d in pieces(batches):
            yield stripped(d, [() if x is None else np.asarray(x).tolist() for x in d["drop"]])

    schema = f"doc_id {kind}, n_lines bigint, n_dropped bigint, text string"
    if small_enough(often, 16, SET_BYTES):
        shared = docs.sparkSession.sparkContext.broadcast(np.sort(often.toPandas()["template"].to_numpy(np.int64)))
        return rows.select("doc_id", "text", "templates", "lines").mapInPandas(by_set, schema)
    each = rows.select("row", F.explode(F.arrays_zip("templates", "lines")).alias("x")).select("row", F.col("x.templates").alias("template"), F.col("x.lines").alias("line"))
    hits = staged(each.join(often, "template", "left_semi").groupBy("row").agg(F.collect_set("line").alias("drop")), "hits")
    return rows.select("doc_id", "row", "text").join(hits, "row", "left").select("doc_id", "text", "drop").mapInPandas(by_join, schema)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(read(spark, sf_dir, "documents"))
