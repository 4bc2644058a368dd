"""Quality by an interpolated modified Kneser-Ney model (operator 10).

The model is of order four over UTF-16 code units, so a gram is exactly one
64-bit number: contexts and suffixes are shifts and masks of it. Trusted text
is that of documents labelled ``quality = 1``. One pass over all documents
counts the grams (combined per batch, summed by Spark), with the trusted
share beside. Continuation counts, discounts and back-off weights are
aggregations of the gram table, and joins of its shards give the probability
of every gram that any document holds. Shards of that table, each within
``SHARD_BYTES``, meet the documents by broadcast through the driver, one staged
pass per shard (the broadcast of a shard goes before the next), so the texts are never shuffled and a larger table only means more shards; the
partial sums add up, by id, language and digest of the text, to each row's
perplexity.

A document is kept if its perplexity is at most ``SLACK`` times the
``QUANTILE`` of the trusted documents of its language (of all trusted ones
where a language has fewer than ``LEAST``).

Edge cases: null and empty texts have the end mark alone as their one unit;
a null language is a group of its own; without trusted documents every
document is kept and the model is uniform; null or repeated labels count
once; rows that repeat are scored each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import checked, read, staged, whole_text

QUANTILE, SLACK, LEAST = 0.99, 1.1, 20
SHARD_BYTES = 64 << 20
CHUNK = 1 << 21
LOW = [0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF, -1]


def grams(text: str) -> np.ndarray:
    """Every 4-gram of code units, with three start marks and an end mark."""
    u = np.frombuffer(("\x02\x02\x02" + text + "\x03").encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    return u[:-3] << np.uint64(48) | u[1:-2] << np.uint64(32) | u[2:-1] << np.uint64(16) | u[3:]


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram, n (in all documents), trusted (in trusted ones) of ``docs`` (text, trusted)."""

    def rows(batches):
        def merged(parts):
            x, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return tuple([x, *(np.bincount(inverse, np.concatenate([p[i] for p in parts]), len(x)) for i in (1, 2))])

        def counted(held):
            parts = []
            for trust in (0, 1):
                if some := [g for g, t in held if t == trust]:
                    x, n = np.unique(np.concatenate(some), return_counts=True)
                    parts.append((x, n, n * trust))
            return merged(parts)

        total, held, size = None, [], 0
        for d in batches:
            for text, trust in zip(d["text"], d["trusted"]):
                held.append((grams(text), int(trust)))
                size += len(held[-1][0])
                if size > CHUNK:
                    total = merged([total, counted(held)]) if total else counted(held)
                    held, size = [], 0
                    if len(total[0]) > CHUNK:
                        yield frame(total)
                        total = None
        if held:
            total = merged([total, counted(held)]) if total else counted(held)
        if total:
            yield frame(total)

    def frame(t):
        return pd.DataFrame({"gram": t[0].view(np.int64), "n": t[1].astype(np.int64), "trusted": t[2].astype(np.int64)})

    found = docs.mapInPandas(rows, "gram bigint, n bigint, trusted bigint")
    return found.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("trusted").alias("trusted"))


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    r = counts.agg(*(F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
    n1, n2, n3, n4 = (max(1, r[f"n{k}"]) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def probabilities(counts: DataFrame) -> DataFrame:
    """gram, logp: interpolated probability of the last unit after the other three."""
    level = {4: counts.where("trusted > 0").select("gram", F.col("trusted").alias("n"))}
    for order in (3, 2, 1):  # how many different units stand before
        level[order] = staged(
            level[order + 1].groupBy((F.col("gram").bitwiseAND(F.lit(LOW[order]))).alias("gram")).agg(F.count("*").alias("n")), "level"
        )
    units = level[1].agg(F.count("*").alias("units"), F.sum("n").alias("total")).first()
    out = counts.select("gram")
    p: Column = F.lit(1.0 / (units["units"] + 1))
    for order in (1, 2, 3, 4):
        d = discounts(level[order])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        seen = level[order].select(F.col("gram").alias(f"g{order}"), (F.col("n") - cut).alias(f"c{order}"))
        context = level[order].groupBy(F.shiftrightunsigned("gram", 16).alias(f"h{order}")).agg(
            F.sum("n").alias(f"t{order}"), F.sum(cut).alias(f"w{order}")
        )
        own = F.col("gram").bitwiseAND(F.lit(LOW[order]))
        out = out.withColumn(f"g{order}", own).withColumn(f"h{order}", F.shiftrightunsigned(own, 16))
        out = staged(out.join(seen, f"g{order}", "left").join(staged(context, "context"), f"h{order}", "left").drop(f"g{order}", f"h{order}"), "joined")
        interpolated = (F.coalesce(f"c{order}", F.lit(0.0)) + F.col(f"w{order}") * p) / F.col(f"t{order}")
        p = F.when(F.col(f"t{order}").isNull(), p).otherwise(interpolated)
        out = out.select("gram", *([F.col("p")] if order > 1 else []), f"c{order}", f"t{order}", f"w{order}")
        out = out.select("gram", p.alias("p"))
        p = F.col("p")
    return out.select("gram", F.log("p").alias("logp"))


def partial_sums(docs: DataFrame, shard: pd.DataFrame) -> DataFrame:
    """doc_id, lang, trusted, digest, units, logp over the grams of one shard."""
    shared = docs.sparkSession.sparkContext.broadcast((shard["gram"].to_numpy(), shard["logp"].to_numpy()))

    def rows(batches):
        index, logp = pd.Index(shared.value[0]), np.r_[shared.value[1], 0.0]
        for d in batches:
            units, sums = [], []
            for text in d["text"]:
                g = grams(text)
                units.append(len(g))
                sums.append(float(logp[index.get_indexer(g.view(np.int64))].sum()))  # -1, a gram of another shard, adds 0
            yield d.drop(columns="text").assign(units=units, logp=sums)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.drop("text").schema)
    out = staged(docs.mapInPandas(rows, f"{fields}, units bigint, logp double"), "sums")
    shared.destroy()  # only one shard is held at a time
    return out


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, trusted, units, perplexity."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = staged(good.withColumn("trusted", F.lit(1)), "trusted")
    source = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), whole_text().alias("text"))
    source = source.join(checked(good), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(0)))
    source = source.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    counts = staged(gram_counts(source.select("text", "trusted")), "grams")
    if counts.where("trusted > 0").isEmpty():
        table = counts.select("gram", F.lit(0.0).alias("logp"))
    else:
        table = probabilities(counts)
    table = staged(table, "logp")
    shards = max(1, -(-table.count() * 16 // SHARD_BYTES))
    parts = [partial_sums(source, table.where(F.pmod(F.xxhash64("gram"), F.lit(shards)) == s).toPandas()) for s in range(shards)]
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionByName(x)
    # only rows with equal texts share a key and their sums are equal: it holds every shard as often as its row repeats
    sums = whole.groupBy("doc_id", "lang", "trusted", "digest", "units").agg(
        (F.sum("logp") * shards / F.count("*")).alias("logp"), (F.count("*") / shards).cast("int").alias("times")
    )
    sums = sums.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("digest", "times", "again")
    return staged(sums.withColumn("perplexity", F.exp(-F.col("logp") / F.col("units"))).drop("logp"), "scored")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, units, perplexity, threshold, kept."""
    rows = scored(docs, labels)
    known = rows.where("trusted = 1")
    cut = F.percentile_approx("perplexity", QUANTILE, 10000)
    overall = known.agg((cut * SLACK).alias("overall")).first()["overall"]
    by_lang = known.groupBy("lang").agg((cut * SLACK).alias("own"), F.count("*").alias("n")).where(F.col("n") >= LEAST)
    threshold = F.coalesce("own", F.lit(float("inf") if overall is None else overall))
    names = by_lang.select(F.col("lang").alias("name"), "own")
    out = rows.join(staged(names, "cuts"), F.col("lang").eqNullSafe(F.col("name")), "left")
    return out.select("doc_id", "lang", "units", "perplexity", threshold.alias("threshold"), (F.col("perplexity") <= threshold).alias("kept"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
