"""Personal data by bootstrapped contextual extraction (operator 3, DataFrame functions only).

Base spans (email, ip, card, phone) come from the patterns below: all matches
of a pattern are cut out of the whole text and their places follow from the
lengths of what lies between; matches that fail their check are dropped.

The base spans seed the method. A lexical pattern is a kind with the word
before or after an instance (lower case). Candidates are identifier-like runs
of digits and addresses in disguise that no base span touches, with the same
two words (looked for among the ``CONTEXT`` characters beside it). Patterns and instances form a graph, scored in ``ROUNDS``: a
pattern is worth the mean score of its distinct instances if at least
``SUPPORT`` distinct known ones carry it (candidates count against it until
they score), an instance what its best pattern on either side is worth; known
instances score 1. Candidates that reach ``CONFIDENT`` on their best kind
become spans wherever they stand, and known instances of that kind from the
next round on, so they can induce patterns of their own.

Graph edges are aggregated per pattern and instance before they are joined,
so a frequent word is no hot task. Edge cases: null and empty texts have no
spans; long runs of digits or dots can't exhaust the matcher's stack
(possessive groups over single classes); equal rows are scanned each; an
empty table gives no rows. Counts per kind are of base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import read, staged, whole_text

KINDS = ["email", "ip", "card", "phone"]
#: Each matches what its definition matches; possessive groups only where that changes nothing.
PATTERNS = {
    # starts where a run does or the match before ended, so that a long run is tried once
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9]+(?:[ -][0-9]+)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried: a plain piece, or a cheaper pattern.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){13}",
    "phone": "+",
    "": r"[0-9][0-9() .-]{5}|[\[(]at[\])]",
}
CANDIDATE = r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9.-]+[A-Za-z0-9]|[(]?[0-9][0-9() .-]{5,}[0-9]"
ROUNDS, SUPPORT, CONFIDENT = 3, 5, 0.8
CONTEXT = 60


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn."""
    from_right = F.split(F.reverse(number), "")

    def weigh(d: Column, i: Column) -> Column:
        twice = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.filter(from_right, lambda d: d != ""), weigh), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def may_be(kind: str, found: Column) -> Column:
    """The cheap part of the check of a match."""
    if kind == "card":
        return F.length(found).between(14, 40) & F.length(digits(found)).between(14, 19)
    if kind == "phone":
        return F.length(digits(found)).between(10, 15)
    if kind == "ip":
        plain = lambda p: F.regexp_replace(p, "^0+(?=.)", "")  # noqa: E731  leading zeros don't count
        return F.forall(F.split(found, r"\."), lambda p: (F.length(plain(p)) <= 3) & (F.lpad(plain(p), 3, "0") <= "255"))
    return F.lit(True)


def spans_of(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """Array of (start, rank, end, kind, found) of the matches that pass, places in code points from 0."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,found:string>>)").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["found"].alias("found"))
        good = x["found"].isNotNull() & may_be(kind, x["found"])
        return F.struct(end.alias("at"), F.when(good, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    found = F.aggregate(pieces, start, step, lambda s: s["spans"])
    found = F.filter(found, lambda s: luhn(digits(s["found"]))) if kind == "card" else found
    may = text.contains(NEEDS[kind]) if len(NEEDS[kind]) == 1 else text.rlike(NEEDS[kind])
    return F.when(may, found).otherwise(start["spans"])


def context(text: Column, span: Column, side: str) -> Column:
    """The word beside a span, in lower case; empty at the ends of the text."""
    if side == "before":
        first = F.greatest(span["start"] - CONTEXT, F.lit(0))
        return F.lower(F.regexp_extract(F.substring(text, first + 1, span["start"] - first), r"(\S+)\s*$", 1))
    return F.lower(F.regexp_extract(F.substring(text, span["end"] + 1, F.lit(CONTEXT)), r"^\s*(\S+)", 1))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (spans by start, then kind), others (candidates); both with their context."""
    text = F.col("text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole_text().alias("text"))
    base = F.array_sort(F.concat(*(spans_of(text, PATTERNS[k], k, i) for i, k in enumerate(KINDS))))
    rows = rows.withColumn("base", base).withColumn("others", spans_of(text, CANDIDATE, "", len(KINDS)))

    def with_words(s: Column) -> Column:
        return F.struct(*(s[f].alias(f) for f in ("start", "rank", "end", "kind", "found")), context(text, s, "before").alias("before"), context(text, s, "after").alias("after"))

    clear = F.filter("others", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return staged(rows.select("row", "doc_id", F.transform("base", with_words).alias("base"), F.transform(clear, with_words).alias("others")), "scanned")


def discovered(rows: DataFrame) -> DataFrame:
    """Spans that the bootstrapping adds: row, start, end, kind."""

    def sides(column: str) -> DataFrame:
        s = rows.select("row", F.explode(column).alias("s")).select("row", "s.start", "s.end", "s.kind", F.lower("s.found").alias("instance"), "s.before", "s.after")
        both = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")), F.struct(F.lit("after").alias("side"), F.col("after").alias("word"))))
        return s.withColumn("c", both).select("row", "start", "end", "kind", "instance", "c.side", "c.word")

    edge = ["side", "word", "instance"]
    seeds = sides("base").where("word <> ''").groupBy("kind", *edge).agg(F.count("*").alias("n")).drop("n")
    places = staged(sides("others").drop("kind"), "places")
    loose = staged(places.where("word <> ''").groupBy(*edge).agg(F.count("*").alias("n")).drop("n"), "candidates")
    sure = F.count("*").cast("double")
    seeds = staged(seeds.groupBy("kind", "side", "word").agg(sure.alias("sure"), sure.alias("base"), F.lit(0.0).alias("won")), "seeds")
    held = staged(loose.groupBy("side", "word").agg(F.count("*").alias("loose")), "held")
    known = None  # candidates by kind: score, and whether they joined the seeds (these have one kind, and score 1)
    for _ in range(ROUNDS):
        patterns = seeds
        if known is not None:
            gained = loose.join(known, "instance").groupBy("kind", "side", "word").agg(
                F.sum(F.col("seed").cast("double")).alias("sure"), F.lit(0.0).alias("base"), F.sum(F.when(F.col("seed"), 0.0).otherwise(F.col("score"))).alias("won")
            )
            patterns = seeds.unionByName(gained).groupBy("kind", "side", "word").agg(*(F.sum(c).alias(c) for c in ("sure", "base", "won")))
        # pattern scores: distinct known instances count 1 each, other candidates what they scored so far
        worth = (F.col("sure") + F.col("won")) / (F.col("base") + F.col("loose"))
        patterns = patterns.where(F.col("sure") >= SUPPORT).join(held, ["side", "word"])
        patterns = staged(patterns.select("kind", "side", "word", worth.alias("worth")), "patterns")
        # instance scores: the best pattern on either side; a side that says nothing doesn't count against it
        each = loose.join(patterns, ["side", "word"]).groupBy("instance", "kind").agg(F.max("worth").alias("score"))
        before = None if known is None else known.where("seed")
        each = staged(each if before is None else each.join(before.select("instance"), "instance", "left_anti"), "scores")
        best = each.where(F.col("score") >= CONFIDENT).groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        best = staged(best.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(True)), "new")
        rest = each.join(best.select("instance"), "instance", "left_anti").withColumn("seed", F.lit(False))
        now = best.unionByName(rest)
        known = staged(now if before is None else now.unionByName(before), "instances")
    top = known.where("seed").select("instance", "kind")
    return places.select("row", "start", "end", "instance").distinct().join(staged(top, "found"), "instance").select("row", "start", "end", "kind")


def extracted(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base (spans), spans (base and discovered), by start and kind."""
    rows = scanned(docs)
    rank = F.coalesce(*(F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)))
    more = discovered(rows).groupBy("row").agg(F.collect_set(F.struct("start", rank.alias("rank"), "end", "kind")).alias("more"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    rows = rows.select("row", "doc_id", plain.alias("base")).join(staged(more, "more"), "row", "left")
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extracted(read(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("base.kind"), lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
