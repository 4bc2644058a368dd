"""Benchmark decontamination by greedy string tiling (operator 4).

Words are lower-cased runs of word characters, so case, punctuation and line
breaks don't hide a passage. A pair of a document and a benchmark item is
tiled: again and again the longest unmarked common run of at least ``TILE``
words, found by Karp-Rabin hashes of windows and a binary search on the
length, is marked in both. The tiled share of the item is its coverage,
whatever the order of the passages. ``COVERAGE`` or more makes the document
contaminated.

Seeds are runs of ``TILE`` words. A tile of n words holds n - TILE + 1 of the
item's seeds, and tiles have TILE words at least, so tiles that cover c words
hold c / TILE seeds at least: a pair that shares fewer than
``coverage * words / TILE`` seeds (counted by their places in the item) can't
reach the coverage, and every other pair is tiled. Seeds that more than
``OFTEN`` items hold (phrases of the benchmark's style) are left out of the
join as far as those needed allow, and the number needed falls by as many.

A bit map of the seeds, of ``BITS`` per seed and ``2**MAP_BITS`` bits at most,
drops documents that can't match before anything is shuffled; it only ever
lets too much through, and the join on the seeds is exact for a benchmark of
any size. The texts of pairs that share enough seeds are read again, so no
words of other documents are written.

Edge cases: null and empty texts match nothing; items under ``TILE`` words
match nothing; rows that share a ``doc_id`` count as one document
(contaminated if any of them is); repeated items are reported by each id; an
empty benchmark leaves every document clean. Only ``doc_id``, ``text`` and
``item_id`` are read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import WordHashes, checked, read, shingle_hashes, staged, whole_text

TILE, COVERAGE, OFTEN = 3, 0.8, 16
BITS, MAP_BITS = 128, 27
WORD = re.compile(r"\w+")
POWER = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))


def word_hashes(text: str, seen: WordHashes) -> np.ndarray:
    return seen.of([w.encode("utf-8", "replace") for w in WORD.findall(text.lower())])


class Rolling:
    """Karp-Rabin: the hash of any window of a word sequence from prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words, self.free = words, np.ones(n, bool)
        self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n, INVERSE, np.uint64)])
        powers = np.cumprod(np.r_[np.uint64(1), np.full(n, POWER, np.uint64)])[:n]
        self.sums = np.r_[np.uint64(0), np.cumsum(words * powers, dtype=np.uint64)]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of every window of ``size`` unmarked words."""
        n = len(self.words) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        used = np.r_[0, np.cumsum(~self.free)]
        at = np.flatnonzero(used[size:] == used[:n])
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at], at


def common_window(a: Rolling, b: Rolling, size: int) -> tuple[int, int] | None:
    """First places of an unmarked run of ``size`` words that both have."""
    x, at = a.windows(size)
    y, bt = b.windows(size)
    hits = np.flatnonzero(np.isin(x, y))
    for i in hits[:1]:
        j = bt[np.flatnonzero(y == x[i])[0]]
        if np.array_equal(a.words[at[i] : at[i] + size], b.words[j : j + size]):
            return int(at[i]), int(j)
    return None


def greedy_tiles(document: np.ndarray, item: np.ndarray, least: int = TILE) -> list[tuple[int, int, int]]:
    """Tiles (start in document, start in item, words), longest first."""
    a, b = Rolling(document), Rolling(item)
    tiles, most = [], min(len(document), len(item))
    while True:
        low, high, best = least, most, None
        while low <= high:  # a common run of n words holds common runs of every shorter length
            size = (low + high) // 2
            if found := common_window(a, b, size):
                best, low = (*found, size), size + 1
            else:
                high = size - 1
        if best is None:
            return tiles
        i, j, most = best
        a.free[i : i + most] = b.free[j : j + most] = False
        tiles.append(best)


def seeds_needed(words: int, coverage: float) -> int:
    """Places of seeds that a document must share to cover so much of an item of so many words."""
    return max(1, int(np.ceil(coverage * words / TILE - 1e-9)))


def hashed(benchmark: DataFrame, coverage: float) -> DataFrame:
    """item, item_id, words (hashes), seeds and places (how often each stands), needed (places), fewest (distinct seeds that give them)."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def rows(batches):
        seen = WordHashes()
        for d in batches:
            out = []
            for i, item_id, t in zip(d["item"], d["item_id"], d["text"]):
                w = word_hashes(t, seen)
                if len(w) >= TILE:
                    s, n = np.unique(shingle_hashes(w, TILE), return_counts=True)
                    needed = seeds_needed(len(w), coverage)
                    fewest = int(np.searchsorted(np.cumsum(-np.sort(-n)), needed)) + 1
                    out.append((i, item_id, w.view(np.int64), s.view(np.int64), n, needed, fewest))
            p = pd.DataFrame(out, columns=["item", "item_id", "words", "seeds", "places", "needed", "fewest"])
            yield p.astype({"item_id": d["item_id"].dtype})

    source = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", whole_text().alias("text")).where("item_id is not null")
    lists = "words array<bigint>, seeds array<bigint>, places array<bigint>"
    return source.mapInPandas(rows, f"item bigint, item_id {kind}, {lists}, needed bigint, fewest bigint")


def joined_seeds(items: DataFrame) -> DataFrame:
    """item, seed, places, needed: the seeds that are joined, and how many places of them a pair must share."""
    each = items.select("item", "needed", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select("item", "needed", F.col("s.seeds").alias("seed"), F.col("s.places").alias("places"))
    held = each.groupBy("seed").agg(F.count("*").alias("n_items"))
    # a window holds one item's seeds; its most frequent ones come first
    so_far = F.sum("places").over(Window.partitionBy("item").orderBy(F.desc("n_items"), "seed").rowsBetween(Window.unboundedPreceding, 0))
    out = (F.col("n_items") > OFTEN) & (so_far < F.col("needed"))
    each = each.join(held, "seed").withColumn("out", out)
    given_up = F.sum(F.when(F.col("out"), F.col("places")).otherwise(0)).over(Window.partitionBy("item"))
    return each.withColumn("needed", F.col("needed") - given_up).where("NOT out").select("item", "seed", "places", "needed")


def seed_map(seeds: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Bit map with two bits per seed; at most ``2**MAP_BITS`` bits come to the driver, packed by 64."""
    bits = min(MAP_BITS, max(10, int(n * BITS).bit_length()))
    places = F.explode(F.array(F.shiftrightunsigned("seed", 64 - bits), F.col("seed").bitwiseAND((1 << bits) - 1)))
    packed = (
        seeds.select(places.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value"))
    )
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    for r in packed.toLocalIterator():
        out[r["at"]] = r["value"]
    return out.view(np.uint64), bits


def candidates(docs: DataFrame, bit_map: np.ndarray, bits: int, fewest: int) -> DataFrame:
    """Documents with ``fewest`` word runs that may be seeds: doc_id, seeds (those that pass the map); staged."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map)  # at most 2**MAP_BITS bits
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        table, seen = shared.value, WordHashes()

        def is_set(place):
            word = table[(place >> np.uint64(6)).astype(np.int64)]
            return (word >> (place & np.uint64(63))) & np.uint64(1) == 1

        for d in batches:
            ids, seeds = [], []
            for i, t in zip(d["doc_id"], d["text"]):
                w = word_hashes(t, seen)
                if len(w) < TILE:
                    continue
                s = shingle_hashes(w, TILE)
                s = s[is_set(s >> np.uint64(64 - bits))]
                s = np.unique(s[is_set(s & np.uint64((1 << bits) - 1))])
                if len(s) >= fewest:
                    ids.append(i)
                    seeds.append(s.view(np.int64))
            # a batch without a hit has an empty column, which needs its type said
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=d["doc_id"].dtype), "seeds": pd.Series(seeds, dtype=object)})

    source = docs.select("doc_id", whole_text().alias("text")).where("doc_id is not null")
    found = staged(source.mapInPandas(rows, f"doc_id {kind}, seeds array<bigint>"), "candidates")
    shared.destroy()
    return found


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """All pairs that may reach the coverage: doc_id, item_id, tiles, covered, item_words, coverage."""
    items = staged(hashed(benchmark, coverage), "items")
    every = items.select(F.explode("seeds").alias("seed"))
    bit_map, bits = seed_map(every, every.count())
    fewest = items.agg(F.min("fewest")).first()[0] or 1
    found = candidates(docs, bit_map, bits, fewest).select("doc_id", F.explode("seeds").alias("seed"))
    shared = found.join(staged(joined_seeds(items), "seeds"), "seed").groupBy("doc_id", "item")
    pairs = shared.agg(F.sum("places").alias("n"), F.max("needed").alias("needed")).where("n >= needed")
    pairs = checked(staged(pairs.select("doc_id", "item"), "pairs"))
    both = docs.select("doc_id", whole_text().alias("text")).join(pairs, "doc_id").join(items.select("item", "item_id", "words"), "item")
    d, i = (f.schema[c].dataType.simpleString() for f, c in ((docs, "doc_id"), (benchmark, "item_id")))

    def rows(batches):
        seen = WordHashes()
        for b in batches:
            tiles = [greedy_tiles(word_hashes(x, seen), np.asarray(y, np.int64).view(np.uint64)) for x, y in zip(b["text"], b["words"])]
            out = pd.DataFrame({"doc_id": b["doc_id"], "item_id": b["item_id"], "tiles": [len(t) for t in tiles]})
            out["covered"] = [sum(n for *_, n in t) for t in tiles]
            out["item_words"] = [len(y) for y in b["words"]]
            out["coverage"] = out["covered"] / out["item_words"]
            yield out

    return both.select("doc_id", "item_id", "text", "words").mapInPandas(
        rows, f"doc_id {d}, item_id {i}, tiles bigint, covered bigint, item_words bigint, coverage double"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Contaminated documents: doc_id, n_items, coverage (highest), tiles, item_ids (sorted)."""
    pairs = tiled_pairs(docs, benchmark, coverage).where(F.col("coverage") >= coverage)
    return staged(
        pairs.groupBy("doc_id").agg(
            F.countDistinct("item_id").alias("n_items"),
            F.max("coverage").alias("coverage"),
            F.max("tiles").alias("tiles"),
            F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        ),
        "contaminated",
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = contaminated(docs, read(spark, sf_dir, "benchmark"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("tiles", F.lit(0)).alias("tiles"),
        "item_ids",
    )
