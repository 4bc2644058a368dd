"""Spelling variants by a bit-sliced position index (operator 11).

The index of a part of the vocabulary is one bitset over its words for each
(position, letter). A query word walks its letters once, and every step moves
four bitsets over all indexed words together: those equal so far, and those one
error away by a replaced letter, a missing letter (the word's positions lag
by one) and an added letter (they lead by one):

    zero'    = zero & at(i, c)
    replaced = replaced & at(i, c) | zero & not at(i, c)
    missing  = missing & at(i - 1, c) | zero
    added    = (added | zero) & at(i + 1, c)

All queries of one length move together as rows of a bit matrix.

Parts: two words one error apart, the shorter of length L, agree on all but a
segment of the L places. Keys start with the halves: the places before (or after)
the middle are equal, so words of length L and L + 1 meet under (L, segment,
letters outside it). A key with more than ``CROWD`` words is split: its segment
is halved and its words move to the two finer keys, one of which every
near pair still shares. A segment of one place ends this: at most the alphabet
and its square differ there. So each part is bounded whatever the vocabulary
looks like, nothing is capped, and rows grow by a factor of two a level only
where words crowd. Tasks read the parts sorted by key and index neighbouring parts
together, ``TOGETHER`` words at a time.

Words: runs of the letters are counted natively with partial aggregation.
Forms point to a near word at least ``RATIO`` times as frequent, so a chain
is at most log(n) long and acyclic; roots come from pointer doubling.

Edge cases: a null text holds no words; a null ``doc_id`` is written as an empty string in the
hash that deletes letters; repeated rows count again; very long runs are words like any
other; ties go to the smallest form in code-point order; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import read, staged, whole_text

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, SELDOM, RATIO = 7, 2, 10
CROWD, TOGETHER = 4096, 512


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(text, upper, upper.lower())


def damaged(run: Column, doc_id: Column, every: int = 31) -> Column:
    """``run`` without one letter where the crc32 of ``<doc_id>:<run>`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, seldom: int = SELDOM, every: int = 31) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` letters that occur ``seldom`` times or more."""
    runs = F.regexp_extract_all(whole_text(), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    each = docs.select(F.col("doc_id").alias("doc"), F.explode(runs).alias("run"))
    word = damaged(lower_ascii(F.col("run")), F.col("doc"), every)
    counts = each.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= seldom)


class PositionIndex:
    """Bitsets of a part's words: one for each (position, letter) that occurs, one for each length."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.width = -(-self.size // 64)
        self.length = np.fromiter(map(len, words), np.int64, self.size)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.letters, letter = np.unique(code, return_inverse=True)
        first = np.cumsum(self.length) - self.length
        place = np.arange(len(code)) - np.repeat(first, self.length)
        owner = np.repeat(np.arange(self.size), self.length)
        rows, row = np.unique(place * len(self.letters) + letter, return_inverse=True)
        self.first = first
        #: row of each (position, letter), the last row (no word) where it doesn't occur
        self.at = np.full((self.length.max(initial=0) + 2) * len(self.letters), len(rows))
        self.at[rows] = np.arange(len(rows))
        self.letter = letter
        self.bits = np.zeros((len(rows) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.bits, (row, owner // 64), np.uint64(1) << (owner % 64).astype(np.uint64))
        self.by_length = {}
        for n in np.unique(self.length):
            of = np.flatnonzero(self.length == n)
            self.by_length[int(n)] = self.pack(of)

    def pack(self, members: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(out, members // 64, np.uint64(1) << (members % 64).astype(np.uint64))
        return out

    def near(self, queries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for the indexed words exactly one error from the ``queries``, words of one ``length``."""
        shape, alphabet = (len(queries), self.width), len(self.letters)
        zero = np.full(shape, ~np.uint64(0))
        replaced, missing, added = (np.zeros(shape, np.uint64) for _ in range(3))
        for i in range(length):
            letter = self.letter[self.first[queries] + i]
            here = self.bits[self.at[i * alphabet + letter]]
            lag = self.bits[self.at[(i - 1) * alphabet + letter]] if i else np.zeros(shape, np.uint64)
            lead = self.bits[self.at[(i + 1) * alphabet + letter]]
            added = (added | zero) & lead
            missing = (missing & lag) | zero
            replaced = (replaced & here) | (zero & ~here)
            zero = zero & here
        none = np.zeros(self.width, np.uint64)
        found = replaced & self.by_length[length]
        found |= missing & self.by_length.get(length - 1, none)
        found |= (added | zero) & self.by_length.get(length + 1, none)
        q, w = np.nonzero(found)
        bits = np.unpackbits(found[q, w].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(bits)
        return queries[q[k]], w[k] * 64 + bit

    def pairs(self, queries_at_once: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
        """All (word, near word) of the part, in both directions."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        step = max(1, queries_at_once // (8 * self.width))
        for length in self.by_length:
            queries = np.flatnonzero(self.length == length)
            for lo in range(0, len(queries), step):
                out.append(self.near(queries[lo : lo + step], length))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def segments(words: DataFrame) -> DataFrame:
    """Every word under its two halves for L = its length, and for L = its length - 1 as the longer one."""
    size = F.length("word")
    shorter = F.explode(F.array(size, size - 1)).alias("short")
    both = words.select("word", "n", shorter).where("short > 0")
    half = F.floor(F.col("short") / 2).cast("int")
    parts = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("short").alias("hi")))
    return both.select("word", "n", "short", F.inline(parts)).where("lo < hi")


def keyed(members: DataFrame) -> DataFrame:
    """With the hash of (L, segment, letters outside it); equal hashes of others only add words to a part."""
    outside = F.concat(
        F.substring("word", F.lit(1), F.col("lo")),
        F.lit(" "),
        F.substring(F.col("word"), F.length("word") - F.col("short") + F.col("hi") + 1, F.length("word")),
    )
    return members.withColumn("key", F.xxhash64("short", "lo", "hi", outside))


def parts(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(key, word, n): parts of at most ``crowd`` words, or of a single open place; near words share one."""
    members, done = staged(keyed(segments(words)), "segments"), []
    while True:
        big = members.groupBy("key").agg(F.count("*").alias("m"), F.max(F.col("hi") - F.col("lo")).alias("open"))
        big = staged(big.where((F.col("m") > crowd) & (F.col("open") > 1)).select("key"), "crowds")
        if big.isEmpty():
            done.append(members.select("key", "word", "n"))
            break
        done.append(members.join(big, "key", "left_anti").select("key", "word", "n"))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(
            F.struct(F.col("lo").alias("lo"), F.when(F.col("hi") - F.col("lo") > 1, middle).otherwise(F.col("hi")).alias("hi")),
            F.struct(F.when(F.col("hi") - F.col("lo") > 1, middle).alias("lo"), F.col("hi").alias("hi")),
        )
        finer = members.join(big, "key", "left_semi").select("word", "n", "short", F.inline(halves)).where("lo IS NOT NULL")
        members = staged(keyed(finer), "segments")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def near_words(words: DataFrame, crowd: int = CROWD, together: int = TOGETHER) -> DataFrame:
    """(word, n, near, near_n) for the words exactly one inserted, deleted or replaced letter apart."""

    def chunks(batches):
        """(word, n) of whole parts, neighbouring ones together, about ``together`` words; a lone word has no near one."""
        rest = (np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64))
        for batch in chain(batches, [None]):
            if batch is not None:
                rest = tuple(np.concatenate([r, batch.column(c).to_numpy(zero_copy_only=False)]) for r, c in zip(rest, ("key", "word", "n")))
            key = rest[0]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            whole = len(key) if batch is None else (new[-1] if len(new) else 0)
            size = np.diff(np.r_[new[new < whole], whole])
            kept = np.flatnonzero(np.repeat(size > 1, size))
            size = size[size > 1]
            chunk = np.repeat((np.cumsum(size) - size) // together, size)
            for part in np.split(kept, np.flatnonzero(np.diff(chunk)) + 1) if len(kept) else ():
                yield rest[1][part], rest[2][part]
            rest = tuple(r[whole:] for r in rest)

    def find(batches):
        for word, n in chunks(batches):
            word, once = np.unique(word, return_index=True)
            n = n[once]
            a, b = PositionIndex(word.tolist()).pairs()
            columns = [pa.array(word[a], pa.string()), pa.array(n[a]), pa.array(word[b], pa.string()), pa.array(n[b])]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "near", "near_n"])

    dealt = parts(words, crowd).repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(find, "word string, n bigint, near string, near_n bigint")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of ``forms`` (word, form), by pointer doubling."""
    links = staged(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("end"))
        joined = links.join(further, "root", "left")
        jumped = staged(joined.select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "links")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        links = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, crowd: int = CROWD, together: int = TOGETHER) -> DataFrame:
    """Per word of ``words`` (word, n): word, form, root, n, n_near, form_n."""
    words = staged(words.select("word", "n"), "vocabulary")
    near = near_words(words, crowd, together)
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("first")
    best = near.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), first)
    often = -F.col("first.less") >= ratio * F.col("n")
    best = staged(
        best.select("word", "n_near", F.when(often, F.col("first.form")).alias("form"), F.when(often, -F.col("first.less")).alias("form_n")),
        "forms",
    )
    ends = roots(best.where("form IS NOT NULL"))
    return (
        words.join(best, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(read(spark, sf_dir, "documents")))
