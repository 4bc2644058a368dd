"""N-gram Jaccard join with token-combination prefixes (operator 1).

A document is the set of its word shingles. Two link when
``100 * |intersection| >= percent * |union|``.

1. Documents with equal sets are one node (digest of the sorted shingles).
2. Shingles are ordered by estimated document frequency, rare ones first; the
   estimate is a table of ``2**COUNTER_BITS`` counters. It decides
   order and class alone, so its error costs time and never a link.
3. A set of n shingles may lose t = n - ceil(percent * n / 100) of them and
   still link. Shingles of the rare class are signatures alone; those of
   frequent class c count only in combinations of c (see ``classes``). The frequent ones are
   dealt into groups by hash, and the prefix is extended until
   sum(max(0, shingles of the group - (c - 1))) reaches t + 1: whichever t
   shingles the other set lacks, one group keeps c of them, so every linking
   pair shares a signature. The number of groups follows the size class
   (power of two) and is as large as the sum allows, which keeps the
   combinations near a small multiple of t; a set that can link to the class
   below signs there too.
   Sets under ``SINGLE`` shingles use single shingles only.
4. Each signature links its holders to its smallest one; these pairs, if the
   sizes and the parity bitmaps allow a link, are verified on the whole sets.
   A bitmap holds, per remainder of the shingles, whether an odd number has
   it: the bits in which two bitmaps differ are at most the shingles in which
   the sets differ, so what they rule out is no link. Then the
   holders of a signature that are still in different components meet
   too: as pairs where a signature has few, in blocks of bounded size where
   it has many. No link between components is lost.
5. Components by alternating large and small stars, in staged tables.

Shingles are 64-bit hashes. Edge cases: null, empty and all-blank texts have
no shingles and no links (the component is the own id); fewer words than a
shingle make one; rows that share a ``doc_id`` are one document with the
links of all of them; a null ``doc_id`` has no links and a null component;
an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import ByteWords, checked, distinct, groups_of, mixed, pieces, read, shingle_hashes, staged, whole_text

COUNTER_BITS, BLOCK = 20, 1024
SINGLE = 16
#: Signatures with more holders than ``CROWD_FROM`` are verified in blocks of ``CROWD``.
CROWD_FROM, CROWD = 16, 256


def shingles(text: str, k: int, words: ByteWords) -> np.ndarray:
    """Sorted distinct shingles; bytes.lower() knows ASCII only, as the words are defined."""
    return distinct(shingle_hashes(words.of(text.encode("utf-8", "replace").lower()), k))


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """Documents per counter, summed in blocks; only ``2**COUNTER_BITS`` numbers come to the driver."""

    def count(batches):
        import zlib

        table, split = np.zeros(1 << COUNTER_BITS, np.int64), ByteWords()
        held, size = [], 0

        def add_held():
            at = np.concatenate([np.zeros(0, np.uint64), *held]) >> np.uint64(64 - COUNTER_BITS)
            table[:] += np.bincount(at.astype(np.int64), minlength=1 << COUNTER_BITS)

        for d in batches:
            for t in d["text"]:
                held.append(shingles(t, words, split))
                size += len(held[-1])
                if size > 1 << 21:
                    add_held()
                    held, size = [], 0
        add_held()
        parts = table.reshape(-1, BLOCK)
        at = np.flatnonzero(parts.any(1))
        yield pd.DataFrame({"block": at, "counts": pd.Series([zlib.compress(parts[i].astype("<u4").tobytes(), 1) for i in at], dtype=object)})

    def add(batches):
        import zlib

        block, total = None, None
        for d in batches:
            out = []
            for b, c in zip(d["block"], d["counts"]):
                if b != block:
                    if block is not None:
                        out.append((block, total.astype("<u8").tobytes()))
                    block, total = b, np.zeros(BLOCK, np.uint64)
                total += np.frombuffer(zlib.decompress(c), "<u4")
            yield pd.DataFrame(out, columns=["block", "counts"])
        if block is not None:
            yield pd.DataFrame([(block, total.astype("<u8").tobytes())], columns=["block", "counts"])

    schema = "block int, counts binary"
    sums = docs.select(whole_text().alias("text")).mapInPandas(count, schema).repartition("block").sortWithinPartitions("block").mapInPandas(add, schema)
    table = np.zeros((1 << COUNTER_BITS) // BLOCK * BLOCK, np.uint64).reshape(-1, BLOCK)
    for r in sums.collect():
        table[r["block"]] += np.frombuffer(r["counts"], "<u8")
    return table.reshape(-1)


def classes(table: np.ndarray) -> list[float]:
    """Estimated frequencies from which shingles count in combinations: of two, of three, and so on.

    Only pairs are used. By calculation they cost about 1.3 rows for each shingle
    that a set may lose, threes 2.4 to 3.3, and frequent shingles of texts stand together
    (copies, boilerplate), so that threes have as many holders as pairs.
    """
    return [64 + 8 * float(table.mean())]


def least_shared(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parities(s: np.ndarray) -> bytes:
    """Parity bitmap of a set: a bit per remainder by a power of two of at least its size."""
    size = max(64, 1 << max(len(s) - 1, 0).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_apart(x: bytes, y: bytes) -> int:
    """At most the size of the symmetric difference of two sets with these bitmaps; the longer one is folded."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), 0) ^ y).sum())


def group_counts(size_class: int, percent: int, kinds: int) -> np.ndarray:
    """Groups of kind 2 (pairs), 3, ... of a size class; kinds 0 and 1 stand for none.

    A group of kind c gives up c - 1 shingles at most, so all groups together
    must leave t + 1 of the smallest set of the class. As many groups as that
    allows are used: small groups have few combinations.
    """
    room, out = least_shared(1 << size_class, percent) - 1, [1, 1]
    for c in range(2, kinds + 1):
        left = sum(range(c, kinds))  # a group for each later kind
        out.append(max(1, (room - left) // (c - 1) if c == kinds else (room - left) * 4 // (10 * (c - 1))))
        room -= (c - 1) * out[-1]
    return np.array(out if room >= 0 else [0, 0], np.uint64)


def signatures(s: np.ndarray, often: np.ndarray, percent: int, cuts: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set from rare shingles and from frequent ones: ``s`` its shingles, ``often`` their estimates."""
    n = len(s)
    if n == 0:
        return s, s
    order = np.argsort(often, kind="stable")  # s is sorted, so ties go by shingle
    s, kind = s[order], 1 + np.searchsorted(np.array(cuts), often[order], side="right")
    lose, size_class, rare, common = n - least_shared(n, percent), n.bit_length() - 1, [s[:0]], [s[:0]]
    low = [size_class - 1] if least_shared(n, percent) < 1 << size_class else []
    for c in [size_class, *low]:
        tag = np.uint64((c + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
        counts = group_counts(c, percent, len(cuts) + 1)
        if 1 << c < SINGLE or not counts[0] or kind[min(lose, n - 1)] == 1:
            head, head_kind = mixed(s[: lose + 1] ^ tag), kind[: lose + 1]
            rare.append(head[head_kind == 1])
            common.append(head[head_kind > 1])
            continue
        groups = counts[kind]
        group = np.where(kind > 1, (s >> np.uint64(8)) % groups + (kind.astype(np.uint64) << np.uint64(48)), 0)
        useful = np.ones(n, np.int64)
        frequent = np.flatnonzero(kind > 1)
        if len(frequent):
            by = frequent[np.argsort(group[frequent], kind="stable")]
            g = group[by]
            start = np.r_[True, g[1:] != g[:-1]]
            place = np.arange(len(g)) - np.maximum.accumulate(np.where(start, np.arange(len(g)), 0))
            useful[by] = place >= kind[by] - 1
        end = int(np.searchsorted(np.cumsum(useful), lose + 1)) + 1
        head, head_kind, head_group = s[:end], kind[:end], group[:end]
        rare.append(mixed(head[head_kind == 1] ^ tag))
        many = []
        for g in np.unique(head_group[head_kind > 1]):
            mine = head_group == g
            members, c_of = np.sort(head[mine & (head_kind > 1)]), int(head_kind[mine & (head_kind > 1)][0])
            many += [hash_of(x, c_of) for x in combinations(members.tolist(), c_of)]
        if many:
            common.append(mixed(np.array(many, np.uint64) ^ tag))
    return distinct(np.concatenate(rare)), distinct(np.concatenate(common))


def hash_of(members: tuple[int, ...], c: int) -> int:
    h = c
    for m in members:
        h = (h * 0x100000001B3 ^ m) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return h


def signed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, digest and bits (of the set), rare and common signatures, of every row (staged)."""
    table = frequencies(docs, words)
    cuts, shared = classes(table), docs.sparkSession.sparkContext.broadcast(table)  # fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        import xxhash

        often, split = shared.value, ByteWords()
        for d in pieces(batches):
            sets = [shingles(t, words, split) for t in d["text"]]
            signs = [signatures(s, often[s >> np.uint64(64 - COUNTER_BITS)], percent, cuts) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": d["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "bits": [parities(s) for s in sets],
                    "rare": [r.view(np.int64) for r, _ in signs],
                    "common": [c.view(np.int64) for _, c in signs],
                }
            )

    schema = f"doc_id {kind}, n_shingles bigint, digest binary, bits binary, rare array<bigint>, common array<bigint>"
    out = staged(docs.select("doc_id", whole_text().alias("text")).mapInPandas(rows, schema), "signed")
    shared.destroy()
    return out


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The compressed words of the documents in ``wanted`` (doc_id): doc_id, packed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for d in batches:
            words = (b" ".join(t.encode("utf-8", "replace").lower().split()) for t in d["text"])
            yield pd.DataFrame({"doc_id": d["doc_id"], "packed": [z.compress(w) for w in words]})

    texts = docs.select("doc_id", whole_text().alias("text")).join(checked(wanted), "doc_id", "left_semi")
    return texts.mapInPandas(rows, f"doc_id {kind}, packed binary")


def unpacked(packed: bytes, k: int, words: ByteWords) -> np.ndarray:
    import zstandard

    return distinct(shingle_hashes(words.of(zstandard.ZstdDecompressor().decompress(packed)), k))


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""

    def rows(batches):
        words = ByteWords()
        for d in batches:
            keep, last, x = [], None, None
            for a, pa, pb in zip(d["a"], d["ta"], d["tb"]):
                if x is None or a != last:
                    last, x = a, unpacked(pa, k, words)
                y = unpacked(pb, k, words)
                n = len(x) + len(y) - len(distinct(np.concatenate([x, y])))
                keep.append(100 * n >= percent * (len(x) + len(y) - n))
            yield d.loc[keep, ["a", "b"]]

    a, b = (texts.select(F.col("doc_id").alias(c), F.col("packed").alias(f"t{c}")) for c in "ab")
    kind = texts.schema["doc_id"].dataType.simpleString()
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    return both.mapInPandas(rows, f"a {kind}, b {kind}").distinct()


def shared_counts(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Sizes of all intersections of some sets: products of incidence matrices, ``chunk`` shingles at a time."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.r_[False, values[1:] != values[:-1]])
    often = np.bincount(column)[column] > 1  # a shingle of one set is in no intersection
    column, owner = column[often], owner[often]
    column = np.cumsum(np.r_[False, column[1:] != column[:-1]]) if len(column) else column
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        a, b = np.searchsorted(column, [first, first + chunk])
        m = np.zeros((n, chunk), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        out += m @ m.T
    return out


def linked_blocks(crowds: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between components among the members of crowds (first, node, component).

    Members are dealt into blocks of about ``CROWD`` and every two blocks meet
    in one group, so a group stays small and each member is sent once per
    block, not once per pair. A spanning forest of each group's links is
    returned, which connects the same nodes.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    blocks = staged(crowds.groupBy("first").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("blocks")), "blocks")
    dealt = crowds.join(blocks, "first").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("first", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component")
    full = dealt.join(texts.withColumnRenamed("doc_id", "node"), "node")

    def rows(batches):
        words = ByteWords()
        for g in groups_of(batches, ["first", "i", "j"]):
            sets = [unpacked(p, k, words) for p in g["packed"]]
            n = np.array([len(x) for x in sets])
            both = shared_counts(sets)
            component, node = g["component"].to_numpy(), g["node"].to_numpy()
            links = 100 * both >= percent * (n[:, None] + n[None] - both)
            links &= component[:, None] != component[None]
            root, out = {c: c for c in component}, []
            for x, y in np.argwhere(np.triu(links)):
                a, b = component[x], component[y]
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((node[x], node[y]))
            yield pd.DataFrame(out, columns=["a", "b"]).astype(g["node"].dtype)

    keys = ["first", "i", "j"]
    return full.select(*keys, "node", "component", "packed").repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        rows, f"a {kind}, b {kind}"
    )


def connected(edges: DataFrame) -> DataFrame:
    """Nodes of the edges (a, b): doc_id, component_id (the smallest node reachable)."""
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return e.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))
        state = now


def holders(nodes: DataFrame) -> DataFrame:
    """Signatures that two nodes or more hold: sign, node, first (the smallest holder).

    Frequent signatures are reduced before they are shuffled and joined by
    exchanges that Spark may split. Rare ones are bounded by their class, so
    one exchange serves both the reduction and the join.
    """
    out = []
    for kind in ("rare", "common"):
        held = nodes.select(F.explode(kind).alias("sign"), "node")
        held = held.repartition("sign") if kind == "rare" else held
        first = held.groupBy("sign").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        first = first.where("first <> last").select("sign", "first")
        out.append(held.join(first if kind == "rare" else staged(first, "first"), "sign").select("sign", "node", "first"))
    return out[0].unionByName(out[1])


def components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    rows = signed(docs, words, percent)
    groups = rows.where("doc_id is not null and n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("node"))
    members = staged(rows.select("doc_id", "n_shingles", "digest").join(staged(groups, "nodes"), "digest", "left"), "members")
    copies = members.where("doc_id is null or node is null or doc_id <> node").select("doc_id", "digest").distinct()
    nodes = rows.where("doc_id is not null and n_shingles > 0").join(checked(staged(copies, "copies"), 64), ["doc_id", "digest"], "left_anti")
    live = staged(holders(nodes.withColumnRenamed("doc_id", "node")), "live")
    # a document in several rows with different sets has no bitmap and is always verified
    bits = F.when(F.min("digest") == F.max("digest"), F.min("bits")).alias("bits")
    sets = rows.where("doc_id is not null and n_shingles > 0").groupBy("doc_id")
    sizes = staged(sets.agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), bits), "sizes")

    def apart_at_most(batches):
        for d in batches:
            most = (100 - percent) * (d["ma"] + d["mb"]) // (100 + percent)
            fits = [x is None or y is None or least_apart(x, y) <= m for x, y, m in zip(d["ta"], d["tb"], most)]
            yield d.loc[fits, ["a", "b"]]

    def fitting(pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) whose sizes and bitmaps allow a link."""
        kind = docs.schema["doc_id"].dataType.simpleString()
        a, b = (sizes.select(F.col("doc_id").alias(c), F.col("least").alias(f"l{c}"), F.col("most").alias(f"m{c}"), F.col("bits").alias(f"t{c}")) for c in "ab")
        fits = (100 * F.col("ma") >= percent * F.col("lb")) & (100 * F.col("mb") >= percent * F.col("la"))
        both = pairs.distinct().join(a, "a").join(b, "b").where(fits).select("a", "b", "ma", "mb", "ta", "tb")
        return staged(both.mapInPandas(apart_at_most, f"a {kind}, b {kind}"), "pairs")

    stars = fitting(live.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))
    ends = stars.select(F.col("a").alias("doc_id")).unionByName(stars.select(F.col("b").alias("doc_id")))
    links = staged(verified(stars, staged(texts_of(docs, staged(ends.distinct(), "ends")), "texts"), words, percent), "links")
    joined = staged(connected(links), "joined")

    def component(frame: DataFrame, node: str, name: str) -> DataFrame:
        found = joined.select(F.col("doc_id").alias(node), F.col("component_id").alias(name))
        return frame.join(found, node, "left").withColumn(name, F.coalesce(name, node))

    # signatures with a holder that its star left in another component: all their holders meet
    pairs = live.where("node <> first").select("node", "first").distinct()
    apart = component(component(pairs, "node", "x"), "first", "y").where("x <> y").select("node", "first")
    opened = live.join(checked(staged(apart, "apart")), ["node", "first"], "left_semi").groupBy("sign").agg(F.lit(1).alias("one"))
    rest = live.join(checked(staged(opened.drop("one"), "open")), "sign", "left_semi")
    rest = staged(component(rest, "node", "component"), "rest")
    sizes_of = rest.groupBy("sign").agg(F.count("*").alias("n"))
    large = staged(sizes_of.where(F.col("n") > CROWD_FROM).select("sign"), "large")
    few = staged(rest.join(checked(large), "sign", "left_anti"), "few")
    x, y = (few.select("sign", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "component"))) for s in "xy")
    pairs = x.join(y, "sign").where("node_x < node_y and component_x <> component_y")
    pairs = fitting(pairs.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")))
    crowds = staged(rest.join(checked(large), "sign", "left_semi").groupBy("first", "node").agg(F.min("component").alias("component")), "crowds")
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    ends = staged(ends.unionByName(crowds.select(F.col("node").alias("doc_id"))).distinct(), "ends")
    if not ends.isEmpty():
        texts = staged(texts_of(docs, ends), "texts")
        more = verified(pairs, texts, words, percent).unionByName(linked_blocks(crowds, texts, words, percent))
        joined = staged(connected(links.unionByName(staged(more, "links"))), "joined")
    found = joined.select(F.col("doc_id").alias("node"), "component_id")
    return members.join(found, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "node", "doc_id").alias("component_id")
    )


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "documents"))
