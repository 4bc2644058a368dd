"""Best-fit packing planned over the length histogram (operator 7).

Texts are tokenized once, cut into pieces and reduced to a histogram of piece
lengths (at most ``size`` counts, whatever the corpus). Best-fit decreasing
runs over these counts: one step places a whole run of equal pieces into a
run of equal sequences. The plan says, for each length and range of ranks,
the sequences and the place in them; pieces take their slots by their rank
within their length. Ranks are counted in two levels (blocks of about the
square root of all rows, then within the block), so a length that a third of
all pieces have is spread over many tasks.

The slot table depends on the number of lengths, not of documents: at most
about ``size**2 / 2`` rows, so it is sent to the workers.

Ids are those of the tokenizer file. Texts of ordinary Latin letters go
through the same vocabulary in tiktoken, which gives the same ids faster;
any other text (other scripts, very long runs) goes through ``tokenizers``.
Edge cases: null and empty texts are one piece with the end id alone; rows
that repeat a ``doc_id`` are packed each; an empty table gives no rows; a text
longer than ``size`` is cut so that all pieces but the first are full.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import read, staged, whole_text

SIZE = 2048
#: Texts for which both libraries split alike: Latin letters, common marks, no run that is very long.
PLAIN = re.compile(r"[\n\r\t\x20-\x7e¡-ɏ‐-‧€]*")
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


class Encoder:
    """Token ids of texts, with the tokenizer file (a path of the worker; by default the public one)."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.fast = None
        if path is None:
            import public_tokenizers as public

            path = public.path("byte_bpe_50k.json")
            self.fast = self._fast(public)
        self.tokenizer = Tokenizer.from_file(path)

    @staticmethod
    def _fast(public):
        import base64

        import tiktoken

        with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("bytes", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and PLAIN.fullmatch(text) and "<|endoftext|>" not in text and not LONG_RUN.search(text):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    first = n % size or size
    return [(0, min(n, first))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        encoder = Encoder(path)
        for d in batches:
            out = []
            for i, t in zip(d["doc_id"], d["text"]):
                ids = np.array([*encoder.ids(t), 0], "<u4")
                for k, (s, n) in enumerate(cuts(len(ids), size)):
                    part = ids[s : s + n]
                    out.append((i, k, s, n, zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None))
            p = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            p["doc_id"] = p["doc_id"].astype(d["doc_id"].dtype)
            yield p if with_ids else p.drop(columns="ids")

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(rows, schema)


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, pieces, first sequence, offset) per slot run."""
    slots: list[tuple[int, int, int, int, int]] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, how many)
    rooms: list[int] = []
    opened = 0

    def add(room: int, first: int, n: int) -> None:
        if room > 0:
            if room not in open_runs:
                bisect.insort(rooms, room)
            open_runs.setdefault(room, []).append((first, n))

    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                n = math.ceil(left / (size // length))
                room, first = size, opened
                opened += n
            else:
                room = rooms[at]
                first, have = open_runs[room].pop()
                n = min(have, math.ceil(left / (room // length)))
                if have > n:
                    open_runs[room].append((first + n, have - n))
                if not open_runs[room]:
                    del open_runs[room]
                    rooms.pop(at)
            slots.append((length, rank, n, first, size - room))
            add(room - length, first, n)
            left, rank = left - n, rank + n
    return slots


def ranked(parts: DataFrame, total: int) -> DataFrame:
    """``parts`` with ``rank`` (from 0) within ``length``, counted by block and then in the block."""
    blocks = max(1, math.isqrt(total))
    rows = parts.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    counts = rows.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "start")
    return (
        rows.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, ["length", "block"])
        .withColumn("rank", F.col("before") + F.col("at"))
        .drop("block", "before", "at")
    )


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    spark = docs.sparkSession
    parts = staged(pieces(docs, size, path, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = pd.DataFrame(plan(histogram, size), columns=["length", "rank", "n", "first", "offset"])
    by_length = {k: g.sort_values("rank")[["rank", "first", "offset"]].to_numpy() for k, g in slots.groupby("length")}
    shared = spark.sparkContext.broadcast(by_length)  # bounded by size, not by the corpus

    def place(batches):
        table = shared.value
        for p in batches:
            first, offset = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            length, rank = p["length"].to_numpy(), p["rank"].to_numpy()
            for n in np.unique(length):
                mine, slot = np.flatnonzero(length == n), table[n]
                run = np.searchsorted(slot[:, 0], rank[mine], side="right") - 1
                first[mine] = slot[run, 1] + rank[mine] - slot[run, 0]
                offset[mine] = slot[run, 2]
            yield p.drop(columns="rank").assign(sequence_id=first, offset=offset)

    rows = ranked(parts, sum(histogram.values()))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    return rows.select(*parts.columns, "rank").mapInPandas(place, f"{fields}, sequence_id bigint, offset bigint")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
