"""Chat formatting: roles of transcript lines by a hidden Markov model (operator 9).

A transcript is an ordered run of rows per conversation, each a text of one or
more lines. A state is a role and whether the line begins a turn; a line shows
a speaker marker (or none), its shape (question, code, list, blank, prose)
and its length. A row's first line always begins a turn, and a turn may begin
at any other line, so a text that holds a whole transcript is taken apart; at a line without
a marker that costs more the more labelled rows there are, as none of them does it.
Transition and emission counts of labelled rows are summed by Spark and
smoothed; conversations of the held-out fold (crc32 of conv_id as text, mod
``FOLDS``, is ``HELD_OUT``) teach nothing, and a role is never an input of what is recovered.
Viterbi recovers the states, and each turn is rendered as ``<|role|>``, its
text without the marker, ``<|end|>``.

A conversation may hold a third of all lines, so it is decoded in blocks of
``BLOCK_TURNS`` rows, counted in order whatever the turn numbers are: each
block gives the best score from every state before it to every state at its
end (a 6 x 6 matrix), the matrices of a conversation are chained in levels of
``FAN``, and each block is decoded between the states that the chain fixed.
Tasks hold the numbers of the lines, not texts, and decode many blocks in one
numpy recursion. A turn never leaves its row, so the rows are rendered by themselves.
Scores are integers (nats times ``UNIT``), with up to 2^16 added by a hash of the
line's place and state, so equal paths are decided alike whatever the blocks are.

Edge cases: null text is an empty line; null turns come first; rows of one
turn are ordered by a hash of their text; rows that repeat are a turn each; a null or unknown
role teaches nothing; a null conversation is a group of its own, not held
out; without any labelled row roles follow from markers and uniform counts;
an empty table gives no rows; columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import mixed, read, staged, whole_text

ROLES = ["system", "user", "assistant"]
#: Speaker markers that transcripts use, by the role they hint at.
MARKERS = {"system": "system|instructions?", "user": "user|human|customer|q", "assistant": "assistant|ai|bot|agent|a"}
MARKER = r"(?i)^\s*[\[<(*]*({})[\])*]*\s*[:>\-]\s"
SHAPES, LENGTHS = 5, 8
FOLDS, HELD_OUT = 4, 2
STATES = len(ROLES) * 2  # role, role going on
BLOCK_TURNS = 64
#: Blocks that are chained in one group.
FAN = 64
#: Integer score of one nat; what a turn that doesn't begin with its row would cost; lines that are worked on at once.
UNIT, NEVER, SLAB = 1 << 32, 1 << 44, 1 << 18


def marker_of(line: Column) -> Column:
    out = F.lit(0)
    for k, role in enumerate(ROLES):
        out = F.when(line.rlike(MARKER.format(MARKERS[role])), k + 1).otherwise(out)
    return out


def seen_in(line: Column) -> Column:
    """One number for marker, shape and length of a line."""
    shape = (
        F.when(F.trim(line) == "", 0)
        .when(line.rlike(r"\?\s*$"), 1)
        .when(line.rlike(r"^\s*([-*•]|\d+[.)])\s"), 2)
        .when(line.rlike(r"[{};=]\s*$|^\s*```"), 3)
        .otherwise(4)
    )
    length = F.least(F.floor(F.log2(F.length(line) + 1)).cast("int"), F.lit(LENGTHS - 1))
    return ((marker_of(line) * SHAPES + shape) * LENGTHS + length).cast("int")


def transcript_rows(turns: DataFrame) -> DataFrame:
    """Staged rows of turns (conv_id, turn, role, text): row, conv_id, turn, at, role (0 to 2 or null), held_out, text."""
    named = F.lower(F.col("role").cast("string"))
    role = F.coalesce(*(F.when(named == k, F.lit(r)) for r, k in enumerate(ROLES)))
    fold = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(FOLDS))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), whole_text().alias("text"))
    return staged(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("at", F.xxhash64("text")), "rows")


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """``a`` joined with ``b`` on keys that may be null."""
    other = b.withColumnsRenamed({k: f"{k}_" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    return a.join(other, on).drop(*(f"{k}_" for k in keys))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seen`` (a number per line) instead of the text, their place in the conversation and its block."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "at", "row")]
    seen = F.transform(F.split("text", "\n"), seen_in)
    heads = rows.withColumn("seen", seen).drop("text").repartitionByRange(*order).sortWithinPartitions(*order)
    heads = staged(heads.withColumn("spot", F.monotonically_increasing_id()).withColumn("run", F.shiftright("spot", 33)), "heads")
    runs = heads.groupBy("conv_id", "run").agg(F.min("spot").alias("first"), F.count("*").alias("n"))  # a row per partition of a conversation
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("run")) - F.col("n")
    runs = staged(runs.select("conv_id", "run", (F.col("first") - before).alias("zero")), "runs")
    placed = same(heads, runs, ["conv_id", "run"]).withColumn("place", F.col("spot") - F.col("zero")).drop("spot", "zero", "run")
    return staged(placed.withColumn("block", F.floor(F.col("place") / BLOCK_TURNS)), "ordered")


def fit(placed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Log start, transition and emission tables, and of a turn unmarked within its row, from the labelled rows that are not held out."""
    n, kinds = len(ROLES), SHAPES * LENGTHS
    start, move = np.ones(STATES), np.full((STATES, STATES), 0.5)
    mark, form = np.full((STATES, n + 1), 0.05), np.full((STATES, kinds), 0.1)
    start[n:] = move[:, n:] = 0.01
    mark[:, 0] = 1
    for r in range(n):  # a marker hints at its role
        mark[r, r + 1] = 5
        move[[r, r + n], r + n] = 1
    known = placed.where("role is not null and not held_out").withColumn("n", F.size("seen"))
    lines = known.select("role", F.posexplode("seen").alias("part", "code"))
    for r in lines.groupBy("role", (F.col("part") > 0).cast("int").alias("on"), "code").agg(F.count("*").alias("n")).collect():
        state = r["role"] + n * r["on"]
        mark[state, r["code"] // kinds] += r["n"]
        form[state, r["code"] % kinds] += r["n"]
    long = (F.col("n") > 1).cast("long")
    for r in known.groupBy("role").agg(F.sum(long).alias("longer"), F.sum(F.col("n") - 1).alias("more")).collect():
        move[r["role"], n + r["role"]] += r["longer"]
        move[n + r["role"], n + r["role"]] += r["more"] - r["longer"]
    before = known.select("conv_id", (F.col("place") + 1).alias("place"), (F.col("role") + n * long).alias("before"))
    follow = same(known.select("conv_id", "place", "role"), before, ["conv_id", "place"])
    for r in follow.groupBy("before", "role").agg(F.count("*").alias("n")).collect():
        move[r["before"], r["role"]] += r["n"]
    for r in known.where("place = 0").groupBy("role").agg(F.count("*").alias("n")).collect():
        start[r["role"]] += r["n"]
    quiet = -np.log(mark[:n, 0].sum())  # rows that begin without a marker
    mark, form = (np.log(x / x.sum(1, keepdims=True)) for x in (mark, form))
    show = (mark[:, :, None] + form[:, None]).reshape(STATES, -1)
    return np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), show, np.array(quiet)


def whole(table: np.ndarray) -> np.ndarray:
    return np.rint(table * UNIT).astype(np.int64)


class Lines:
    """Blocks of one batch, longest first, as padded arrays."""

    def __init__(self, d: pd.DataFrame, show: np.ndarray, quiet: np.ndarray):
        self.sizes, self.show, self.quiet = d["lines"].to_numpy(np.int64), show, quiet
        shape = len(d), int(self.sizes[0])
        self.seen, self.key, self.opens = np.zeros(shape, np.int32), np.zeros(shape, np.uint64), np.zeros(shape, bool)
        for i, (seen, counts, at, block) in enumerate(zip(d["seen"], d["counts"], d["ats"], d["block"])):
            first = np.cumsum(counts) - counts
            place = np.arange(len(counts), dtype=np.uint64) + np.uint64(int(block) * BLOCK_TURNS)
            key = mixed(np.asarray(at, np.int64).view(np.uint64) + place * np.uint64(0x9E3779B97F4A7C15))
            self.seen[i, : len(seen)] = seen
            self.key[i, : len(seen)] = np.repeat(key, counts) + (np.arange(len(seen)) - np.repeat(first, counts)).astype(np.uint64) * np.uint64(STATES)
            self.opens[i, first] = True

    def __iter__(self):
        """Line number, how many blocks have it, and the score of each of its states in them."""
        width = max(1, SLAB // len(self.sizes))
        for a in range(0, self.seen.shape[1], width):
            part = slice(a, a + width)
            score = self.show.T[self.seen[:, part]]
            score += (mixed(self.key[:, part, None] + np.arange(STATES, dtype=np.uint64)) >> np.uint64(48)).astype(np.int64)
            score[:, :, len(ROLES) :] -= self.opens[:, part, None] * np.int64(NEVER)
            score[:, :, : len(ROLES)] += (~self.opens[:, part, None] & (self.seen[:, part, None] < SHAPES * LENGTHS)) * self.quiet
            for t in range(score.shape[1]):
                held = int((self.sizes > a + t).sum())
                yield a + t, held, score[:held, t]


def batches_of(frames, show: np.ndarray, quiet: np.ndarray):
    """Batches of blocks of like length, at most about ``SLAB`` lines or one block each."""
    for d in frames:
        d = d.sort_values("lines", ascending=False)
        a = 0
        while a < len(d):
            b = a + max(1, min(2048, SLAB // int(d["lines"].iloc[a])))
            yield d.iloc[a:b], Lines(d.iloc[a:b], show, quiet)
            a = b


def block_matrices(lines: Lines, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best score from each state before a block (the last row: no state) to each state at its last line; the best is 0."""
    m = None
    for t, held, score in lines:
        if t == 0:
            m = np.vstack([move, start])[None] + score[:, None]
        else:
            m[:held] = (m[:held, :, :, None] + move).max(2) + score[:, None]
    return m - m.max((1, 2), keepdims=True)


def best_states(lines: Lines, first: np.ndarray, last: np.ndarray, move: np.ndarray) -> np.ndarray:
    """States of each block's lines given the scores ``first`` of the first line's states and the last state (-1: any)."""
    back, best = [], None
    for t, held, score in lines:
        if t == 0:
            best = first + score
        else:
            x = best[:held, :, None] + move
            back.append(x.argmax(1).astype(np.int8))
            best[:held] = x.max(1) + score
    now = np.where(last < 0, best.argmax(1), last).astype(np.int8)
    states = np.zeros(lines.seen.shape, np.int8)
    for t in range(states.shape[1] - 1, -1, -1):
        held = len(back[t - 1]) if t else len(now)
        states[:held, t] = now[:held]
        if t:
            now[:held] = back[t - 1][np.arange(held), now[:held]]
    return states


def chained(matrices: np.ndarray, before: int, last: int) -> list[int]:
    """The state at the end of each block on the best path through all blocks, from ``before`` to ``last`` (-1: not fixed)."""
    best, back = matrices[0][before], []
    for m in matrices[1:]:
        x = best[:, None] + m[:STATES]
        back.append(x.argmax(0))
        best = x.max(0)
    ends = [int(best.argmax()) if last < 0 else last]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    return ends[::-1]


def chains_of(scores: DataFrame) -> DataFrame:
    """conv_id, block, before and last state (-1: none) of the blocks (conv_id, block, scores), chained in levels."""
    conv = scores.schema["conv_id"].dataType.simpleString()
    matrices = lambda rows: np.array([r["scores"] for r in rows], np.int64).reshape(-1, STATES + 1, STATES)

    def combine(batches):
        for d in batches:
            out = []
            for rows in d["rows"]:
                every = matrices(rows)
                m = every[0]
                for x in every[1:]:
                    m = (m[:, :, None] + x[None, :STATES]).max(1)
                out.append((m - m.max()).ravel())
            yield pd.DataFrame({"conv_id": d["conv_id"], "block": d["parent"], "scores": out})

    def fix(batches):
        for d in batches:
            ends = [chained(matrices(rows), a, b) for rows, a, b in zip(d["rows"], d["first"], d["final"])]
            yield pd.DataFrame({
                "conv_id": d["conv_id"].repeat([len(e) for e in ends]),
                "block": [r["block"] for rows in d["rows"] for r in rows],
                "before": [s for e, a in zip(ends, d["first"]) for s in (a, *e[:-1])],
                "last": [s for e in ends for s in e],
            })

    def together(df):  # at most FAN small matrices
        return df.groupBy("conv_id", "parent").agg(F.sort_array(F.collect_list(F.struct("block", "scores"))).alias("rows"))

    levels = []
    while True:
        levels.append(staged(together(scores.withColumn("parent", F.floor(F.col("block") / FAN))), "level"))
        if (levels[-1].agg(F.max("parent")).first()[0] or 0) == 0:
            break
        scores = levels[-1].mapInPandas(combine, f"conv_id {conv}, block bigint, scores array<bigint>")
    ends = None
    for level in reversed(levels):
        if ends is None:
            level = level.withColumn("first", F.lit(-1)).withColumn("final", F.lit(-1))
        else:
            level = same(level, ends.select("conv_id", F.col("block").alias("parent"), F.col("before").alias("first"), F.col("last").alias("final")), ["conv_id", "parent"])
        ends = staged(level.mapInPandas(fix, f"conv_id {conv}, block bigint, before int, last int"), "chains")
    return ends


def recovered(placed: DataFrame, model: tuple) -> DataFrame:
    """row, states (0 to 5, one per line) of the ordered rows."""
    start, move, show, quiet = (whole(x) for x in model)
    conv = placed.schema["conv_id"].dataType.simpleString()
    rows = F.sort_array(F.collect_list(F.struct("place", "row", "at", "seen")))  # at most BLOCK_TURNS, without texts
    blocks = placed.groupBy("conv_id", "block").agg(rows.alias("rows"))
    seen = F.flatten(F.transform("rows", lambda r: r["seen"]))
    blocks = staged(blocks.select("conv_id", "block", F.col("rows.row").alias("ids"), F.col("rows.at").alias("ats"), F.transform("rows", lambda r: F.size(r["seen"])).alias("counts"), seen.alias("seen"), F.size(seen).alias("lines")), "blocks")

    def matrices(frames):
        for d, lines in batches_of(frames, show, quiet):
            yield pd.DataFrame({"conv_id": d["conv_id"], "block": d["block"], "scores": list(block_matrices(lines, start, move).reshape(len(d), -1))})

    def decode(frames):
        before = np.vstack([move, start])  # -1 is the last row: no state
        for d, lines in batches_of(frames, show, quiet):
            states = best_states(lines, before[d["before"].to_numpy()], d["last"].to_numpy(), move)
            parts = [p for s, counts in zip(states, d["counts"]) for p in np.split(s[: sum(counts)], np.cumsum(counts)[:-1])]
            yield pd.DataFrame({"row": np.concatenate([*d["ids"]]), "states": parts})

    scores = blocks.select("conv_id", "block", "ats", "counts", "seen", "lines").mapInPandas(matrices, f"conv_id {conv}, block bigint, scores array<bigint>")
    both = same(blocks, chains_of(scores), ["conv_id", "block"])
    return both.select("conv_id", "block", "ids", "ats", "counts", "seen", "lines", "before", "last").mapInPandas(decode, "row bigint, states array<tinyint>")


def format_turns(turns: DataFrame, model: tuple | None = None) -> DataFrame:
    """Per recovered turn: conv_id, place (of its row), part (in the row), role, n_lines, held_out, labelled (the row's role, not an input), rendered."""
    rows = transcript_rows(turns)
    placed = ordered(rows)
    states = staged(recovered(placed, model or fit(placed)), "states")
    both = rows.select("row", "conv_id", "role", "held_out", F.split("text", "\n").alias("lines")).join(states, "row").join(placed.select("row", "place"), "row")
    begins = F.filter(F.sequence(F.lit(0), F.size("states") - 1), lambda i: F.get("states", i) < len(ROLES))
    both = both.withColumn("begins", begins)
    end = lambda k: F.coalesce(F.get("begins", k + 1), F.size("states"))
    parts = F.transform("begins", lambda b, k: F.struct(F.get("states", b).alias("state"), F.slice("lines", b + 1, end(k) - b).alias("lines")))
    name = lambda r: F.element_at(F.array(*map(F.lit, ROLES)), r.cast("int") + 1)
    out = both.select("conv_id", "place", "held_out", F.when(F.col("role").isNotNull(), name(F.col("role"))).alias("labelled"), F.posexplode(parts).alias("part", "turn"))
    body = F.concat_ws("\n", F.col("turn.lines"))
    body = F.regexp_replace(body, MARKER.format("|".join(MARKERS.values())), "")
    role = name(F.col("turn.state"))
    return out.select(
        "conv_id", "place", "part", role.alias("role"), F.size("turn.lines").alias("n_lines"), "held_out", "labelled",
        F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("<|end|>")).alias("rendered"),
    )


def accuracy(formatted: DataFrame) -> DataFrame:
    """labelled, held_out, n, right: how many labelled rows begin with a turn of their role."""
    heads = formatted.where("part = 0 and labelled is not null")
    right = F.sum((F.col("role") == F.col("labelled")).cast("long"))
    return heads.groupBy("labelled", "held_out").agg(F.count("*").alias("n"), right.alias("right"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_turns(read(spark, sf_dir, "conversations"))
