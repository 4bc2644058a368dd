"""Token counts by rank-synchronous array merging (operator 13).

The vocabulary of a sentencepiece BPE model is turned into one table of
mergeable pairs (left id, right id, merged id, rank). A batch's texts are cut
into pre-tokens; the distinct ones that are not known yet are laid end to end
as ragged numpy arrays, and each step finds every sequence's lowest-rank pair
(ties: leftmost) and applies it in all sequences at once. A sequence that has
no pair left is done, and its surviving symbols are its tokens; a character
outside the vocabulary counts one token for each of its UTF-8 bytes. A text's
count is the sum over its pre-tokens.

Pre-tokens are cut where no merge can reach across: before a space that
follows another character, at line feeds, and between any two characters that
no piece holds next to each other. The first cut is checked against the
vocabulary, the others follow from it, so the counts are the library's own.

A step costs as much as the symbols still at work, and a sequence needs as
many steps as it has merges. A sequence of more than ``LONG`` symbols (a run
of thousands of letters without a boundary) takes its merges from a heap in the
same order, so that its cost stays near-linear.

Memory: known pre-tokens are kept per task up to ``KEPT`` characters, a text is
worked on in parts of ``PART`` characters (cut between pre-tokens). The pair
table depends on the vocabulary alone and is broadcast.

Edge cases: a null text is empty; an empty text has no tokens and no bytes;
null and repeated ``doc_id`` are counted row by row; an empty table gives no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import read, whole_text

LIMIT = 4096
SPACE = "▁"
LONG = 512
KEPT = 8_000_000
PART = 1_000_000
NEVER = np.int64(1 << 40)


def model_path() -> str:
    """The public vocabulary; any other model's path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Merges:
    """The mergeable pairs of a sentencepiece BPE model with byte fallback and plain normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        if sum(model.is_byte(i) for i in range(size)) != 256:
            raise ValueError("the model has no byte fallback: unknown characters would not be counted by bytes")
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("the model has unused pieces, whose merges are undone")
        if model.normalize(" Aﬁ  b\n ") != f"{SPACE * 2}Aﬁ{SPACE * 2}b\n{SPACE}":
            raise ValueError("the model normalises texts; only a leading space and marked spaces are known here")
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        ids = {pieces[i]: i for i in plain}
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in ids if len(p) > 1):
            raise ValueError("pieces reach across words or lines")
        # characters that only longer pieces hold have an id of their own, beyond the vocabulary
        for c in {c for p in ids for c in p}:
            ids.setdefault(c, len(pieces) + len(ids))
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        rows = [
            (ids[p[:k]], ids[p[k:]], i, order[model.get_score(i)])
            for p, i in ((pieces[i], i) for i in plain)
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ]
        table = np.array(rows, np.int64).reshape(-1, 4)
        keys = (table[:, 0] << 32) | table[:, 1]
        by_key = np.argsort(keys)
        #: one entry more at the end: no pair
        self.keys = keys[by_key]
        self.merged = np.r_[table[by_key, 2], -1]
        self.rank = np.r_[table[by_key, 3], NEVER]
        chars = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        self.chars = np.array([c for c, _ in chars], np.int64)
        self.char_ids = np.array([i for _, i in chars], np.int64)
        self.in_vocabulary = np.array([i < size for _, i in chars])
        self.together = np.unique(np.array([(ord(a) << 32) | ord(b) for p in ids for a, b in zip(p, p[1:])], np.int64))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the table, the last entry where it can't be merged."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        found = (at < len(self.keys)) & (left >= 0) & (right >= 0)
        found[found] = self.keys[at[found]] == key[found]
        return np.where(found, at, len(self.keys))

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ragged symbols of all words: ids, extra byte tokens, word of each symbol, start of a sequence."""
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        known = self.chars[at] == code
        ids = np.where(known, self.char_ids[at], -1)
        bytes_ = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        extra = np.where(known & self.in_vocabulary[at], 0, bytes_ - 1)
        start = np.ones(len(code), bool)
        key = (code[:-1] << 32) | code[1:]
        near = np.minimum(np.searchsorted(self.together, key), len(self.together) - 1)
        start[1:] = (word[1:] != word[:-1]) | (self.together[near] != key)
        return ids, extra, word, start

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word (none is empty)."""
        ids, extra, word, start = self.symbols(words)
        tokens = np.bincount(word, extra, len(words)).astype(np.int64)
        begin = np.flatnonzero(start)
        length = np.diff(np.r_[begin, len(ids)])
        owner = word[begin]
        tokens += np.bincount(owner[length == 1], minlength=len(words))
        for s in np.flatnonzero(length > LONG):
            tokens[owner[s]] += self.one_long(ids[begin[s] : begin[s] + length[s]])
        some = (length > 1) & (length <= LONG)
        inside = np.repeat(some, length)
        left = self.together_merged(ids[inside], length[some])
        return tokens + np.bincount(owner[some], left, len(words)).astype(np.int64)

    def together_merged(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Surviving symbols of each sequence; every step merges one pair in all that have any."""
        survivors = length.copy()
        sequence = np.repeat(np.arange(len(length)), length)
        pair = np.full(len(ids), len(self.keys))
        pair[:-1] = np.where(sequence[1:] == sequence[:-1], self.pairs(ids[:-1], ids[1:]), len(self.keys))
        while len(ids):
            first = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            rank = self.rank[pair]
            lowest = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(ids)])
            hit = np.flatnonzero((rank == np.repeat(lowest, size)) & (rank < NEVER))
            hit = hit[np.r_[True, sequence[hit[1:]] != sequence[hit[:-1]]]] if len(hit) else hit
            ids[hit] = self.merged[pair[hit]]
            survivors[sequence[hit]] -= 1
            # the pairs on both sides of a merged symbol are new
            gone = np.zeros(len(ids), bool)
            gone[hit + 1] = True
            stay = np.repeat(lowest < NEVER, size) & ~gone
            fresh = np.zeros(len(ids), bool)
            fresh[hit] = True
            ids, sequence, pair, fresh = ids[stay], sequence[stay], pair[stay], fresh[stay]
            at = np.flatnonzero(fresh)
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                same = (sequence[left] == sequence[right]) & (left != right)
                pair[left] = np.where(same, self.pairs(ids[left], ids[right]), len(self.keys))
        return survivors

    def one_long(self, ids: np.ndarray) -> int:
        """Surviving symbols of one long sequence: the same merges, lowest rank and leftmost first, from a heap."""
        n = len(ids)
        symbol, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.pairs(ids[:-1], ids[1:])
        known = np.flatnonzero(pair < len(self.keys))
        heap = [*zip(self.rank[pair[known]].tolist(), known.tolist(), ids[known].tolist(), ids[known + 1].tolist())]
        heapq.heapify(heap)
        merged = {(a, b): (m, r) for a, b, m, r in zip(*self._used())}
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = merged[a, b][0], None
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (symbol[x], symbol[y]) in merged:
                    heapq.heappush(heap, (merged[symbol[x], symbol[y]][1], x, symbol[x], symbol[y]))
        return left

    def _used(self):
        return [(self.keys >> 32).tolist(), (self.keys & 0xFFFFFFFF).tolist(), self.merged.tolist(), self.rank.tolist()]


#: A word with the spaces before it, or a line feed.
WORD = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
BOUNDARY = re.compile(f"(?<=[^{SPACE}]){SPACE}|\n")


def parts(text: str, size: int = PART):
    """``text`` in parts of about ``size`` characters, cut between pre-tokens."""
    at = 0
    while len(text) - at > size:
        cut = BOUNDARY.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Counter:
    """Token counts of texts; the counts of pre-tokens met before are kept."""

    def __init__(self, merges: Merges):
        self.merges, self.known, self.kept = merges, {}, 0

    def of(self, texts: list[str]) -> list[int]:
        totals, waiting, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            for part in parts(SPACE + text.replace(" ", SPACE)):
                waiting.append((i, WORD.findall(part)))
                held += len(part)
                if held > PART:
                    self.settle(waiting, totals)
                    waiting, held = [], 0
        self.settle(waiting, totals)
        return totals

    def settle(self, waiting: list[tuple[int, list[str]]], totals: list[int]) -> None:
        new = list(set().union(*(words for _, words in waiting)) - self.known.keys())
        if new:
            self.kept += sum(map(len, new))
            self.known.update(zip(new, self.merges.count(new).tolist()))
        for i, words in waiting:
            totals[i] += sum(map(self.known.__getitem__, words))
        if self.kept > KEPT:
            self.known, self.kept = {}, 0


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(Merges(path or model_path()))

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            tokens = pa.array(counter.of(batch.column(2).to_pylist()), pa.int64())
            over = pa.compute.greater(tokens, pa.scalar(limit, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = whole_text()
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
