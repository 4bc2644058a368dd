"""Toxicity by compression distance (operator 8).

Two zstandard dictionaries compress every window of a text: one of ordinary
text, and the same followed by segments of toxic texts; a window that the second
shortens leans toxic by as much. Ordinary text stands as the words that cover
most of it. A segment lies within a window and contrasts toxic training texts with
ordinary ones (document frequencies, root of the likelihood ratio); each one is
chosen among windows that hold none chosen before, so that a rare kind of
toxic text isn't crowded out by variants of a common one. A window is one
normalised word with its borders, each byte spread to three of itself and up to two
bytes before it, so that the gain grows with the matched length and
fragments matched out of context save little; equal windows of a batch are
compressed once. Gains (mean, and rates over several thresholds) are calibrated
to a probability by logistic regression.

Only the bounded sample of labelled rows (``PER_CLASS`` per label, by hash of
the id) goes through the driver; scoring is one pass without a shuffle.
Edge cases: null and empty texts score as a text without windows; null
labels, ids without a document and ids with both labels are not learned from;
of several texts with one id the first in byte order is; with one label
missing every score is the share of toxic labels; repeated rows score alike.
Inputs of a score are the text alone.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import distinct, read, whole_text

#: Training bound: at most so many labelled documents of each label.
PER_CLASS = 1500
SEGMENTS, WORDS, LEVEL = 150, 300, 13
#: Least contrast of a segment, and the share of the best contrast at which a longer segment is taken.
LEAST, NEAR = 4.0, 0.99
CUTS = (4.0, 6.0, 9.0, 12.0)
TOKEN = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[bytes]:
    return TOKEN.findall(text.lower().encode("utf-8", "replace"))


class Spread(dict):
    """Three bytes for a byte with the two before it, by a fixed linear rule: of it, of it and the one before, of all three."""

    def __missing__(self, three: bytes) -> bytes:
        p, q, b = three
        if len(self) >= SEEN:
            self.clear()
        out = self[three] = bytes(((b * 167 + 13) & 255, (b * 59 + q * 151 + 101) & 255, (b * 211 + q * 77 + p * 29 + 47) & 255))
        return out


SPREAD = Spread()


def spread(word: bytes) -> bytes:
    w = b"\0\0" + word
    return b"".join([SPREAD[w[i : i + 3]] for i in range(len(word))])


class Vocabulary:
    """The distinct words of some texts, and for every word the texts that hold it."""

    def __init__(self, texts: list[str]):
        ids: dict[bytes, int] = {}
        each = [np.fromiter((ids.setdefault(w, len(ids)) for w in set(words_of(t))), np.int32) for t in texts]
        word = np.concatenate([np.zeros(0, np.int32), *each])
        order = np.argsort(word, kind="stable")
        self.words, self.text = list(ids), np.repeat(np.arange(len(texts)), [len(x) for x in each])[order]
        self.start = np.searchsorted(word[order], np.arange(len(ids) + 1))

    def segments(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Every segment of ``k`` bytes (up to 8, packed) within a word and its borders, and that word; each pair once, sorted."""
        b = np.frombuffer(b" " + b" ".join(self.words) + b" ", np.uint8).astype(np.uint64)
        n = len(b) - k + 1
        if n < 1 or not self.words:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        x = np.zeros(n, np.uint64)
        for i in range(k):
            x = (x << np.uint64(8)) | b[i : n + i]
        borders = np.cumsum(b == 32)
        inside = borders[k - 2 : n + k - 2] == borders[:n]  # no border between its first and its last byte
        x, word = x[inside], (borders[:n] - 1)[inside]
        order = np.lexsort((word, x))
        x, word = x[order], word[order]
        once = np.ones(len(x), bool)
        once[1:] = (x[1:] != x[:-1]) | (word[1:] != word[:-1])
        return x[once], word[once]

    def holding(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts that hold each of ``words``: its place there and the text."""
        size = self.start[words + 1] - self.start[words]
        at = np.repeat(np.arange(len(words)), size)
        return at, self.text[np.arange(len(at)) + np.repeat(self.start[words] - np.cumsum(size) + size, size)]


def contrast(n: np.ndarray, m: np.ndarray, of_n: int, of_m: int) -> np.ndarray:
    """Root of the likelihood ratio of ``n`` in ``of_n`` texts against ``m`` in ``of_m``; 0 where they are no more."""
    share = (n + m) / (of_n + of_m)

    def part(x, of):
        log = lambda a, b: a * np.log(np.maximum(a, 1e-9) / np.maximum(b, 1e-9))
        return log(x, share * of) + log(of - x, (1 - share) * of)

    return np.where(n * of_m > m * of_n, np.sqrt(np.maximum(0, 2 * (part(n, of_n) + part(m, of_m)))), 0)


#: Pairs of segment and text that are counted at a time.
PAIRS = 1 << 20


def contrast_segments(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Segments that tell toxic texts from ordinary ones, the most telling first; each by the words without one before it."""
    v, every, least = Vocabulary([*toxic, *ordinary]), len(toxic) + len(ordinary), max(3, 0.02 * len(toxic))

    def telling(segment: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
        """Contrast of each of ``size`` segments, given its texts (each once)."""
        n, m = (np.bincount(segment[y], minlength=size) for y in (text < len(toxic), text >= len(toxic)))
        return np.where(n >= least, contrast(n, m, len(toxic), len(ordinary)), 0)

    found, rows = [], [np.zeros((3, 0), np.int64)]  # candidates; of each the number, a word with it and a text with that word
    for k in (4, 5, 6, 7, 8):
        x, word = v.segments(k)
        first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
        before = np.r_[0, np.cumsum(v.start[word + 1] - v.start[word])]
        part = before[first] // PAIRS
        cuts = [*first[np.flatnonzero(np.r_[True, part[1:] != part[:-1]])], len(x)] if len(x) else []
        for a, b in zip(cuts, cuts[1:]):
            which = np.cumsum(np.r_[False, x[a + 1 : b] != x[a : b - 1]])
            at, text = v.holding(word[a:b])
            segment, by = np.divmod(distinct(which[at] * every + text), every)
            good = telling(segment, by, which[-1] + 1) > LEAST
            keep = good[which[at]]
            number = np.cumsum(good) - 1 + len(found)
            rows.append(np.stack([number[which[at][keep]], word[a:b][at[keep]], text[keep]]))
            found += [int(y).to_bytes(k, "big") for y in x[a:b][np.r_[True, which[1:] != which[:-1]]][good]]
    segment, word, text = np.concatenate(rows, axis=1)
    pairs = distinct(segment * every + text)
    pair = np.searchsorted(pairs, segment * every + text)
    which, by = np.divmod(pairs, every)
    left, out = np.ones(len(word), bool), []
    while found and len(out) < SEGMENTS:
        some = np.bincount(pair[left], minlength=len(pairs)) > 0
        z = telling(which[some], by[some], len(found))
        if z.max() <= LEAST:
            break
        best = max(np.flatnonzero(z >= NEAR * z.max()), key=lambda i: (len(found[i]), z[i], found[i]))
        out.append(found[best])
        left &= ~np.isin(word, word[segment == best])
    return out


#: Words whose gains a worker keeps (some 150 bytes each).
SEEN = 200_000


class Compressors:
    """The two dictionaries and the window cache of one worker."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as zs

        def with_dictionary(content: bytes):
            params = zs.ZstdCompressionParameters.from_level(
                LEVEL, source_size=64, dict_size=max(1, len(content)), min_match=3,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            raw = zs.ZstdCompressionDict(content or b"\0" * 16, dict_type=zs.DICT_TYPE_RAWCONTENT)
            return zs.ZstdCompressor(dict_data=raw, compression_params=params)

        self.toxic, self.ordinary, self.seen = with_dictionary(toxic), with_dictionary(ordinary), {}

    def gain(self, word: bytes) -> int:
        g = self.seen.get(word)
        if g is None:
            if len(self.seen) >= SEEN:
                self.seen.clear()
            w = spread(b" " + word + b" ")
            g = self.seen[word] = len(self.ordinary.compress(w)) - len(self.toxic.compress(w))
        return g

    def features(self, text: str) -> list[float]:
        words = words_of(text)
        g = np.fromiter(map(self.gain, words), float, len(words))
        out = [np.log1p(len(g)), np.clip(g, 0, None).mean() if len(g) else 0.0]
        for cut in CUTS:
            hits = int((g >= cut).sum())
            out += [np.log1p(hits), 100 * hits / (len(g) + 20)]
        return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w, r = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    r[0, 0] = 0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + r, x.T @ (p - y) + r @ w)
    return w


def train(toxic: list[str], ordinary: list[str], prior: float) -> dict:
    """Dictionaries and calibration; ``prior`` is the share of toxic labels."""
    if not toxic or not ordinary:
        return {"constant": prior}
    common = Counter(w for t in ordinary for w in words_of(t)).most_common(WORDS)
    usual = b"".join(spread(b" " + w + b" ") for w, _ in reversed(common))
    # the same text in both: what a toxic segment does not shorten, gains nothing
    model = {"toxic": usual + b"".join(map(spread, reversed(contrast_segments(toxic, ordinary)))), "ordinary": usual}
    c = Compressors(model["toxic"], model["ordinary"])
    x = np.array([c.features(t) for t in [*toxic, *ordinary]])
    y = np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))]
    model["mean"], model["scale"] = x.mean(0), x.std(0) + 1e-9
    model["weights"] = logistic((x - model["mean"]) / model["scale"], y)
    model["weights"][0] += np.log(prior / (1 - prior)) - np.log(len(toxic) / len(ordinary))
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Learn from at most ``per_class`` labelled rows of each label outside the held-out fold."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)"
    ).where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    order = [F.xxhash64(F.col("doc_id").cast("string")), "doc_id"]
    picked = [known.where(f"toxic = {v}").orderBy(*order).limit(per_class) for v in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * per_class ids at most, each of them once
    rows = docs.select("doc_id", whole_text().alias("text")).join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text")
    texts = {0: [], 1: []}
    for r in sorted(rows.collect()):
        texts[r["toxic"]].append(r["text"])
    return train(texts[1], texts[0], min(max(prior, 1e-6), 1 - 1e-6) if counts else 0.0)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Per row: doc_id, held_out, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        m = shared.value
        c = None if "constant" in m else Compressors(m["toxic"], m["ordinary"])
        for d in batches:
            if c is None:
                s = np.full(len(d), m["constant"])
            else:
                x = (np.array([c.features(t) for t in d["text"]]).reshape(len(d), -1) - m["mean"]) / m["scale"]
                s = 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), x] @ m["weights"], -30, 30)))
            yield pd.DataFrame({"doc_id": d["doc_id"], "held_out": d["held_out"], "score": s})

    source = docs.select("doc_id", held_out().alias("held_out"), whole_text().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(rows, f"doc_id {kind}, held_out boolean, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
