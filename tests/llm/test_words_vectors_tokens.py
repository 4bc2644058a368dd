"""Operators 11 to 13 against brute force, and their edge cases."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import hard_negatives, spelling, token_counts

CLASH = ("word", "n", "near", "key", "short", "row", "label", "block", "cluster", "n_bytes", "n_tokens", "over_limit", "run", "doc")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


# --- operator 11 ---


def brute_words(rows):
    low = {c: c + 32 for c in range(65, 91)}
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(words):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def variants(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    stems = ["spelling", "variants", "wörterbuch", "abcabcabc", "aaaaaaaa", "ÉCOLES×÷à", "frequent"]

    def changed(w):
        i = rnd.randrange(len(w) + 1)
        return rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abÀ") + w[i:], w[:i] + "z" + w[i + 1 :]])

    words = [rnd.choice([w, w, w, changed(w), changed(changed(w))]) for w in rnd.choices(stems, k=4000)]
    texts = [" ".join(words[i : i + 40]) for i in range(0, 4000, 40)]
    chain = "rootword " * 400 + "rootwordx " * 30 + "rootwordxy " * 3 + "tiewordA " * 2 + "tiewordb tiewordc " * 20
    return [*texts, texts[0], chain, chain, "Mixed-Case MIXED's Frequent", "x" * 5000, "x" * 5000 + " " + "x" * 4999, "x" * 4999, "", " ", None]


def test_variants_equal_brute_force(spark, texts):
    rows = [*enumerate(texts), (None, texts[1]), (3, texts[3])]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    words = brute_words(rows)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs).select("word", "n").collect()} == words
    want = brute_variants(words)
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[2] != r[1] for r in want)
    found = spelling.vocabulary(docs)
    assert variants(spelling.variants(found)) == want
    # crowded keys are split, parts indexed one by one: the same rows
    assert variants(spelling.variants(found, crowd=3, together=1)) == want
    assert variants(spelling.variants(spelling.vocabulary(docs.where("false")))) == set()


def test_every_near_pair_shares_a_part(spark):
    words = ["".join(w) for w in itertools.product("ab", repeat=7)] + ["".join(w) for w in itertools.product("ab", repeat=8)]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r["word"], r["near"]) for r in spelling.near_words(df, crowd=16).collect()}
    assert got == {(a, b) for a in words for b in words if one_apart(a, b)}
    sizes = [r["count"] for r in spelling.parts(df, crowd=16).groupBy("key").count().collect()]
    assert max(sizes) <= 16


# --- operator 12 ---


def brute_negatives(rows, is_anchor=lambda i: i % 50 == 0):
    usable = [
        (i, label, [int(np.floor(256 * float(x))) for x in v], k)
        for k, (i, label, v) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v, k in usable:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, u)), j, m, lab) for j, lab, u, m in usable if m != k)
        for s, p, *_ in [r for r in scored if r[3] == label][:5]:
            band = [r for r in scored if r[3] != label and -50 * s <= -100 * r[0] <= -95 * s][:3]
            out += [(i, p, n + 1, r[1], -s, -r[0]) for n, r in enumerate(band)]
    return sorted(out)


def vectors_table(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"))


def mined(table, **parameters):
    rows = hard_negatives.usable(table.select("vec_id", "label", "embedding", "word"))
    return sorted(tuple(r) for r in hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, **parameters).collect())


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(6, 8))
    rows = [(i, int(rnd.integers(4)), (centres[i % 6] + 0.3 * rnd.normal(size=8)).astype(np.float32).tolist()) for i in range(700)]
    same = [0.5] * 8
    rows += [(1000 + i, i % 3, same) for i in range(300)]
    rows += [(50, 1, rows[7][2]), (50, 1, rows[7][2]), (100, 2, [0.0] * 8), (2000, 1, []), (2001, 1, [1.0, 2.0])]
    bad = [(None, 1, same), (150, None, same), (200, 1, None), (250, 1, [None] + same[1:]), (300, 1, [float("nan")] + same[1:])]
    return rows + bad + [(350, 2, [float("inf")] + same[1:]), (5000, 9, same), (5050, 9, same)]


def test_negatives_equal_brute_force(spark, vectors):
    want = brute_negatives(vectors)
    table = vectors_table(spark, vectors)
    assert want and mined(table) == want
    assert mined(table, least_blocks=3, block_bytes=8 * 8 * 100, clusters=5) == want
    assert mined(table.where("false")) == [] and mined(table.where("vec_id % 50 <> 0")) == []


def test_scores_stay_exact_for_large_components(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, i % 2, [float(np.float32(x)) for x in rnd.normal(size=3) * 10.0 ** (3 + i % 5)]) for i in range(120)]
    assert mined(vectors_table(spark, rows)) == brute_negatives(rows)


def test_members_leave_the_list_early():
    """The certificate stops the walk: far fewer candidates are scored than there are."""
    rnd = np.random.default_rng(1)
    centres = np.eye(16) * 256
    x = np.floor(np.repeat(centres, 2000, axis=0) + rnd.normal(size=(32_000, 16)) * 8)
    block = hard_negatives.Block(np.arange(len(x)), np.arange(len(x)), np.zeros(len(x), int), x)
    members = x[:20]
    centre = centres[0] / 256
    block.arrange(centre, hard_negatives.angles(members, hard_negatives.norms(members), centre[None]).max())
    seen = []

    def wanted(m, c, s):
        seen.append(len(c))
        return np.ones((len(m), len(c)), bool)

    m, c, s = block.walk(np.arange(len(x)), members, wanted, np.full(20, hard_negatives.NONE), 5)
    assert sum(seen) <= 4 * hard_negatives.CHUNK
    exact = members @ x.T
    for i in range(20):
        order = np.lexsort((np.arange(len(x)), -exact[i]))[:5]
        assert c[m == i].tolist() == order.tolist() and s[m == i].tolist() == exact[i][order].tolist()


# --- operator 13 ---


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())


@pytest.fixture(scope="module")
def merges():
    return token_counts.Merges(token_counts.model_path())


def strange(rnd):
    kinds = ["ab", "abc \n", "▁ ", "aA1 .,;", "é́ß日本語梦 ", "\U0001f600 a‍", "  \t\r\n\x00\x7f", "thing in er on the", "=-_#"]
    return "".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.choice([0, 1, 2, 9, 60, 300])))


def test_counts_equal_the_library(library, merges):
    rnd = random.Random(2)
    texts = [strange(rnd) for _ in range(2000)]
    texts += [" " * 1500, "a" * 3000, "the" * 800, " x" * 1000, "".join(rnd.choices("abcdefgh", k=4000)), " " * 700 + "ab", "a\n\nb"]
    texts += ["<s>hi</s><unk><0x0A>", "".join(chr(rnd.randrange(0x20, 0xD7FF)) for _ in range(2000))]
    want = [len(x) for x in library.encode(texts)]
    assert token_counts.Counter(merges).of(texts) == want
    assert token_counts.Counter(merges).of(texts[::-1]) == want[::-1]


def test_long_sequences_merge_alike(merges):
    """The heap for long sequences gives what the array steps give."""
    rnd = random.Random(6)
    words = ["▁" + "".join(rnd.choices("thereinga", k=rnd.randrange(2, 80))) for _ in range(300)] + ["▁" * k for k in range(2, 40)]
    for w in words:
        ids, _, _, start = merges.symbols([w])
        begin = np.flatnonzero(start)
        lengths = np.diff(np.r_[begin, len(ids)])
        steps = merges.together_merged(ids.copy(), lengths).tolist()
        assert steps == [merges.one_long(ids[a : a + n]) if n > 1 else 1 for a, n in zip(begin, lengths)]


def test_parts_do_not_change_counts(library, merges, monkeypatch):
    rnd = random.Random(8)
    text = " ".join(strange(rnd) for _ in range(200))
    assert "".join(token_counts.parts(text, 50)) == text
    monkeypatch.setattr(token_counts, "PART", 100)
    monkeypatch.setattr(token_counts, "KEPT", 500)
    assert token_counts.Counter(merges).of([text, "", text]) == [len(library.encode(text)), 0, len(library.encode(text))]


def test_token_count_rows(spark, library):
    texts = [None, "", " ", "one", "ü € 𝔘", "word " * 5000, "word " * 5000]
    rows = [(None if i == 3 else i % 6, t) for i, t in enumerate(texts)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((tuple(r) for r in token_counts.token_counts(docs).collect()), key=str)
    counts = [len(library.encode(t or "")) for t in texts]
    assert got == sorted(((i, len((t or "").encode()), n, n > 4096) for (i, t), n in zip(rows, counts)), key=str)
    assert token_counts.token_counts(docs.where("false")).count() == 0
