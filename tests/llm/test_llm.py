"""Operators of netsift.llm against brute force, round trips, held-out accuracy and edge cases."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from netsift.llm import chat, decontaminate, exact_dedup, line_dedup, ngram_join, packing, pii, quality, toxicity, warc
from netsift.llm.common import ByteWords, read

LONG = " ".join(f"w{i}" for i in range(30_000))
WORDS = [f"word{i}" for i in range(400)]


def near(base, *changes):
    w = list(base)
    for i, x in changes:
        w[i] = x
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    base = WORDS[:150]
    texts = [None, "", " \t\n", "one", "One two three", near(base), near(base), near(base, (3, "x")), near(base, (3, "X")), LONG, LONG + " end"]
    texts += [near(base, (5 * k + 20, f"y{k}")) for k in range(20)]
    texts += [near(base, (7 * k + 10, f"p{k}"), (7 * k + 14, f"q{k}")) for k in range(18)]
    texts += ["the same short line\nmail a@b.example.com", "the same short line", "ü € 𝔘 line +1 (234) 555-0000"]
    return [(i, t, None if i % 7 == 0 else "en") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame([*rows, (None, "no id", None)], "doc_id long, text string, lang string")
    for name in ("kept", "digest", "row", "node", "sign", "score", "length", "rank", "base", "templates", "trusted"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def brute_components(rows, k=4, percent=85):
    def sets(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    s = {i: sets(t) for i, t, _ in rows}
    root = {i: i for i in s}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(s, 2):
        n = len(s[a] & s[b])
        if n and 100 * n >= percent * len(s[a] | s[b]):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: (len(s[i]), top(i)) for i in s}


@pytest.mark.parametrize("crowd", [(16, 256), (1, 4)])
@pytest.mark.parametrize("cuts", [None, [2.0, 8.0]])
def test_ngram_join_is_exact(spark, docs, rows, monkeypatch, crowd, cuts):
    monkeypatch.setattr(ngram_join, "CROWD_FROM", crowd[0])
    monkeypatch.setattr(ngram_join, "CROWD", crowd[1])
    if cuts:
        monkeypatch.setattr(ngram_join, "classes", lambda table: cuts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs).collect()}
    assert got.pop(None) == (1, None)
    assert got == brute_components(rows)


def test_ngram_join_empty(none):
    assert ngram_join.components(none).collect() == []


def test_signatures_share_one_for_every_linking_pair():
    rng = np.random.default_rng(1)
    often = {}
    for _ in range(300):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
        y = np.unique(np.r_[rng.permutation(x)[: max(1, int(len(x) * rng.uniform(0.85, 1)))], rng.integers(1, 2**63, int(rng.integers(0, 1 + n // 10))).astype(np.uint64)])
        for v in (*x, *y):
            often.setdefault(v, int(rng.integers(1, 60)))
        if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)):
            a, b = (ngram_join.signatures(s, np.array([often[v] for v in s]), 85, [10.0, 40.0]) for s in (x, y))
            assert any(len(np.intersect1d(p, q)) for p, q in zip(a, b))


@pytest.mark.parametrize("percent", [5, 30, 50, 80, 85, 95])
@pytest.mark.parametrize("kinds", [2, 3, 4])
def test_groups_leave_enough_of_every_set(percent, kinds):
    for size_class in range(4, 15):
        groups = ngram_join.group_counts(size_class, percent, kinds)
        if groups[0]:
            given_up = sum(int(groups[c]) * (c - 1) for c in range(2, kinds + 1))
            for n in (1 << size_class, (1 << size_class) + 1, 2 << size_class):
                assert n - given_up >= n - ngram_join.least_shared(n, percent) + 1


def test_signatures_of_frequent_sets_are_few():
    rng = np.random.default_rng(2)
    for n in (40, 150, 300, 1000, 5000):
        s = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
        rare, common = ngram_join.signatures(s, np.full(len(s), 1000), 85, [10.0])
        # two size classes at most, each near 1.3 signatures per shingle that may be lost
        assert len(rare) == 0 and len(common) <= 4 * (n - ngram_join.least_shared(n, 85) + 1)


@pytest.mark.parametrize("percent", [30, 60, 85])
@pytest.mark.parametrize("cuts", [[20.0], [10.0, 40.0]])
def test_signatures_are_shared_at_any_threshold(percent, cuts):
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(1, 2**63, int(rng.integers(20, 400))).astype(np.uint64)
        often = dict(zip(pool.tolist(), rng.integers(1, 80, len(pool)).tolist()))
        x, y = (np.unique(rng.choice(pool, int(len(pool) * rng.uniform(0.6, 3)))) for _ in "xy")
        if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
            a, b = (ngram_join.signatures(s, np.array([often[int(v)] for v in s]), percent, cuts) for s in (x, y))
            assert any(len(np.intersect1d(p, q)) for p, q in zip(a, b))


def test_parity_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 3000, dtype=np.int64).astype(np.uint64)
        x, y = (np.unique(rng.choice(pool[: rng.integers(1, 3000)], rng.integers(1, 2500))) for _ in "xy")
        apart = ngram_join.least_apart(ngram_join.parities(x), ngram_join.parities(y))
        assert apart <= len(np.setxor1d(x, y))
        assert ngram_join.least_apart(ngram_join.parities(x), ngram_join.parities(x)) == 0


def test_byte_words_are_the_words():
    w = ByteWords()
    for t in ("", "  ", "a b\tcc\n\x0b\x0c\rd ", " x", "\x1cy z q"):
        h = w.of(t.encode())
        words = re.findall(rb"[^\x20\x09-\x0D]+", t.encode())
        assert len(h) == len(words) and all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(h)) for j in range(len(h)))


def test_exact_dedup(spark, docs, rows):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    got = {r["doc_id"]: r for r in exact_dedup.dedup(docs, index).collect()}
    key = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t, _ in rows}
    for i, t, _ in rows:
        same = [(-len(u or ""), j) for j, u, _ in rows if key[j] == key[i]]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(same)[1], len(same), min(same)[1] == i)
        assert r["text_sha256"] == hashlib.sha256(key[i].encode()).hexdigest()
    again = exact_dedup.dedup(docs.unionByName(docs.limit(1).withColumn("text", F.lit("new"))), index)
    assert [r["group_size"] for r in again.where("kept").collect()] == [1]
    assert again.where("kept").first()["text_sha256"] == hashlib.sha256(b"new").hexdigest()


def test_exact_dedup_repeated_rows_and_empty(spark, none):
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab ")], "doc_id long, text string")
    got = exact_dedup.dedup(twice).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert sum(r["kept"] for r in got) == 1
    assert exact_dedup.dedup(none).collect() == []


def test_exact_dedup_index_outlives_a_session_and_a_failed_load(spark, tmp_path):
    path = str(tmp_path / "it's an index")
    schema = "doc_id long, text string"
    one = spark.createDataFrame([(i, f"text {i % 30}" + " " * (i % 7)) for i in range(200)] + [(None, "text 3"), (500, None)], schema)
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    first = rows(exact_dedup.dedup(one, index, "monday"))
    assert sum(r[3] for r in first) == 31
    # every part before the last stays behind as a failed load would leave it: the same load again keeps the same rows
    assert rows(exact_dedup.dedup(one, index, "monday")) == first
    later = spark.newSession()
    later.sql(f"DROP TABLE IF EXISTS {index.name}")  # a new session's catalog is empty; the folder is not
    again = exact_dedup.DigestIndex(later, path, buckets=64, parts=9)
    assert (again.buckets, again.parts) == (4, exact_dedup.PARTS)
    two = later.createDataFrame([(7, "text 3" + " " * 50), (8, "new"), (9, " new"), (10, "")], schema)
    got = {r["doc_id"]: r for r in exact_dedup.dedup(two, again, "tuesday").collect()}
    keeper = next(r[1] for r in first if r[4] == hashlib.sha256(b"text3").hexdigest())
    assert [(i, got[i]["keep_id"], got[i]["kept"], got[i]["group_size"]) for i in (7, 8, 9, 10)] == [
        (7, keeper, False, 1), (8, 9, False, 2), (9, 9, True, 2), (10, 500, False, 1)
    ]


def test_exact_dedup_joins_the_index_by_its_buckets(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    docs = spark.createDataFrame([(i, f"t {i % 9}") for i in range(60)], "doc_id long, text string")
    exact_dedup.dedup(docs, index, "a")
    held = index.entries()
    parts = {r["part"] for r in held.collect()}
    assert len(parts) > 1 and held.groupBy("digest").count().count() == 9
    plan = index.unseen(held.drop("load", "part"), "b", 0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("SelectedBucketsCount") >= 1 and plan.count("Exchange") <= 1
    whole = index.staying("a")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in whole


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t):
    out = []
    for rank, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum((lambda v: v - 9 if v > 9 else v)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(d))) % 10 == 0
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_pii_base_spans(spark):
    texts = [None, "", "a@b.c.", "x a@b.c-x%y@d.e 1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.4 0000.0.0.0", "4111 1111 1111 1111 4111-1111-1111-1112", "𝔘 +1 (234) 555-0000 1", "9" * 20_000, "a@b" + ".c" * 20_000, "1.2.3.4" * 3000, "12 34 5 " * 4000, "+1 2 3", "4111111111111111@x.y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit(1))
    got = {r["doc_id"]: r for r in pii.extracted(df).withColumn("b", pii.joined("base")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["b"] == ",".join(brute_spans(t)), i


def test_pii_emails_beside_each_other_and_in_long_runs(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("a.b-_@+ é\n"), int(rng.integers(0, 60)))) for _ in range(400)]
    texts += ["a@b.com_x@y.z", "a@b_c@d.e", "a@b.c@d.e@f.g", "x@y.z.a@b.c", "@a@b.c"]
    run = "aB9+" * 250_000  # 1 MB without an address
    texts += [run + " a@b.c " + run, run + "@b.c"]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["base"] if s["kind"] == "email"] for r in pii.extracted(df).collect()}
    for i, t in enumerate(texts[:-2]):
        assert got[i] == [m.span() for m in pattern.finditer(t)], t
    assert got[len(texts) - 2] == [(len(run) + 1, len(run) + 6)] and got[len(texts) - 1] == [(0, len(run) + 4)]


def test_pii_discovers_by_context(spark):
    known = [(i, f"ring phone: +1 (234) 555-{1000 + i} please") for i in range(12)]
    df = spark.createDataFrame([*known, (50, "ring phone: (555) 888-7777 please"), (51, "size 100 200 300 metres")], "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.extracted(df).collect()}
    assert got[50] == ["phone"] and got[51] == []
    assert pii.extracted(df.where("false")).collect() == []


def test_pii_discovered_instances_induce_patterns(spark):
    rows = [(i, f"ring phone: +1 (234) 555-{1000 + i}") for i in range(40)]
    rows += [(100 + i, f"phone: (555) 888-70{10 + i} extension") for i in range(6)]  # first step, by the word before
    rows += [(200, "or (555) 999-1234 extension"), (201, "(555) 999-4321 extension")]  # second step, by the word after
    rows += [(300, "phone: (555) 777-1234"), (301, "phone: (555) 777-4321 any"), (302, "(555) 777-4321")]  # one side; no side, known from 301
    rows += [(400, "size 100 200 300 metres"), (401, "(555) 666-0000")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.extracted(df).collect()}
    for i, text in rows[40:-2]:
        at = text.index("(")
        assert got[i] == [("phone", at, at + 14)], i
    assert got[400] == got[401] == []


def brute_tiles(a, b, least):
    used_a, used_b, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))
        out.append(n)


def test_greedy_tiles():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (rng.integers(0, 4, int(rng.integers(0, 30))).astype(np.uint64) for _ in "ab")
        assert [n for *_, n in decontaminate.greedy_tiles(a, b, 3)] == brute_tiles(list(a), list(b), 3)
        assert all(np.array_equal(a[i : i + n], b[j : j + n]) for i, j, n in decontaminate.greedy_tiles(a, b, 3))


def test_decontamination(spark, docs, none):
    item = WORDS[200:240]
    moved = item[20:] + ["between"] + item[:20]
    extra = spark.createDataFrame([(900, "Start " + " ".join(item).upper() + ", end"), (901, " ".join(moved)), (902, " ".join(item[:20]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (None, "x"), (4, " ".join(item))], "item_id long, text string")
    got = decontaminate.contaminated(docs.select("doc_id", "text").unionByName(extra), bench).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == {900: [1, 4], 901: [1, 4]}
    assert decontaminate.contaminated(none, bench).collect() == []
    assert decontaminate.contaminated(docs, bench.where("false")).collect() == []


@pytest.mark.parametrize("often", [16, 2])
def test_decontamination_is_exact(spark, monkeypatch, often):
    """All documents x all items by brute force: reordered, thinned, mixed and unrelated ones, items with a phrase in common."""
    monkeypatch.setattr(decontaminate, "OFTEN", often)
    rng = np.random.default_rng(8)
    phrase = ["which", "of", "the", "following", "is"]
    items = [[*phrase, *rng.choice(WORDS, int(rng.integers(3, 45)))] for _ in range(12)] + [list(rng.choice(WORDS[:6], 20)), WORDS[:3], WORDS[:4], WORDS[:2]]
    items.append(items[0])
    texts = [None, "", " ".join(phrase), LONG]
    for item in items:
        for size in (3, 4, 5, 9):  # reordered in pieces
            cut = [item[i : i + size] for i in range(0, len(item), size)]
            texts.append(" ".join(w for k in rng.permutation(len(cut)) for w in [*cut[k], "between"]))
        for share in (0.5, 0.1):  # words replaced
            texts.append(" ".join(w if rng.random() > share else "other" for w in item))
    texts += [" ".join(rng.choice(WORDS[:6], 60)) for _ in range(5)]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[4]), (None, texts[4])], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string").withColumn("seed", F.lit("clash"))
    want = {}
    for i, t in [*enumerate(texts[:3]), *list(enumerate(texts))[4:], (3, texts[4])]:
        words = re.findall(r"\w+", (t or "").lower())
        for k, item in enumerate(items):
            if 10 * sum(brute_tiles(words, item, 3)) >= 8 * len(item):
                want.setdefault(i, set()).add(k)
    got = {r["doc_id"]: set(r["item_ids"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == want and len(got) > 30


def test_decontamination_finds_an_item_in_pieces_of_four(spark):
    item = WORDS[:40]
    cut = [item[i : i + 4] for i in range(0, 40, 4)]
    docs = spark.createDataFrame([(1, " ".join(w for c in reversed(cut) for w in c)), (2, "nothing of it")], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_ids"], r["coverage"], r["tiles"]) for r in got] == [(1, [7], 1.0, 10)]


def test_warc_round_trip(spark):
    big = "<p>ü\r\n\r\nWARC/1.1\r\n</p>" * 100
    pages = [(1, "http://www.B.example/x#y", big), (5, "https://a.example/?q", big), (3, None, None), (4, "bad\r\nurl", "small"), (6, "u", "small"), (None, "v", big), (7, "z", "x" * 999), (8, "z", "x" * 999)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    from netsift.llm.common import shared_path

    path = shared_path(spark, "test")
    warc.write_archives(df, path)
    out = warc.merged_index(warc.read_archives(spark, path)).collect()
    got = {r["page_id"]: r for r in out}
    assert len(out) == len(pages) and [r["url_key"] for r in out] == sorted(r["url_key"] for r in out)
    for i, _, html in pages:
        body = (html or "").encode()
        revisit = i == 1
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 5) if revisit else ("response", None))
    empty = shared_path(spark, "test")
    warc.write_archives(df.where("false"), empty)
    assert warc.merged_index(warc.read_archives(spark, empty)).collect() == []


def test_warc_repeated_page_ids_keep_their_own_payloads(spark):
    a, b, c = ("a" * 1000, "b" * 1000, "c" * 1000)
    pages = [(1, "u", a), (1, "u", b), (1, "u", c), (2, "v", a), (3, "w", b), (1, "x", a)]
    from netsift.llm.common import shared_path

    path = shared_path(spark, "test")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    got = [(r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, path).collect()]
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = [(1, sha(a), "revisit", 2)] * 2 + [(1, sha(b), "revisit", 3), (1, sha(c), "response", None), (2, sha(a), "response", None), (3, sha(b), "response", None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_warc_reads_every_gzip_member():
    import gzip

    parts = [b"one" * 50, b"", b"two" * 7]
    assert warc.unzipped(b"".join(map(gzip.compress, parts)) + b"\0\0") == b"".join(parts) and warc.unzipped(b"") == b""
    with pytest.raises(ValueError):
        warc.unzipped(gzip.compress(parts[0])[:-9])


def test_loser_tree():
    rng = np.random.default_rng(3)
    for k in range(7):
        runs = [sorted(rng.integers(0, 9, int(rng.integers(0, 6))).tolist()) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(itertools.chain(*runs))


def test_line_dedup(spark, none):
    shared = "Visit our shop number 17 today"
    texts = {i: f"own line {'abcdefghij'[i]} of {'qrstuvwxyz'[i]}\n{shared.replace('17', str(i))}" for i in range(6)}
    df = spark.createDataFrame([*texts.items(), (10, None), (11, "a b"), (None, shared)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.cleaned(df).collect()}
    assert all(got[i]["text"] == texts[i].split("\n")[0] and got[i]["n_dropped"] == 1 for i in texts)
    assert (got[10]["text"], got[10]["n_lines"], got[11]["text"], got[None]["text"]) == ("", 1, "a b", "")  # a row without an id loses what recurs too
    assert line_dedup.cleaned(none).collect() == []


@pytest.mark.parametrize("size", [32 << 20, 0])  # the recurring set is broadcast, or joined
def test_line_dedup_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(line_dedup, "SET_BYTES", size)
    rng = np.random.default_rng(6)
    word = lambda: str(rng.choice(["alpha", "beta", "Gamma", "x1", "7", "the", "é"]))
    pool = [" ".join(word() for _ in range(rng.integers(0, 12))) for _ in range(40)]
    texts = ["\n".join(str(rng.choice(pool)) + (" tail" if rng.random() < 0.5 else "") for _ in range(rng.integers(0, 7))) for _ in range(60)]
    texts += [None, "", "\n\n", "\n".join(f"long line of text {chr(97 + i % 26)} {'yz'[i % 2] * (i % 50)}" for i in range(60_000)), texts[0]]
    ids = [None if i % 13 == 5 else i // 2 for i in range(len(texts))]
    df = spark.createDataFrame([*zip(ids, texts)], "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("templates", F.lit("a"))

    def leaf(x):  # every template as a tuple
        words = ["<*>" if any(c in "0123456789" for c in w) else w for w in x.lower().split()]
        if len(words) < 3:
            return []
        rest = words[2:]
        cut = [len(rest) * k // 3 for k in range(4)]
        wild = [(k, *rest[: cut[k]], "<*>", *rest[cut[k + 1] :], cut[k + 1] - cut[k]) for k in range(3)] if len(words) >= 8 else []
        return [(len(words), *words[:2], None, *x) for x in [tuple(rest), *wild]]

    held = collections.Counter(h for t in texts for h in {h for x in (t or "").split("\n") for h in leaf(x)})
    want = []
    for i, t in zip(ids, texts):
        lines = (t or "").split("\n")
        stay = [x for x in lines if not any(held[h] >= 5 for h in leaf(x))]
        want.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    got = [tuple(r) for r in line_dedup.cleaned(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(0 < w[2] < w[1] for w in want)


def test_toxicity_learns_each_id_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda toxic, ordinary, prior: seen.append((toxic, ordinary, prior)) or {"constant": prior})
    rows = [(i, f"text {i}") for i in range(8)] + [(0, "another")] * 50 + [(0, "text 0")]
    labels = [(i, i % 2) for i in range(8)] + [(1, 0), (3, 1), (3, 1), (4, None)]
    toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), per_class=3)
    learnt = [i for i in range(8) if zlib.crc32(str(i).encode()) % 4 != 2 and i != 1]
    toxic, ordinary, prior = seen[0]
    every = {v: {f"text {i}" if i else "another" for i in learnt if i % 2 == v} for v in (0, 1)}
    assert set(toxic) <= every[1] and set(ordinary) <= every[0]
    assert [len(toxic), len(ordinary)] == [min(3, len(every[v])) for v in (1, 0)]
    assert prior == pytest.approx(len(every[1]) / len(learnt))


def test_packing(spark, docs, rows, none):
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = packing.pack(docs.where("doc_id is not null"), size=64, with_ids=True).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in parts:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text, _ in rows:
        p = sorted(by_doc[i], key=lambda r: r["piece"])
        assert sum((r["ids"] for r in p), []) == [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert all(r["length"] == 64 for r in p[1:]) and [r["start"] for r in p] == [sum(x["length"] for x in p[:k]) for k in range(len(p))]
    for p in by_sequence.values():
        p.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in p] == [sum(x["length"] for x in p[:k]) for k in range(len(p))] and sum(r["length"] for r in p) <= 64
    assert packing.pack(none).collect() == []


def test_encoder_equals_tokenizers():
    e = packing.Encoder()
    for text in ("", "a  b\n\n c", "it's ÄÖ ñ", "<|endoftext|> x", "漢字 and ж", "x" * 3000, " " * 3000 + "y", "tab\t\t1234567", "nbsp  x­"):
        assert e.ids(text) == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_plan_covers_every_rank():
    rng = np.random.default_rng(4)
    counts = {int(k): int(n) for k, n in zip(rng.integers(1, 65, 40), rng.integers(1, 500, 40))}
    slots, used = packing.plan(counts, 64), collections.Counter()
    for length in counts:
        mine = sorted(s for s in slots if s[0] == length)
        assert [s[1] for s in mine] == list(np.cumsum([0, *(s[2] for s in mine)])[:-1]) and sum(s[2] for s in mine) == counts[length]
    for length, _, n, first, offset in slots:
        for q in range(first, first + n):
            assert used[q] == offset
            used[q] += length
    # best-fit decreasing needs at most 11/9 of the optimum, which is at least either of these
    least = max(sum(k * n for k, n in counts.items()) / 64, sum(n for k, n in counts.items() if k > 32))
    assert max(used.values()) <= 64 and len(used) <= 11 / 9 * least + 1


def test_toxicity_held_out(spark, sf_small, docs, none):
    sf = sf_small.replace("sf0.001", "sf0.01")
    data, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = toxicity.fit(data, labels)
    p = toxicity.score(data, model).join(labels, "doc_id").where("held_out").toPandas()
    y, rank = p["toxic"].to_numpy(), p["score"].rank().to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.7  # 15 toxic training texts or so
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(none, model).collect() == []
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).collect()} == {0.0}


def brute_roles(lines, model):
    """Score of the best path by dictionaries, and the score of any path; ``lines`` are (number, opens its row)."""
    start, move, show, quiet = model

    def shown(state, line):
        if line[1]:
            return show[state, line[0]] if state < 3 else -np.inf
        return show[state, line[0]] + (quiet if state < 3 and line[0] < 40 else 0)

    best = {s: start[s] + shown(s, lines[0]) for s in range(6)}
    for line in lines[1:]:
        best = {s: max(best[b] + move[b, s] for b in range(6)) + shown(s, line) for s in range(6)}
    path = lambda x: start[x[0]] + shown(x[0], lines[0]) + sum(move[a, b] + shown(b, q) for a, b, q in zip(x, x[1:], lines[1:]))
    return max(best.values()), path


CHAT = "conv_id long, turn long, role string, text string"


def chat_rows():
    rng = np.random.default_rng(9)
    line = lambda: rng.choice(["", "why?", "- a list", "x = 1;", "prose of some words", "User: hello", "Bot: hi there", "System: be kind"])
    rows = [(c, t, str(rng.choice(["user", "assistant"])), "\n".join(line() for _ in range(rng.integers(1, 6)))) for c in range(12) for t in range(int(rng.integers(1, 14)))]
    rows += [(50, None, "user", f"null turn {i}") for i in range(20)] + [(50, 5, "assistant", f"one turn {i}\nmore") for i in range(20)]
    rows += [(50, 6, "user", "\n".join(f"long {i}" for i in range(23))), (51, 0, "user", "Hi"), (51, 0, "user", "Hi"), (51, 0, "judge", None), (None, None, None, "x"), (None, 0, "user", "")]
    return rows


@pytest.mark.parametrize("labelled", [True, False])
def test_chat_equals_viterbi_whatever_the_blocks(spark, monkeypatch, labelled):
    rows = chat_rows()
    df = spark.createDataFrame(rows, CHAT).withColumn("block", F.lit("x")).withColumn("lines", F.lit(1)).withColumn("row", F.lit(None))
    df = df if labelled else df.withColumn("role", F.lit(None).cast("string"))
    placed = chat.ordered(chat.transcript_rows(df))
    model, got = chat.fit(placed), {}
    for size, fan, slab in ((64, 64, 1 << 18), (3, 2, 7), (1, 3, 1)):
        for name, value in (("BLOCK_TURNS", size), ("FAN", fan), ("SLAB", slab)):
            monkeypatch.setattr(chat, name, value)
        out = chat.format_turns(df, model).collect()
        got[size] = sorted((tuple(r) for r in out), key=lambda r: (str(r[0]), r[1], r[2]))
    assert got[64] == got[3] == got[1]
    assert sum(r[4] for r in got[64]) == sum((t or "").count("\n") + 1 for *_, t in rows)
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    placed = chat.ordered(chat.transcript_rows(df))
    found = chat.recovered(placed, model).join(placed, "row").orderBy("place").collect()
    for conv in {r[0] for r in rows}:
        mine = [r for r in found if r["conv_id"] == conv]
        lines = [(q, k == 0) for r in mine for k, q in enumerate(r["seen"])]
        best, path = brute_roles(lines, model)
        assert path([s for r in mine for s in r["states"]]) == pytest.approx(best, abs=1e-4 * len(lines) + 1e-6), conv


def test_chat_takes_a_pasted_transcript_apart(spark):
    pasted = "System: be brief\nUser: what is it?\nsecond line\nAssistant: a thing\n\nHuman: thanks"
    rows = [(i, t, ["user", "assistant"][t % 2], f"words {i}\nand more words") for i in range(40) for t in range(4)] + [(99, 0, None, pasted), (98, 0, None, "plain\n" * 30 + "end")]
    out = chat.format_turns(spark.createDataFrame(rows, CHAT)).where("conv_id >= 98").orderBy("conv_id", "part").collect()
    assert out[0]["n_lines"] == 31  # without markers a text is one turn, of whichever role
    assert [(r["role"], r["n_lines"]) for r in out[1:]] == [("system", 1), ("user", 2), ("assistant", 2), ("user", 1)]
    assert [r["rendered"] for r in out[1:]] == [
        "<|system|>\nbe brief<|end|>", "<|user|>\nwhat is it?\nsecond line<|end|>", "<|assistant|>\na thing\n<|end|>", "<|user|>\nthanks<|end|>"
    ]


def test_chat_recovers_roles_of_unseen_conversations(spark, sf_small):
    turns = read(spark, sf_small.replace("sf0.001", "sf0.01"), "conversations")
    held = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)) == 2
    out = chat.format_turns(turns).collect()
    seen = [r for r in out if r["held_out"] and r["part"] == 0 and r["labelled"] in ("user", "assistant")]
    assert len(seen) > 100 and np.mean([r["role"] == r["labelled"] for r in seen]) > 0.8
    # roles of held-out rows change nothing
    blind = chat.format_turns(turns.withColumn("role", F.when(held, "system").otherwise(F.col("role")))).drop("labelled").collect()
    key = lambda r: (r["conv_id"], r["place"], r["part"], r["role"], r["rendered"])
    assert sorted(map(key, blind)) == sorted(map(key, out))


def test_chat_empty_and_very_long(spark):
    assert chat.format_turns(spark.createDataFrame([], CHAT)).collect() == []
    out = chat.format_turns(spark.createDataFrame([(1, 0, "user", "a line\n" * 50_000), (1, 1, "assistant", "x" * 1_000_000)], CHAT)).collect()
    assert sum(r["n_lines"] for r in out) == 50_002 and max(len(r["rendered"]) for r in out) > 1_000_000


def brute_kneser_ney(trusted, text):
    """The same model by dictionaries."""
    levels = {4: collections.Counter(g for t in trusted for g in quality.grams(t).tolist())}
    for o in (3, 2, 1):
        levels[o] = collections.Counter(g & quality.LOW[o] for g in levels[o + 1])
    tables = {}
    for o, c in levels.items():
        n1, n2, n3, n4 = (max(1, sum(v == k for v in c.values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(x, 0.05), k - 0.05) for k, x in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
        total, weight = collections.Counter(), collections.Counter()
        for g, n in c.items():
            total[g >> 16] += n
            weight[g >> 16] += d[min(n, 3) - 1]
        tables[o] = (c, d, total, weight)

    def p(g, o):
        if o == 0:
            return 1 / (len(levels[1]) + 1)
        c, d, total, weight = tables[o]
        own = g if o == 4 else g & quality.LOW[o]
        if (own >> 16) not in total:
            return p(g, o - 1)
        n = c.get(own, 0)
        return ((n - d[min(n, 3) - 1] if n else 0) + weight[own >> 16] * p(g, o - 1)) / total[own >> 16]

    g = quality.grams(text).tolist()
    return float(np.exp(-np.mean([np.log(p(x, 4)) for x in g])))


def test_quality_is_kneser_ney(spark, docs, none, monkeypatch):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the cat sat on the mat", "xqzk 漢字 𝔘", None]
    df = spark.createDataFrame([(i, t, None if i == 5 else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 1), (2, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    for size in (64 << 20, 2048):  # one shard, several shards
        monkeypatch.setattr(quality, "SHARD_BYTES", size)
        got = {r["doc_id"]: r["perplexity"] for r in quality.judged(df, labels).collect()}
        for i, t in enumerate(texts):
            assert got[i] == pytest.approx(brute_kneser_ney(texts[:3], t or ""), rel=1e-6)
    assert all(r["kept"] for r in quality.judged(docs, labels.where("false")).collect())
    assert quality.judged(none, labels).collect() == []


@pytest.mark.parametrize("size", [64 << 20, 512])  # one shard, several shards
def test_quality_scores_rows_with_null_and_repeated_ids_by_their_own_text(spark, monkeypatch, size):
    monkeypatch.setattr(quality, "SHARD_BYTES", size)
    good = ["the cat sat on the mat", "the dog sat on the log"]
    rows = [(i, t, "en") for i, t in enumerate(good)]
    rows += [(i, t, lang) for i in (None, 7) for lang in ("en", None) for t in ("the cat sat on the log", "xq zk vjw qqq zzz kkkk", "the dog sat on the mat")]
    rows += [(None, "xq zk vjw qqq zzz kkkk", "en")] * 2 + [(None, None, "en"), (None, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    order = lambda x: sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))
    got = order((r["doc_id"], r["lang"], r["perplexity"], r["kept"]) for r in quality.judged(df, labels).collect())
    limit = quality.SLACK * max(brute_kneser_ney(good, t) for t in good)
    want = order((i, lang, p, p <= limit) for i, t, lang in rows for p in [brute_kneser_ney(good, t or "")])
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want], rel=1e-6)
    assert {r[3] for r in got} == {True, False}


def test_quality_holds_one_shard_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_BYTES", 256)
    held, most = [], []
    share, drop = type(spark.sparkContext).broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: held.append(b := share(self, x)) or most.append(len(held)) or b)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a, **k: held.remove(self) or drop(self, *a, **k))
    df = spark.createDataFrame([(i, f"the cat {i} sat on the mat of the dog", "en") for i in range(3)], "doc_id long, text string, lang string")
    got = quality.judged(df, spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")).collect()
    assert len(got) == 3 and len(most) > 1 and max(most) == 1 and held == []


def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline as c

    docs = read(spark, sf_small, "documents").withColumn("kept", F.lit(1))
    left = docs
    for name, stage in c.STAGES[:-1]:
        after = stage(spark, left, sf_small)
        assert after.columns == docs.columns and after.count() <= left.count()
        left = after
    ids = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert ids and {r["doc_id"] for r in c.pack(spark, left, sf_small).collect()} == ids
    again = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in c.drop_copies(spark, again, sf_small).collect()) in ([1, 3], [2, 3])
