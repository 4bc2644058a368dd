"""Toxic texts are found whatever their kind: whole words that only they hold, or stems that ordinary words hold too."""

import numpy as np

import corpus_pipeline
from netsift.llm import toxicity

SYLLABLES = [c + v for c in "bdfgklmnprst" for v in ("a", "e", "i", "o", "u")]
WHOLE, STEMS = ["wretch", "vermin", "rotten", "lunatic", "filthy", "swine"], ["dakolu", "tapibe"]


def made(n=1200, seed=3):
    """Texts of two kinds (the second: three of 20), and whether each is toxic."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(SYLLABLES, rng.integers(1, 5)))
    rows = []
    for i in range(n):
        toxic, second = bool(rng.random() < 0.12), bool(rng.random() < 0.15)
        words = [word() for _ in range(rng.integers(60, 200))]
        # now and then a stem stands within an ordinary word
        words += [word() + str(rng.choice(STEMS)) + word() for _ in range(rng.integers(0, 2))]
        if toxic:
            words += [str(rng.choice(STEMS)) + word() if second else str(rng.choice(WHOLE)) for _ in range(rng.integers(3, 7))]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic), second))
    return rows


def test_segments_stand_within_words_and_cover_every_kind():
    rows = made()
    found = toxicity.contrast_segments([r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]])
    assert all(b" " not in s[1:-1] for s in found)
    for w in WHOLE + STEMS:
        assert any(s.strip() in w.encode() or s.strip().startswith(w.encode()) for s in found), w
    assert toxicity.contrast_segments(["", "a"], ["b"]) == []


def test_contrast_counts_texts():
    got = toxicity.contrast(np.array([0, 10, 10, 50]), np.array([10, 10, 0, 0]), 100, 100)
    assert got[0] == got[1] == 0 and 3 < got[2] < got[3]


def test_counting_in_parts_changes_nothing(monkeypatch):
    rows = made(300)
    texts = [r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]]
    whole = toxicity.contrast_segments(*texts)
    monkeypatch.setattr(toxicity, "PAIRS", 50)
    assert toxicity.contrast_segments(*texts) == whole


def test_the_pipeline_drops_toxic_texts_of_every_kind(spark, tmp_path):
    rows = made()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    held = {r["doc_id"] for r in docs.where(toxicity.held_out()).collect()}
    part = lambda toxic, second: [i for i, _, t, s in rows if i in held and t == toxic and s == second]
    for second in (False, True):
        bad, good = part(1, second), part(0, second)
        assert sum(i not in kept for i in bad) >= 0.9 * len(bad) > 3, second
        assert sum(i in kept for i in good) >= 0.95 * len(good)
