"""Near copies against brute force."""

import random

import corpus_pipeline as cp
from leadloom.llm import near_copies


def shingles(text):
    w = (text or "").split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_kept(rows):
    root = {k: k for k, _ in rows}
    sets = {k: shingles(t) for k, t in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in root:
        for b in root:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9):
                a_, b_ = sorted((top(a), top(b)))
                root[b_] = a_
    return sorted(k for k in root if root[k] == k)


def test_stage_drops_near_copies(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randint(0, 5000)
    rows = [(900, None), (901, ""), (902, "a b c d"), (903, "a b c d")]
    for g in range(12):
        base = [word() for _ in range(rng.randint(100, 250))]
        for k in range(6):
            t = list(base)
            for _ in range(rng.choice([1, 2, 3, 4, 5])):  # most at 0.8 to 0.95, far more than three bits
                t[rng.randrange(len(t))] = word()
            rows.append((g * 10 + k, " ".join(t)))
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for block in (300_000, 400):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        assert sorted(r["doc_id"] for r in cp.keep_one_of_near_copies(spark, df, "").collect()) == brute_kept(rows)
    assert cp.keep_one_of_near_copies(spark, df.limit(0), "").count() == 0
