"""Near-duplicates, line and span removal, and searches against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from leadloom.llm import hamming_topk, hilbert_ann, line_dedup, simhash, suffix_dedup
from leadloom.llm.superwords import SuperWords


def brute_fingerprint(t, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in ([" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else []))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, monkeypatch):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ÀB\n\x0b ") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    rows = [(k, rng.choice(base) + rng.choice(["", "", " x", "!"])) for k in range(300)] + [(900, None), (901, ""), (902, " \t"), (7, base[0]), (7, base[0])]
    for most in (2048, 3):
        monkeypatch.setattr(simhash, "MOST", most)
        df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, root int")
        fp = [(i, brute_fingerprint(t or "")) for i, t in rows]
        parent = {f: f for _, f in fp}

        def find(f):
            while parent[f] != f:
                f = parent[f]
            return f

        every = sorted(parent)
        for a in every:
            for b in every:
                if bin(a ^ b).count("1") <= 3 and find(a) != find(b):
                    parent[find(a)] = find(b)
        least = {}
        for i, f in fp:
            least[find(f)] = min(least.get(find(f), i), i)
        want = sorted((i, f, least[find(f)]) for i, f in fp)
        got = sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.simhash_components(df).collect())
        assert got == want
    assert simhash.near_duplicate_documents(df, shingle=3).count() == len(least)
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_anchors_cover(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        pairs.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", simhash.anchors_of(df["a"]).alias("x"), simhash.anchors_of(df["b"]).alias("y")).collect():
        homes = {int(simhash.home_anchors(np.array([r["a"]], np.int64).view(np.uint64), half)[0]) for half in (0, 1)}
        assert homes <= set(r["x"]) and homes & set(r["y"])


def brute_spans(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), len(b) - len(left), sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("most", [8192, 1])
def test_spans(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rng = random.Random(5)
    for letters in ("ab", "abcdefghij", "é a"):
        base = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 200))) for _ in range(6)]
        texts = [None, "", "x" * 100, "x" * 100, "yz" * 40, *base, base[0], base[1] + base[2], base[3][10:] + "q", base[4][:60], base[5], base[5], base[5]]
        rows = [(k if k != 3 else None, t, "e") for k, t in enumerate(texts)] + [(99, base[0], "dup")] * 2
        df = spark.createDataFrame(rows, "doc_id long, text string, key string")
        assert sorted(tuple(r) for r in suffix_dedup.remove_repeats(df, span=20, q=6).select("repeats.*").collect()) == brute_spans([t for _, t, _ in rows], 20)
    assert suffix_dedup.remove_repeats(df.limit(0), span=20, q=6).count() == 0


def test_refinement_and_runs():
    rng = random.Random(6)
    for _ in range(60):
        span = rng.choice([9, 12, 17, 40, 70, 130])
        base = [bytes(rng.choices(b"abc", k=rng.randint(1, 200))) for _ in range(4)]
        t = b"".join(rng.choice(base) for _ in range(8))
        valid = np.array([rng.random() < 0.8 for _ in t])
        valid[max(0, len(t) - span + 1) :] = False
        seen = Counter(t[i : i + span] for i in np.flatnonzero(valid))
        assert list(suffix_dedup.repeated_windows(np.frombuffer(t, np.uint8), valid, span)) == [bool(valid[i]) and seen[t[i : i + span]] > 1 for i in range(len(t))]
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 300))) for _ in range(20)]
    got = Counter((k, a + j) for r in SuperWords(40, 8).runs(texts) for k, a, n in zip(r.text.tolist(), (r.start + r.shift).tolist(), r.windows.tolist(), strict=True) for j in range(n))
    assert got == Counter((k, i) for k, t in enumerate(texts) for i in range(len(t) - 39))


def brute_lines(rows, share=0.8):
    lines = sorted((i is not None, i or 0, k, p, frozenset(x.lower().split())) for k, (i, t) in enumerate(rows) for p, x in enumerate((t or "").split("\n")) if x.split())
    gone = {}
    for n, (_, _, k, p, s) in enumerate(lines):
        if any(len(s & o[4]) >= share * len(s | o[4]) - 1e-9 for o in lines[:n]):
            gone.setdefault(k, set()).add(p)
    return {i: "\n".join(x for p, x in enumerate((t or "").split("\n")) if p not in gone.get(k, ())) for k, (i, t) in enumerate(rows)}


def test_lines(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 14))] for _ in range(30)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            x[rng.randrange(len(x))] = rng.choice(words)
        return " ".join(x)

    rows = [(i, "\n".join(rng.choice([line, line, line, str, lambda: "  "])() for _ in range(rng.randint(1, 6)))) for i in range(80)] + [(None, line()), (200, None), (201, ""), (202, "A  B\tc D e\n\n")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, text string, h string, place string, order int")
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()} == brute_lines(rows)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 8)) + rng.integers(0, 3, size=(700, 1)) * 4
    x[300:340] = x[300]
    rows = [(k, [float(np.float32(v)) for v in r]) for k, r in enumerate(x)] + [(700, None), (800, [0.0] * 8), (900, [float("nan")] * 8), (1000, [1.0] * 7 + [None]), (1001, [1.0] * 3)]
    return spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<float>, own string"), np.array([r[1] for r in rows[:700]])


def test_curves(vectors):
    df, x = vectors
    got = hilbert_ann.nearest_by_curves(df, query_step=100, curves=6, window_share=0.1).toPandas()
    hit = 0
    for q in range(0, 700, 100):
        gap = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((np.arange(700), gap)) if k != q][:10]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and np.allclose(own.score, gap[own.vec_id], atol=0, rtol=1e-12) and own.score.is_monotonic_increasing
        hit += len(set(own.vec_id) & set(want))
        if q == 300:
            assert list(own.vec_id) == list(range(301, 311))
    assert hit >= 63 and set(got.query_id) == set(range(0, 700, 100))
    assert hilbert_ann.nearest_by_curves(df.limit(0)).count() == 0


def test_hilbert_is_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = hilbert_ann.hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_top_k(vectors):
    df, x = vectors
    codes = (x > 0).astype(int)
    got = hamming_topk.hamming_top_k(hamming_topk.embedding_codes(df.where("vec_id < 700"))).toPandas()
    for q in range(0, 700, 100):
        gap = (codes != codes[q]).sum(axis=1)
        want = [k for k in np.lexsort((np.arange(700), gap)) if k != q][:10]
        assert list(got[got.query_id == q].sort_values("rank").vec_id) == want
