"""Nulls, repeats, empty tables, clashing names and large buckets of the operators, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import common, hamming_topk, hilbert_ann, packing, suffix_dedup, token_counts, toxicity

SF = "/root/testdata/sf0.01"


def odd_vectors(d, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(float)
    x[5] = x[6] = x[7]  # ties
    rows = [(k, x[k].tolist()) for k in range(n)]
    rows += [(n, None), (n + 100, [0.0] * d), (n + 200, [float("nan")] + [1.0] * (d - 1)), (n + 300, [None] + [1.0] * (d - 1)), (n + 1, [float("inf")] * d), (None, x[0].tolist()), rows[0], rows[100]]
    return rows, x


@pytest.mark.parametrize("d, n", [(64, 400), (130, 300), (20, 150)])
def test_top_k_of_codes_of_any_length(spark, d, n):
    rows, x = odd_vectors(d, n, 4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"code": F.lit("x"), "query_id": F.lit(1), "id": F.lit(0)})
    got = {}
    for r in hamming_topk.hamming_top_k(hamming_topk.embedding_codes(df)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["distance"]))
    codes = x > 0
    assert set(got) == set(range(0, n, 100))
    for q, found in got.items():
        gap = (codes != codes[q]).sum(axis=1)
        want = [k for k in np.lexsort((np.arange(n), gap)) if k != q][:10]
        assert sorted(found) == [(i + 1, k, gap[k]) for i, k in enumerate(want)]
    assert hamming_topk.hamming_top_k(hamming_topk.embedding_codes(df.limit(0))).count() == 0


def test_few_codes(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0]), (2, [1.0, -2.0])], "vec_id long, embedding array<double>")
    got = hamming_topk.hamming_top_k(hamming_topk.embedding_codes(df)).collect()
    assert [(r["rank"], r["vec_id"], r["distance"]) for r in sorted(got)] == [(1, 2, 0), (2, 1, 1)]


def test_queries_of_a_block_are_dealt_into_parts(spark, monkeypatch):
    """All queries meet one block; with parts of three queries the result is the same."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(100 * k, rng.normal(size=8).tolist()) for k in range(90)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, hilbert_ann.nearest_by_curves(df, target=1.0).collect()))
    monkeypatch.setattr(hilbert_ann, "ASKED", 3)
    assert sorted(map(tuple, hilbert_ann.nearest_by_curves(df, target=1.0).collect())) == want and len(want) == 900


def test_neighbours_of_odd_vectors(spark):
    rows, x = odd_vectors(16, 300, 5)
    rows += [(1000 + k, [float(k + 1), 1.0]) for k in range(12)]  # a length of their own
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit("x"), "own": F.lit(1)})
    got = hilbert_ann.nearest_by_curves(df, target=1.0).toPandas()
    assert set(got.query_id) == {0, 100, 200, 1000}
    assert list(got[got.query_id == 1000].sort_values("rank").vec_id) == list(range(1001, 1011))
    hit = 0
    for q in (0, 100, 200):
        gap = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and np.allclose(own.score, gap[own.vec_id], atol=0, rtol=1e-12)
        hit += len(set(own.vec_id) & {k for k in np.argsort(gap, kind="stable") if k != q and k in set(np.argsort(gap)[:11])})
    assert hit >= 27


def test_recall_on_the_given_table(spark):
    """At least 0.9 of the true neighbours. The given vectors fill all their dimensions, so this takes a large window."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    x, ids = np.stack(rows.embedding.to_numpy()).astype(float), rows.vec_id.to_numpy()
    got = hilbert_ann.nearest_by_curves(df).toPandas()
    hit = n = 0
    for q in np.flatnonzero(ids % 100 == 0):
        gap = ((x - x[q]) ** 2).sum(axis=1)
        gap[q] = np.inf
        want = set(ids[np.lexsort((ids, gap))[:10]])
        hit, n = hit + len(want & set(got[got.query_id == ids[q]].vec_id)), n + 10
    assert hit >= 0.9 * n


@pytest.mark.parametrize("most", [8192, 3])
def test_spans_of_large_and_hot_buckets(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rng = random.Random(8)
    common_part = "".join(rng.choice("abcdefgh ") for _ in range(90))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60))) + common_part[rng.randint(0, 20) : rng.randint(60, 90)] + "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [common_part] * 30 + [texts[0], "", None]
    span = 40
    starts = {}
    for k, t in enumerate(texts):
        b = (t or "").encode()
        for i in range(len(b) - span + 1):
            starts.setdefault(b[i : i + span], []).append((k, i))
    gone = [set() for _ in texts]
    for at in starts.values():
        if len(at) > 1:
            for k, i in at:
                gone[k].update(range(i, i + span))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["repeats"]["kept_text"] for r in suffix_dedup.remove_repeats(df, span, 8, keep_text=True).collect()}
    assert got == {k: "".join(c for i, c in enumerate(t or "") if i not in gone[k]) for k, t in enumerate(texts)}


def test_spread_join(spark):
    a = spark.createDataFrame([(k % 3 if k < 90 else k, k) for k in range(120)], "k long, v long")
    b = spark.createDataFrame([(k, str(k)) for k in (0, 1, 100, 5)], "k long, w string")
    hot = spark.createDataFrame([(0,), (5,)], "k long")
    for how in ("inner", "left_semi"):
        assert sorted(map(tuple, common.spread_join(a, b, ["k"], hot, ["v"], how).collect())) == sorted(map(tuple, a.join(b, "k", how).collect()))


def test_packing_and_counts_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "b a"), (2, None), (3, "")], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("piece", "length", "sequence_id", "offset", "ids_crc32", "n_tokens", "n_bytes")})
    got = packing.pack_documents(df).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == [(1, 3), (1, 3), (2, 1), (3, 1)]
    assert packing.pack_documents(df.limit(0)).count() == 0 and token_counts.count_tokens(df.limit(0)).count() == 0
    assert sorted((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(df).collect()) == [(1, 2), (1, 2), (2, 0), (3, 0)]


def test_equal_insults_quoted_and_not(spark):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(d, labels)
    reader = toxicity.Reader(model.weights)
    say = lambda t: model.score(reader.hits(t))
    insult = "you idiot and moron, worthless scum"
    far = " kind" * 400
    assert say(f'they shouted "{insult}{far}"') < say(f"they shouted {insult}{far}")
    assert say(f"he said {insult}") < say(f"he shouts {insult}")
    assert say("") == say("a kind day") < 0.5 < say(insult)
