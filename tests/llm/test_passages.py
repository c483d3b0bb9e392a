"""Passages that repeat across documents, counted in words."""

import random

import corpus_pipeline as cp


def test_stage_catches_passages_of_over_50_words(spark):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    some = lambda k: [word(rng.randint(2, 9)) for _ in range(k)]
    short = [word(2) + "é" * (k == 7) for k in range(51)]  # about 150 bytes
    usual, under, long = some(51), [word(3) for _ in range(45)], [word(19) for _ in range(22)]  # the last 440 bytes in 22 words
    glue = word(450)
    rows, want = [], {}
    for k, p in enumerate([short, short, usual, usual, under, under, long, long, [glue], [glue]]):
        a, b = some(30), some(30)
        sep = "\n" if k % 2 else "  "
        rows.append((k, " ".join(a) + sep + sep.join(p) + sep + " ".join(b)))
        kept = p if p is under else []
        want[k] = [*a, *kept, *b]
    rows.append((100, None))
    want[100] = []
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in cp.remove_repeated_spans(spark, df, "").collect()}
    assert {k: r["text"].split() for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert cp.remove_repeated_spans(spark, df.limit(0), "").count() == 0


def test_memory_of_a_slab_is_bounded_and_repeats_cross_slabs(spark):
    """Two megabytes are cut with less than 30 MB of arrays, and a repeat that lies across the slabs' edge is found whole."""
    import random
    import tracemalloc

    from leadloom.llm import superwords
    from leadloom.llm.suffix_dedup import remove_repeats

    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    big, cutter = letters(2_000_000).encode(), superwords.SuperWords(400, 64)
    tracemalloc.start()
    windows = sum(int(r.windows.sum()) for r in cutter.runs([big]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows == len(big) - 399 and most < 30e6
    twice, edge = letters(900), superwords.SLAB
    docs = spark.createDataFrame([(1, letters(edge - 450) + twice + letters(edge)), (2, "x" + twice + "y")], "doc_id long, text string")
    got = {r["doc_id"]: r["repeats"] for r in remove_repeats(docs).collect()}
    assert [(got[k]["n_removed"], got[k]["n_spans"]) for k in (1, 2)] == [(900, 1)] * 2


def test_memory_of_a_refined_bucket_is_bounded():
    """A bucket of the most bytes that a task refines takes under 60 bytes of arrays a position."""
    import tracemalloc

    import numpy as np

    from leadloom.llm.suffix_dedup import MOST_BYTES, repeated_windows

    one = np.random.default_rng(1).integers(97, 123, MOST_BYTES // 2, dtype=np.uint8)
    data, valid = np.concatenate([one, one]), np.ones(2 * len(one), bool)
    repeated_windows(data[:1000], valid[:1000], 400)
    tracemalloc.start()
    found = repeated_windows(data, valid, 400)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.sum() >= 2 * (len(one) - 399) and most < 60 * len(data)
