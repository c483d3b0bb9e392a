"""Line dedup whose result must not depend on how rows are dealt."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from leadloom.llm import common, line_dedup

from .test_dedup_search import brute_lines


def kept(df):
    return {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}


def ten(*changed):
    return " ".join(f"s{k}" if k not in changed else f"other{k}" for k in range(10))


def test_a_set_counts_by_its_earliest_line(spark):
    # s0 and s1 are common, so no prefix has them and all of a set's prefix words meet both others
    rows = [(50, ten()), (3, ten()), (1, ten(0)), (20, ten(1)), *((60 + k, "s0 s1") for k in range(6))]
    for kind, name in (("long", lambda i: i), ("string", lambda i: f"{i:03d}"), ("string", str)):
        own = [(name(i), t) for i, t in rows]
        df = spark.createDataFrame(own, f"doc_id {kind}, text string").coalesce(1)
        got = kept(df)
        assert got[name(20)] == (ten(1) if name(20) < min(name(3), name(50)) else "")
        if kind == "long":
            assert got == brute_lines(own)


@pytest.mark.parametrize("most", [8192, 6])
def test_lines_of_shuffled_ids(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "MOST", most)
    rng = random.Random(13)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(4, 14))] for _ in range(12)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2])):
            x[rng.randrange(len(x))] = rng.choice(words)
        return " ".join(x)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 5)))) for i in range(1, 70)]
    want = brute_lines(rows)
    rng.shuffle(rows)
    assert kept(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == want


def test_words_of_one_bucket_that_meet_different_sets_leave_more():
    # set 9 shares word 1 with set 5 only, and word 2 with set 6 only
    p = np.zeros(4, line_dedup.POSTING)
    p["word"], p["set"], p["order"], p["size"] = [1, 2, 1, 2], [9, 9, 5, 6], [9, 9, 5, 6], 10
    pairs, more = line_dedup.matching_postings(p, 0.8)
    assert pairs[:, 0].tolist() == [9] and more.tolist() == [True]
    pairs, more = line_dedup.matching_postings(p[[0, 2]], 0.8)
    assert pairs.tolist() == [[9, 5]] and more.tolist() == [False]


def test_words_with_many_postings_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST", 20)
    rows = [(k, f"page {k} of the same small book") for k in range(150)] + [(200 + k, f"page {k} of one quite other long volume x{k} y{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    postings = line_dedup._postings(df.select("text", F.lit(0.0).alias("order")), line_dedup.frequent_words(df), 0.6)
    how = line_dedup.dealing(postings)
    groups = line_dedup._dealt(postings, how).groupBy("g").agg((F.sum(F.length("postings")) / line_dedup.POSTING.itemsize).alias("n"))
    assert how.blocks and groups.agg(F.max("n")).first()[0] <= 4 * 20 < postings.agg(F.sum(F.length("postings"))).first()[0] / line_dedup.POSTING.itemsize
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, 0.7).collect()}
    assert sum(t != "" for k, t in left.items() if k < 150) == 1 and left == brute_lines(rows, 0.7)


def test_a_second_round_reads_no_text_again(spark, monkeypatch):
    # of the lines that sketches hold to be near to the last one more than sixteen are under the threshold, and one isn't
    rng = random.Random(5)
    base, common_words = [f"b{k}" for k in range(60)], [f"f{k}" for k in range(40)]
    changed = lambda n: " ".join([*rng.sample(base, 60 - n), *rng.sample(common_words, n)])
    rows = [(k, changed(7)) for k in range(150)] + [(400, changed(6)), (500, " ".join(base)), (600, "\n".join([" ".join(common_words)] * 400))]
    read, asked, all_of = spark.sparkContext.accumulator(0), [], line_dedup._all_candidates

    def spied(many, how, share, open_):
        asked.append(open_.count())
        return all_of(many, how, share, open_)

    monkeypatch.setattr(line_dedup, "_all_candidates", spied)

    def count(text):
        read.add(1)
        return text

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("text", F.udf(count, "string").asNondeterministic()("text"))
    assert kept(df) == brute_lines(rows)
    assert asked and asked[0] > 0 and read.value <= 7 * len(rows)


def test_long_words_are_told_apart_and_texts_meet_without_white_space():
    stem = "a" * 70
    words = ["a", "aa", "a\0", stem, stem + "b", stem + "c", "b" + stem, "12345678", "123456789", "x" * 64, "x" * 65]
    own = [w for x in line_dedup.words_of(pa.array([" ".join(words)])) for w in x.word.tolist()]
    assert len(set(own)) == len(words) == len(own)
    alone = [(x.text.tolist(), x.n.tolist(), x.word.tolist()) for x in line_dedup.words_of(pa.array(words))]
    assert alone == [(list(range(len(words))), [1] * len(words), own)]


def test_workers_let_go_of_what_another_operator_remembered():
    class Texts:
        def select(self, *_):
            return self

        def mapInArrow(self, f, _):
            return f

    common.memory_of("packing")["ids"] = {"word": b""}
    assert common.memory_of("packing")
    batch = pa.RecordBatch.from_arrays([pa.array(["one two"]), pa.array([0.0])], ["text", "order"])
    assert list(line_dedup._postings(Texts(), line_dedup.Ranks(np.zeros(0, np.uint64)), 0.8)(iter([batch]))) == []
    assert not common.memory_of("packing")
