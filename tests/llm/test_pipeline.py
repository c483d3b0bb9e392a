import corpus_pipeline as cp
from leadloom.llm.near_copies import drop_near_copies
from leadloom.llm.simhash import fingerprint, near_duplicate_documents


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (_, stage) in enumerate(cp.STAGES):
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(cp.STAGES) - 1:
            assert docs.columns == cp.COLUMNS and docs.join(before, "doc_id", "left_anti").count() == 0
        else:
            assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert cp.run(spark, sf).count() == docs.count()


def test_odd_rows(spark, tmp_path):
    """Null and empty texts are copies of each other; repeated rows, near copies and repeated lines stay once, by the least
    id; without labels nothing is toxic."""
    import random

    rng = random.Random(6)
    words = [f"word{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, line = text(60), text(12)
    near = " ".join([*long.split()[:-2], "other", "end"])
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, near), (5, f"{text(30)}\n{line}"), (6, f"{text(30)}\n{line}"), (7, text(25)), (8, None), (9, "x " * 30_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, piece int")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")).select(*cp.COLUMNS), []
    for name, stage in cp.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == cp.COLUMNS
        sizes.append(kept.count())
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert sizes[:2] == [len(rows)] * 2 and len(got) == kept.count()
    assert sorted(got) == [1, 3, 5, 6, 7, 9] and got[3] == long and got[5].endswith(line) and line not in got[6] and got[1] in (None, "")
    packed = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(got)


def test_near_copies_are_linked_by_fingerprints_and_by_sets(spark):
    """2 has the fingerprint of 1 (a phrase that repeats) but few of its shingles; 3 has most shingles of 2; 4 is alone."""
    import random

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    phrase, tail, other = [word() for _ in range(5)], [word() for _ in range(40)], [word() for _ in range(40)]
    texts = [phrase * 200 + tail, phrase * 200 + other, phrase + other, [word() for _ in range(60)]]
    prints = [fingerprint(" ".join(t)) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= 3 < min((prints[0] ^ prints[2]).bit_count(), (prints[1] ^ prints[2]).bit_count())
    docs = spark.createDataFrame([(k + 1, " ".join(t), "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in drop_near_copies(docs).collect()) == [1, 2, 4]
    assert sorted(r["doc_id"] for r in near_duplicate_documents(docs, 3).collect()) == [1, 3, 4]
    assert sorted(r["doc_id"] for r in cp.keep_one_of_near_copies(spark, docs, "").collect()) == [1, 4]
