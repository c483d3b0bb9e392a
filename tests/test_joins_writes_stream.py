"""Bounds before alignment, substring postings, distances, snapshots in buckets, exact streaming."""

import datetime
import math
import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from leadloom.functions.text import similarity_parts, with_similarity
from leadloom.operators import register as r
from leadloom.operators import venues as v
from leadloom.operators import writes as w
from leadloom.streaming import incremental as inc


def plain_similarity(a, b):
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    wa, wb = set(a.split()), set(b.split())
    ratio = SequenceMatcher(None, a, b).ratio()
    if wa <= wb or wb <= wa:
        return max(0.9, ratio)
    return max(ratio, len(wa & wb) / len(wa | wb))


def test_bounds_decide_most_pairs(spark):
    rng = random.Random(4)
    words = ["kalla", "kala", "aoi", "naoi", "helsinki", "bar", "12", "ö", "satama", "tupa", "x" * 120]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(120)})
    pairs = [(a, b) for a in names for b in names] + [("", "a"), (None, "a"), ("a", None), (None, None), ("ab" * 150, "ab" * 150 + "c")]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(4)
    got = with_similarity(with_similarity(df, "a", "b", "s"), "a", "b", "t", 0.75).collect()
    for x in got:
        want = plain_similarity(x["a"], x["b"])
        assert x["s"] == pytest.approx(want, abs=1e-12) and (x["t"] == pytest.approx(want, abs=1e-12) if want > 0.75 else x["t"] <= 0.75 + 1e-12)
    sent = lambda least: df.where(similarity_parts(F.col("a"), F.col("b"), least)["open"]).count() / len(pairs)
    assert sent(0.75) < 0.25 and sent(0.9) < 0.08


@pytest.mark.parametrize("postings", [3, 50_000])
def test_substrings_under_skew(spark, postings):
    rng = random.Random(7)
    piece = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))).strip() or "a"
    names = sorted({piece() + (" aoi" if rng.random() < 0.5 else "") + piece() for _ in range(600)})
    targets = sorted({piece() for _ in range(150)} | {"aoi", "zzz", " aoi", "aoia", "ab", "b"})
    got = r.substring_pairs(spark.createDataFrame([(t,) for t in targets], "target string"), spark.createDataFrame([(n,) for n in names], "name string"), postings)
    rows = [(x["target"], x["name"]) for x in got.collect()]
    assert sorted(rows) == sorted((t, n) for t in targets for n in names if t in n)


def test_one_company_a_domain(spark):
    venues = spark.createDataFrame([(k, "chain.fi" if k < 50 else None) for k in range(60)], "venue_id long, domain string")
    companies = spark.createDataFrame([(f"B{k:03d}", "https://shop.chain.fi/x") for k in range(40)] + [("A", None)], "business_id string, website string")
    assert {(x["venue_id"], x["business_id"]) for x in r.match_by_website(venues, companies).collect()} == {(k, "B000") for k in range(50)}


def metres(a, b):
    p, q, dl = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
    return 2 * 6371000.0 * math.asin(min(1.0, math.sqrt(math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(dl / 2) ** 2)))


@pytest.mark.parametrize("radius", [150.0, 40_000.0, 2_000_000.0, 25_000_000.0])
def test_radius_join(spark, radius):
    rng = random.Random(3)
    some = [(90.0, 0.0), (90.0, 77.0), (-90.0, 10.0), (89.9999, -180.0), (89.9999, 0.0), (0.0, 180.0), (0.0, -180.0), (0.0, 179.9999), (60.0, 540.0)]
    for _ in range(160):
        lat, lng = rng.choice([(rng.uniform(-90, 90), rng.uniform(-180, 180)), (rng.uniform(59.9, 60.1), rng.choice([179.9, -180.0]) + rng.uniform(0, 0.1)), (rng.uniform(89.5, 90), rng.uniform(-180, 180))])
        some += [(lat, lng), (max(-90.0, min(90.0, lat + rng.uniform(-0.001, 0.001))), lng + rng.uniform(-0.002, 0.002))]
    data = [(k, *p) for k, p in enumerate(some)]
    df = spark.createDataFrame([*data, (900, None, 1.0), (901, 91.0, 1.0), (902, 1.0, None), (903, float("nan"), 1.0)], "id long, lat double, lng double")
    got = [(x["id"], x["id2"]) for x in v.haversine_pairs(df, "id", F.col("lat"), F.col("lng"), radius).collect()]
    sure = {(a[0], b[0]) for a in data for b in data if a[0] < b[0] and metres(a[1:], b[1:]) <= radius * (1 - 1e-9)}
    may = {(a[0], b[0]) for a in data for b in data if a[0] < b[0] and metres(a[1:], b[1:]) <= radius * (1 + 1e-9)}
    assert len(got) == len(set(got)) and sure <= set(got) <= may and len(sure) > 20


def test_versions_of_a_hot_key(spark):
    rng = random.Random(2)
    new = [("hot" if k % 3 else f"k{k % 7}", f"text {rng.randint(0, 150)}", rng.randint(0, 90)) for k in range(600)]
    old = spark.createDataFrame([("hot", "x" * 64, 4, "gone"), ("k1", "y" * 64, 1, "other")], "key string, sha string, version int, content string")
    df = spark.createDataFrame([*new, new[0], ("hot", None, 5)], "key string, content string, seq int").repartition(5)
    out = w.append_versions(old, df)
    got = {}
    for x in out.collect():
        got.setdefault(x["key"], {})[x["version"]] = x["content"]
    for key, had in (("hot", 4), ("k1", 1), ("k2", 0)):
        first = {}
        for k, text, seq in new:
            if k == key:
                first[text] = min(first.get(text, 999), seq)
        fresh = {n: t for n, t in got[key].items() if n > had}
        assert sorted(fresh) == list(range(had + 1, had + 1 + len(fresh))) and set(fresh.values()) == set(first)
        assert [first[fresh[n]] for n in sorted(fresh)] == sorted(first.values())
    assert sorted(map(tuple, w.append_versions(out, df).collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merges_rewrite_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "venues")
    base = spark.range(500).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit(None).cast("string").alias("city"))
    w.write_snapshot(base, path, ["id"], 32)
    before = files(path)
    delta = spark.createDataFrame([(3, None, "Turku"), (900, "new", None)], "id long, name string, city string")
    upsert = lambda b, d: w.upsert_coalesce(b, d, ["id"])
    touched = w.merge_snapshot(path, delta, ["id"], 32, upsert)
    after = files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert 1 <= len(touched) <= 2 and {f for f in before if f"bucket={touched[0]}/" not in f and f"bucket={touched[-1]}/" not in f} == kept
    rows = {x["id"]: (x["name"], x["city"]) for x in w.read_snapshot(spark, path).collect()}
    assert len(rows) == 501 and rows[3] == ("n3", "Turku") and rows[900] == ("new", None) and rows[7] == ("n7", None)
    w.merge_snapshot(path, delta, ["id"], 32, upsert)
    assert {x["id"]: (x["name"], x["city"]) for x in w.read_snapshot(spark, path).collect()} == rows
    assert w.merge_snapshot(path, delta.limit(0), ["id"], 32, upsert) == []


def test_exact_streaming_dedupe(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    inc.with_rocksdb(spark)
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    rounds = [[("a", "x", day(0)), ("a", "x", day(0)), ("b", "x", day(1))], [("a", "y", day(40)), ("a", "x", day(41)), ("c", None, None)], [("a", "x", day(0)), ("b", "x", day(-900)), ("a", "y", day(99)), ("d", "z", day(3)), ("d", "z", day(2))]]
    source, seen = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    try:
        for k, rows in enumerate(rounds):
            spark.createDataFrame(rows, "key string, content string, fetched_at timestamp").write.mode("append").parquet(str(source))
            stream = spark.readStream.schema("key string, content string, fetched_at timestamp").parquet(str(source))
            query = inc.dedupe_captures_exactly(stream).writeStream.format("parquet").option("path", str(seen)).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
        got = sorted((x["key"], x["content"] or "", x["fetched_at"]) for x in spark.read.parquet(str(seen)).where("key <> 'c'").collect())
        assert got == [("a", "x", day(0)), ("a", "y", day(40)), ("b", "x", day(1)), ("d", "z", day(2))] and spark.read.parquet(str(seen)).count() == 5
    finally:
        spark.conf.set(provider, before)
