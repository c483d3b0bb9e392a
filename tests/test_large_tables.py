"""What larger tables showed: numbers that were cut, crowded cells, short ranges, distinct counts."""

import json

import duckdb

from pyspark.sql import functions as F

from leadloom.functions.urls import _SPLIT
from leadloom.operators import contacts as c
from leadloom.operators import pages as p
from leadloom.operators import venues as v
from leadloom.plans import catalog
from leadloom.sources import json_ranges


def test_numbers_of_five_digits_are_not_cut(spark, tmp_path):
    """A number's first four digits aren't another's."""
    customers = [(k, f"c{k}", 1, 1.0, "X") for k in (1001, 1002, 10010, 10020)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k,) for k in (1001, 1002, 10030)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    got = catalog.queries()["matched_by_name"](spark, str(tmp_path)).collect()
    assert sorted((r["venue_id"], r["business_id"], r["confidence"]) for r in got) == [(1001, "B1001", 0.9), (1002, "B1002", 1.0)]


def test_a_crowded_cell_is_dealt_into_parts(spark):
    df = spark.range(40).select("id", (60 + F.col("id") / 10000).alias("lat"), F.lit(25.0).alias("lng"))
    got = [sorted(tuple(r) for r in v.radius_join(df, df, 100.0, n).collect()) for n in (3, 1000)]
    assert got[0] == got[1] and len(got[0]) > 40


def shuffled_rows(node) -> int:
    """Rows that the exchanges of a run plan wrote."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_rows(node.children().apply(k)) for k in range(node.children().size()))


def test_a_crowded_cell_is_copied_a_bounded_number_of_times(spark):
    """What is shuffled grows as the points, not as their pairs."""
    wrote, least = [], "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(least, -1)
    try:
        for n in (300, 600):
            df = spark.range(n).select("id", (60 + F.col("id") / 1000000).alias("lat"), F.lit(25.0).alias("lng"))
            out = v.radius_join(df, df, 1000.0, 3)
            assert len(out.collect()) == n * n
            wrote.append(shuffled_rows(out._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.unset(least)
    assert wrote[1] < 2.1 * wrote[0] and wrote[1] < 30 * 600


def test_points_of_one_place_are_compared_as_one(spark):
    """Equal rows whatever the parts; ids that are missing or twice, and places of more ids than a row takes."""
    places = [(60.0, 25.0), (60.0, 25.0005), (60.0002, 25.0), (0.0, 180.0), (-0.0, -180.0), (60.1, 25.0), (None, 25.0)]
    rows = [(k % 90, *places[k * k % 7]) for k in range(100)] + [(None, 60.0, 25.0)]
    df = spark.createDataFrame(rows, "id long, lat double, lng double")
    plain = v.radius_join(df, df, 100.0).where("id < id2").select("id", "id2", F.round("metres", 3))
    want = sorted(map(tuple, plain.collect()))
    for a_task, a_place in ((2000, 100), (5, 3), (1, 1)):
        got = v.haversine_pairs(df, "id", F.col("lat"), F.col("lng"), 100.0, 3, points_a_task=a_task, ids_a_place=a_place)
        assert sorted(map(tuple, got.collect())) == want
    out = v.haversine_pairs(df, "id", F.col("lat"), F.col("lng"), 100.0)
    out.collect()
    assert len(want) > 800 and shuffled_rows(out._jdf.queryExecution().executedPlan()) < 100


def test_short_ranges_share_tasks(spark, tmp_path):
    (tmp_path / "d.json").write_text("\n".join(json.dumps({"n": k}) for k in range(400)))
    df = json_ranges.json_records(spark, str(tmp_path / "d.json"), range_bytes=16)
    assert [json.loads(r["record"])["n"] for r in df.orderBy("place").collect()] == list(range(400)) and df.rdd.getNumPartitions() <= 16


def test_owners_are_counted_without_distinct_counts(spark):
    named = spark.createDataFrame([(1, "Anna Oy"), (1, "anna"), (2, "Anna"), (3, "Anna"), (4, None), (3, "Bo")], "venue_id int, contact_name string")
    matches = spark.createDataFrame([(1, "b"), (2, "b"), (2, "a"), (3, None), (4, "a")], "venue_id int, business_id string")
    out = c.group_owners(named, matches)
    assert [tuple(r) for r in out.select("name_norm", "n_companies", "n_venues", "company").collect()] == [("anna", 2, 2, "a")]
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_tags_and_links_are_read_once(spark):
    pages = spark.createDataFrame([(1, "https://x.fi/", '<meta property="og:title" content="A | Site"><a href="/menu">m</a>')], "page_id int, url string, html string")
    listing, links = p.listing_meta(pages, site="Site"), p.page_links(pages)
    ranked = p.rank_links(links.where(p.crawlable(F.col("link"), F.lit("x.fi"))), "page_id")
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert listing.first()["title"] == "A" and [r["link"] for r in ranked.collect()] == ["https://x.fi/menu"]
    assert text(listing).count("(?:meta|link)") == 1 and text(ranked).count(_SPLIT) == 10  # five parts of two URLs


def test_visible_text_of_cut_references_equals_the_sql(spark, tmp_path):
    """A text may be cut within a reference; nested elements, other references and white space go by the SQL too."""
    texts = ["<p>a &amp", "<p>b &copy 1</p>", "&amp;quot; &quot;&lt;&#65;&amp;amp;", "<style> <script> </style> x </script> y", "<noscript>n</noscript> \x0b\xa0 z ", "<SCRIPT a>b</script\n>c\r\n\td", "", None]
    texts += [("x" * 390) + "&amp " * n for n in (1, 2)]
    spark.createDataFrame([(k, "https://a.fi/", x) for k, x in enumerate(texts)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = catalog.queries()["visible_text_len"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(duck.sql(catalog.oracle_sql()["visible_text_len"]).fetchall())
    tiers = duck.sql(f"SELECT page_id, cms, is_shell, tier FROM ({catalog.oracle_sql()['crawl_tiers']})").fetchall()
    assert sorted(tuple(r) for r in catalog.queries()["crawl_tiers"](spark, str(tmp_path)).select("page_id", "cms", "is_shell", "tier").collect()) == sorted(tiers)


def test_names_that_need_alignment_are_scored(spark, tmp_path):
    """Names that no bound decides go to Python, in the query on part names too; one row each, with the plain score."""
    spark.createDataFrame([("kalla aoi",), ("aoi naoi",), ("bar kalla",)], "p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    out = catalog.queries()["similarity_match"](spark, str(tmp_path))
    assert out.columns == ["target", "name", "score"] and sorted(r["target"] for r in out.collect()) == sorted(r[0] for r in duck.sql(catalog.oracle_sql()["similarity_match"]).fetchall())
    venues = spark.createDataFrame([(1, "Kalla Satama", None, None, None, None)], "venue_id long, name string, lat double, lng double, street_address string, postal_code string")
    kind = "venue_id long, query_no int, place struct<id:string,displayName:struct<text:string>,formattedAddress:string,location:struct<latitude:double,longitude:double>>"
    places = spark.createDataFrame([(1, 0, ("a", ("Kala Satamat",), None, None))], kind)
    got = v.place_candidates_score(venues, places).collect()
    assert [(r["similarity"], r["method"]) for r in got] == [(22 / 24, "name")]
