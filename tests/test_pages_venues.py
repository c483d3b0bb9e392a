from pyspark.sql import functions as F

from leadloom.functions.text import host_of
from leadloom.operators import pages as p
from leadloom.operators import venues as v
from leadloom.operators import writes as w

HEAD = """<meta content="Aoi | Site" property="og:title"><link rel='canonical' href="https://x.fi/en/helsinki/aoi/92"><meta property="og:image" content="/a/restaurant/93/x.jpg">"""
LD = """<script type="application/ld+json">{"@graph":[{"@type":"Restaurant"},{"@type":"Restaurant","@id":"/9","name":"Rich","telephone":"1","address":{"streetAddress":"K 1"}},{"@type":"Restaurant","@id":"/92","name":"Aoi"}]} </script>"""


def test_links(spark):
    html = '<a href="/page-17">Tietosuojaseloste</a><a href="/page-17/#x">Muu</a><a href="/yhteystiedot">x</a><a href="/menu.pdf">Privacy</a><a href="https://other.fi/privacy">Privacy</a><a href="/wp-admin/x">a</a><a href="mailto:a@b.fi">m</a><a href="/">Koti</a><a href="/c" title="Contactless">i</a>'
    links = p.page_links(spark.createDataFrame([(1, "https://www.aoi.fi/fi", html), (2, "https://b.fi", None)], "page_id long, url string, html string"))
    got = [(r["link"], r["kind"], r["priority"]) for r in p.rank_links(links.where(p.crawlable(F.col("link"), host_of(F.col("url")))), "page_id").orderBy("rank").collect()]
    assert got == [("https://www.aoi.fi/page-17", "privacy", 1), ("https://www.aoi.fi", "home", 4), ("https://www.aoi.fi/yhteystiedot", "contact", 5), ("https://www.aoi.fi/c", "other", 9)]


def test_listing(spark):
    df = spark.createDataFrame([(92, HEAD), (635, "<title></title>")], "probed_id long, html string")
    got = {r["probed_id"]: r for r in p.listing_guards(p.listing_meta(df)).collect()}
    assert got[92]["title"] == "Aoi" and got[92]["city_slug"] == "helsinki" and got[92]["review_reason"] == "image id mismatch" and not got[92]["refused"]
    assert got[635]["refused"]


def test_jsonld(spark):
    df = spark.createDataFrame([(92, LD), (1, None), (2, '<script type="application/ld+json">{bad</script>')], "page_id long, html string")
    assert p.best_jsonld_node(p.jsonld_nodes(df), wanted_id="page_id").select("name").collect() == [("Aoi",)]
    assert p.best_jsonld_node(p.jsonld_nodes(df)).select("name").collect() == [("Rich",)]


def test_places(spark):
    venues = spark.createDataFrame([(1, "Aoi", 60.0, 24.0, None, None), (2, "Vanha", 60.0, 24.0, None, None), (3, "Abc", None, None, "Satamakatu 12", "00100"), (4, "Abc", None, None, "Satamakatu 12", "00200")], "venue_id long, name string, lat double, lng double, street_address string, postal_code string")
    kind = "venue_id long, query_no int, place struct<id:string,displayName:struct<text:string>,formattedAddress:string,location:struct<latitude:double,longitude:double>>"
    place = lambda i, n, a=None, la=None, lo=None: (i, (n,), a, (la, lo))
    rows = [(1, 0, place("a", "Ravintola Aoi", la=61.0, lo=25.0)), (1, 1, place("b", "Other")), (2, 0, place("c", "Uusi", la=60.0005, lo=24.0)), (3, 0, place("d", "Xyz", "Satamakatu 12, 00100 Helsinki")), (4, 0, place("e", "Xyz", "Satamakatu 12, 00100 Helsinki")), (4, 1, place("f", "Qrs"))]
    got = {r["venue_id"]: (r["place"]["id"], r["method"], r["accepted"]) for r in v.best_place(v.place_candidates_score(venues, spark.createDataFrame(rows, kind))).collect()}
    assert got == {1: ("a", "name", True), 2: ("c", "distance", True), 3: ("d", "address", True), 4: ("f", "none", False)}


def test_tenure_and_verdict(spark):
    rows = v.tenure_buckets(spark.createDataFrame([(k,) for k in (92, 1204, 1495, 1528, 7, 8)], "venue_id long"))
    assert [r["tenure_bucket"] for r in rows.orderBy("venue_id").collect()] == [1, 1, 2, 3, 3, 4]
    counts = spark.createDataFrame([(0, 0), (24, 1), (240, 0), (240, 3)], "found int, misses int")
    assert [r["verdict"] for r in v.crosscheck_verdict(counts).collect()] == ["INCONCLUSIVE", "INCONCLUSIVE", "PASS", "FAIL"]


def test_writes_twice(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k long, a string, b int")
    delta = spark.createDataFrame([(1, None, 9, 0), (1, "z", None, 1), (3, "n", None, 2)], "k long, a string, b int, seq int")
    once = w.upsert_coalesce(base, delta, ["k"], "seq")
    assert sorted(map(tuple, once.collect())) == [(1, "z", 9), (2, None, 2), (3, "n", None)]
    assert sorted(map(tuple, w.upsert_coalesce(once, delta, ["k"], "seq").collect())) == sorted(map(tuple, once.collect()))
    assert w.upsert_coalesce(base, delta.select("k"), ["k"]).count() == 2
    new = spark.createDataFrame([("p", "x", 1), ("p", "y", 2), ("p", "x", 3)], "key string, content string, seq int")
    first = w.append_versions(spark.createDataFrame([], "key string, sha string, version int, content string"), new)
    again = w.append_versions(first, new)
    assert sorted((r["version"], r["content"]) for r in again.collect()) == [(1, "x"), (2, "y")]
    w.write_csv(base, str(tmp_path / "c"), True)
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2


def test_stream_once(spark, tmp_path):
    from leadloom.streaming.incremental import dedupe_captures, incremental_harvest

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("k", "a@b.fi", "2026-01-01"), ("k", "a@b.fi", "2026-01-01"), ("k", "c@d.fi", "2026-01-01")], "key string, content string, fetched_at string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    rows.write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    for _ in range(2):
        incremental_harvest(dedupe_captures(stream), lambda df: df.select("content"), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/{n}"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(f"{out}/*").count() == 2


def test_captures(spark):
    rows = [(1, '[{"link":"u","title":{"rendered":"t"},"content":{"rendered":"h"}}]'), (2, "<html>"), (3, '{"items":[{"fullUrl":"/a","title":"b","body":"c"}]}'), (4, None)]
    assert sorted((r["id"], r["url"], r["html"]) for r in p.flatten_cms_api(spark.createDataFrame(rows, "id int, body string")).collect()) == [(1, "u", "h"), (3, "/a", "c")]
    users = spark.createDataFrame([(1, '[{"name":"Paavo Kivela"},{"name":"admin"}]'), (2, "x")], "id int, body string")
    assert [tuple(r) for r in p.cms_user_names(users).collect()] == [(1, "Paavo Kivela")]
    maps = spark.createDataFrame([(1, "<loc> a </loc><loc>b</loc><loc>a</loc><loc>c</loc>")], "id int, body string")
    assert [r["link"] for r in p.sitemap_urls(maps, "body", 2).orderBy("pos").collect()] == ["a", "b"]
    scan = p.discovery_scan(spark.createDataFrame([('Sitemap: http://x/s.xml\nhref="/helsinki/" href="/en/" "/api/v1/x"',)], "body string"))
    assert {tuple(r) for r in scan.collect()} == {("sitemap", "http://x/s.xml"), ("city_slug", "helsinki"), ("api_path", "/api/v1/x")}


def test_reports(spark):
    from leadloom.operators import quality as q

    venues = spark.createDataFrame([(1, "FI", "1", None), (2, None, None, "s"), (3, "EE", None, None)], "venue_id long, country string, phone string, street_address string")
    places = spark.createDataFrame([(3, "+372")], "venue_id long, international_phone string")
    sites = spark.createDataFrame([(1, "a.fi", "done"), (2, "b.fi", None)], "venue_id long, domain string, crawl_status string")
    contacts = spark.createDataFrame([(1, "a@a.fi", "A B"), (1, "b@a.fi", None), (2, None, "C D")], "venue_id long, email string, contact_name string")
    got = {r["measure"]: r["n"] for r in q.coverage_report(venues, places, sites, contacts).collect()}
    assert got == {"country:FI": 1, "country:none": 1, "country:EE": 1, "phone": 2, "address": 1, "site": 2, "crawled": 1, "any_email": 1, "named": 1}
    off = spark.createDataFrame([(1, "a.fi"), (2, "a.fi"), (2, "b.fi"), (3, "c.fi")], "venue_id long, email_domain string")
    assert {r["email_domain"]: (r["n"], r["venues"]) for r in q.domain_rollup(off, 1).collect()} == {"a.fi": (2, 2), "(others)": (2, 2)}


def test_payload_differences(spark):
    from leadloom.operators import sheet as s

    venues = spark.createDataFrame([(1, "Aoi", "K 1", "00100", "Helsinki", "u", "FI", None, 1.0, 1, "smb")], "venue_id long, name string, street_address string, postal_code string, city string, url string, country string, business_id string, priority_score double, venue_count int, track string")
    contacts = spark.createDataFrame([(1, 1, "m@a.fi", "Matti V", "owner", "high"), (1, 2, "info@a.fi", "Liisa K", None, "high"), (1, 3, None, "Olli S", None, "verified")], "venue_id long, first_seq long, email string, contact_name string, contact_role string, confidence string")
    rows = s.crm_payloads(venues, contacts)
    r = rows.first()
    assert [x["name"] for x in r["persons"]] == ["Olli S", "Matti V"] and r["shared_inboxes"] == ["info@a.fi"] and r["org"]["address"] == "K 1, 00100, Helsinki"
    state = s.payload_hash(rows).selectExpr("venue_id", "payload_hash", "array('Matti V') AS synced")
    d = s.sync_diff(rows, state).first()
    assert d["action"] == "unchanged" and [x["name"] for x in d["new_persons"]] == ["Olli S"]
    assert s.sync_diff(rows, state.where("false")).first()["action"] == "created"
