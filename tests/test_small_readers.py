"""Readers and small jobs that no query covers."""

import json

from pyspark.sql import functions as F

from leadloom.operators import contacts as c
from leadloom.operators import venues as v
from leadloom.operators import writes as w
from leadloom.sources import readers


def test_pages_extracts_captures_verdicts(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.html").write_bytes(b"<p>\xff \xc3\xa4</p>\n<p>x</p>")
    raw = readers.read_pages(spark, str(tmp_path / "raw"), raw=True).collect()
    assert len(raw) == 1 and raw[0]["path"].endswith("a.html") and raw[0]["html"] == "<p>� ä</p>\n<p>x</p>"
    spark.createDataFrame([(1, "h")], "page_id long, html string").write.parquet(str(tmp_path / "pages"))
    assert readers.read_pages(spark, str(tmp_path / "pages")).collect() == [(1, "h")]
    (tmp_path / "ext").mkdir()
    (tmp_path / "ext" / "1.txt").write_text("Aoi Oy\n1234567-1 and 7654321-0\nx", encoding="utf-8")
    (tmp_path / "ext" / "2.txt").write_text("no id", encoding="utf-8")
    assert [(r["business_id"], r["text"][:6]) for r in readers.read_extracts(spark, str(tmp_path / "ext")).collect()] == [("1234567-1", "Aoi Oy")]
    place = {"id": "p", "displayName": {"text": "Aoi"}, "location": {"latitude": 60.1, "longitude": 24.9}}
    lines = [{"venue_id": 1, "query_no": 0, "query": "q", "status": 200, "response": {"places": [place, place]}}, {"venue_id": 2, "query_no": 0, "query": "q", "status": 200, "response": {}}, {"venue_id": 3, "status": 500}]
    (tmp_path / "api.json").write_text("\n".join(map(json.dumps, lines)))
    assert [(r["venue_id"], r["place"]["displayName"]["text"]) for r in readers.read_api_captures(spark, str(tmp_path / "api.json")).collect()] == [(1, "Aoi")] * 2
    (tmp_path / "v.csv").write_text('harvested_string,is_person,cleaned_name,reason,model\n"Anna ""A"" Korpela", YES ,Anna Korpela,ok,\nGift Card,0,,junk,m1\n ,1,,,\n', encoding="utf-8")
    got = {r["name_norm"]: (r["is_person"], r["cleaned_name"], r["confidence"], r["model"]) for r in readers.read_verdicts_csv(spark, str(tmp_path / "v.csv")).collect()}
    assert got == {"anna a korpela": (1, "Anna Korpela", "high", "imported"), "gift card": (0, None, "high", "m1")}


def test_audit_export_and_sample(spark, tmp_path):
    rows = [(1, "Gift Card", "a@x.fi", ["not a person-shaped name", "repeats the venue's name"], None), (2, "Anna Korpela", None, [], "at 4 venues"), (3, "Jussi Lahti", None, [], None)]
    w.audit_export(spark.createDataFrame(rows, "venue_id long, contact_name string, email string, hard array<string>, soft string"), str(tmp_path / "audit"))
    got = {r["venue_id"]: r["reasons"] for r in spark.read.csv(str(tmp_path / "audit"), header=True).collect()}
    assert got == {"1": "not a person-shaped name; repeats the venue's name", "2": "at 4 venues"}
    many = spark.range(1000).select(F.col("id").cast("string").alias("name_norm"), (F.col("id") % 2).cast("int").alias("is_person"))
    one, two = (sorted(int(r["name_norm"]) for r in v.audit_sample(many.repartition(n), 20).collect()) for n in (2, 7))
    assert one == two and len(set(one)) == 20 and all(k % 2 for k in one) and max(one) > 200


def test_ingested_pages(spark):
    hits = spark.createDataFrame([("u1", "a@x.fi", "high", None), ("u1", "b@x.fi", "medium", None), ("u2", "c@x.fi", "medium", "Anna Korpela"), ("u9", "d@x.fi", "medium", None)], "url string, email string, confidence string, contact_name string")
    kinds = spark.createDataFrame([("u1", "privacy"), ("u2", "contact")], "url string, kind string")
    got = {r["email"]: (r["source"], r["confidence"], r["source_url"]) for r in c.ingest_pages(hits, kinds).collect()}
    assert got == {"a@x.fi": ("website_privacy", "high", "u1"), "b@x.fi": ("website_privacy", "medium", "u1"), "c@x.fi": ("website_contact", "high", "u2"), "d@x.fi": ("website_other", "medium", "u9")}
