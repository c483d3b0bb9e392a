"""Readers of large dumps, words that are no names, and counts of writes."""

import json

import pytest
from pyspark.sql import functions as F

from leadloom.functions.text import person_shaped, prose_words
from leadloom.operators import contacts as c
from leadloom.operators import pages as p
from leadloom.operators import register as r
from leadloom.operators import writes as w
from leadloom.sources import readers


def test_people_of_a_dump_read_by_ranges(spark, tmp_path):
    people = [{"ariregistri_kood": k, "kaardile_kantud_isikud": [{"eesnimi": "Piret", "perekonnanimi": f"Mets{k}"}]} for k in range(20)]
    (tmp_path / "p.json").write_text(json.dumps({"meta": {"n": [1]}, "data": people}))
    got = r.current_persons(readers.read_register_persons(spark, str(tmp_path / "p.json"), range_bytes=100))
    assert sorted(x["person_name"] for x in got.collect()) == sorted(f"Piret Mets{k}" for k in range(20))


PERSONS = [
    ({"kood": 1, "isikud": [{"eesnimi": "Piret", "perekonnanimi": "Mets"}]}, [("Piret Mets", False)]),
    ({"kood": 1, "isikud": [{"first_name": "Piret", "last_name": "Mets", "role": "x"}]}, [("Piret Mets", False)]),
    ({"kood": 1, "isikud": [{"eesnimi": "Piret", "surname": ""}]}, [("Piret", False)]),
    ({"kood": 1, "isikud": [{"nimi": "A B", "isiku_nimi": "C D"}]}, [("C D", False)]),
    ({"kood": 1, "isikud": [{"nimi": "A B", "eesnimi": "C"}]}, [("A B", False)]),  # the hint is first in the first key
    ({"kood": 1, "isikud": [{"eesnimi": "C", "nimi": "A B"}]}, [("C", False)]),
    ({"kood": 1, "nimi": "Own Name", "isikud": [{"nr": 3}, {"nimi": None}, {"nimi": []}]}, [("Own Name", False)]),  # no one there has a name
    ({"kood": 1, "nimi": "Own Name", "isikud": [{"nimi": "A B", "end_date": "2020"}]}, [("A B", True)]),
    ({"kood": 1, "nimi": "Own Name", "end_date": "2020", "isikud": []}, [("Own Name", False)]),
    ({"kood": 1, "nimi": "Own Name", "isikud": ["text", {"nimi": "A B"}]}, [("Own Name", False)]),  # doesn't begin with an object
    ({"kood": 1, "isikud": [{"nimi": "A B"}, "text", 3, None]}, [("A B", False)]),
    ({"kood": 1, "esindusoiguse_isikud": [{"nimi": "A B"}], "nimi": "[x"}, [("[x", False)]),
    ({"kood": "", "registry_code": None, "nimi": "A B"}, []), ({"kood": 1}, []), ({}, []), ([1], []), (None, []),
    ({"Äriregistri-Kood": 7.5, "Kanne": [{"Isiku Nimi": "Õie Ä"}]}, [("Õie Ä", False)]),
]


@pytest.mark.parametrize("record, want", PERSONS)
def test_person_keys(spark, record, want):
    df = spark.createDataFrame([(None if record is None else json.dumps(record),)], "record string")
    assert [(x["person_name"], x["ended"]) for x in r.register_persons(df).collect()] == want
    assert r.person_losses(df).count() == 1 and r.person_keys(df).count() >= 0


@pytest.mark.parametrize("name, want", [("Wolt Delivery", False), ("Christmas Buffet", False), ("Foodora Wolt", False), ("Joulu Lounas", False), ("Gift Card", False), ("Ota Yhteyttä", False), ("Read More", False), ("Would You", False), ("Anna Korpela", True), ("Aino-Maija Rinne", True), ("Anna", False), (None, False), ("Acme Oy", False)])
def test_words_that_are_no_names(spark, name, want):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(person_shaped(F.col("n")).alias("x")).first()["x"] is want


def test_own_words(spark):
    df = spark.createDataFrame([("Anna Omasana",)], "n string")
    assert df.select(person_shaped(F.col("n"), prose_words(("omasana",))).alias("x"), person_shaped(F.col("n")).alias("y")).first() == (False, True)


def test_writes_are_counted(spark, tmp_path):
    rows, seen = w.observed(spark.createDataFrame([(1, "a"), (2, None)], "k long, email string"), "run", with_email=F.col("email").isNotNull())
    rows.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"n": 2, "with_email": 1}
    w.append_run_log(spark.createDataFrame([seen.get]), str(tmp_path / "log"))
    w.append_failures(spark.createDataFrame([("k", "e" * 3000)], "key string, error string"), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "log")).first()["n"] == 2 and len(spark.read.parquet(str(tmp_path / "f")).first()["error"]) == 1000
    w.write_contact_sheet(rows.repartition(2), str(tmp_path / "sheet"))
    w.write_ranked_list(rows, str(tmp_path / "list"), True)
    assert spark.read.csv(str(tmp_path / "sheet"), header=True).count() == 2 and spark.read.csv(str(tmp_path / "list"), header=True).count() == 2
    w.write_payloads(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_harvest_of_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "no address"), (4, "Anna Korpela ＡＮＮＡ＠ａｏｉ．ｆｉ"), (5, "<a href='mailto:%zz@aoi.fi'>"), (6, '<a data-cfemail="7">'), (7, "x " * 50_000 + "Owner Jussi Lahti jussi@aoi.fi")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"email": F.lit("x"), "at": F.lit(1)})
    got = {x["page_id"]: (x["email"], x["contact_name"], x["contact_role"]) for x in c.harvest_contacts(pages, ["page_id"]).collect()}
    assert got == {4: ("anna@aoi.fi", "Anna Korpela", None), 7: ("jussi@aoi.fi", "Jussi Lahti", "owner")}
    assert c.harvest_contacts(pages.limit(0), ["page_id"]).count() == 0


def test_pages_without_a_node(spark):
    df = spark.createDataFrame([(1, None), (2, '<script type="application/ld+json">[{"@type":"Person"}]</script>')], "page_id long, html string")
    got = {x["page_id"]: x for x in p.detail_fields(df).collect()}
    assert got[1]["phone"] is None and got[2]["street"] is None
    assert [(x["ld_blocks"], x["ld_types"]) for x in p.page_profile(df).orderBy("page_id").collect()] == [(0, []), (1, ["Person"])]
