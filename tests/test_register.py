import json

from pyspark.sql import functions as F

from leadloom.operators import register as r
from leadloom.sources import readers

FI = {"companies": [{"businessId": {"value": "1234567-1"}, "names": [{"name": "Aoi", "type": "3"}, {"name": "Ravintola Aoi Oy", "type": "1"}, {"name": "Old", "type": "1", "endDate": "2020"}],
      "mainBusinessLine": {"type": "56101", "descriptions": [{"languageCode": "3", "description": "Restaurants"}, {"languageCode": "1", "description": "Ravintolat"}]},
      "addresses": [{"type": 2, "street": "PL 1", "postCode": "00001"}, {"type": 1, "street": "Satamakatu", "buildingNumber": "12", "postCode": "00100", "postOffices": [{"city": "HELSINGFORS", "languageCode": "2"}, {"city": "HELSINKI", "languageCode": "1"}]}],
      "registeredEntries": [{"type": "41", "register": "7"}, {"type": "80", "register": "6", "status": "2"}], "companySituations": [{"type": "KONKURSSI"}], "website": "www.aoi.fi"}, {"businessId": "2468013-5", "names": [{"name": "Kaislikko Oy", "type": "1"}]}]}


def test_finnish_register(spark, tmp_path):
    (tmp_path / "fi.json").write_text(json.dumps(FI))
    rows = {x["business_id"]: x for x in r.register_flatten_fi(readers.read_register_json(spark, str(tmp_path))).collect()}
    a = rows["1234567-1"]
    assert a["primary_name"] == "Ravintola Aoi Oy" and a["names_norm"] == ["aoi", "old"] and a["main_business_desc"] == "Ravintolat"
    assert (a["street"], a["building_number"], a["post_code"], a["post_office"]) == ("satamakatu", "12", "00100", "HELSINKI")
    assert (a["in_employer_register"], a["vat_liable"], a["situation_flags"]) == (1, 0, ["bankruptcy"])
    assert rows["2468013-5"]["situation_flags"] == []


def test_headers_and_persons(spark, tmp_path):
    (tmp_path / "ee.csv").write_text("ariregistri_kood;Nimi;Ettevõtja staatus tekstina;indeks;unused\n12345678;Aoi OÜ;Registrisse kantud;10111;x\n12;y;;;\n", encoding="utf-8")
    mapping = {"ariregistri_kood": "business_id", "nimi": "name", "staatus": "status", "indeks": "post_code", "aadress": "address"}
    raw = readers.read_by_header(spark, str(tmp_path / "ee.csv"), mapping)
    rows = r.register_flatten_ee(raw.withColumn("address", F.lit(None).cast("string"))).collect()
    assert [(x["business_id"], x["name_norm"], x["status"]) for x in rows] == [("12345678", "aoi", "Registrisse kantud")]
    person = lambda **k: {"isiku_tyyp": "F", **k}
    data = [{"ariregistri_kood": 1, "kaardile_kantud_isikud": [person(eesnimi="Piret", nimi_arinimi="Mets", isiku_roll="JUHL"), person(eesnimi="Rein", nimi_arinimi="Lepp", lopp_kpv="2020-01-01")], "esindusoiguse_tavad": [{"x": "y"}]}, {"ariregistri_kood": "2", "eesnimi": "Kaja", "perekonnanimi": "Org"}]
    for wrapped in (data, {"data": data}):
        path = tmp_path / f"p{isinstance(wrapped, dict)}"
        path.mkdir()
        (path / "x.json").write_text(json.dumps(wrapped))
        got = sorted((x["business_id"], x["person_name"], x["ended"]) for x in r.register_persons(readers.read_register_persons(spark, str(path))).collect())
        assert got == [("1", "Piret Mets", False), ("1", "Rein Lepp", True), ("2", "Kaja Org", False)]
    board = spark.createDataFrame([("1", "Piret Mets", None), ("1", "Firma OÜ", "x"), ("1", "Solo", "x")], "business_id string, person_name string, role string")
    assert [(x["person_name"], x["role"]) for x in r.board_members(board).collect()] == [("Piret Mets", "board member")]


def test_matching(spark):
    venues = spark.createDataFrame([(1, "Aoi", None, None, None, None), (2, "Kaislikko", None, None, None, None), (3, "Naoi Bar", "satamakatu", "12", "00100", None), (4, "Zzz", None, None, None, "zzz.fi"), (5, "Qqq", None, None, None, None)], "venue_id long, name string, street string, number string, postcode string, domain string")
    companies = spark.createDataFrame([("C1", ["aoi"], None, None, None, None), ("C2", ["kaislikko helsinki"], None, None, None, None), ("C3", ["naoise"], "satamakatu", "12", "00100", None), ("C4", ["other"], None, None, None, "https://shop.zzz.fi/x")], "business_id string, names_norm array<string>, street string, building_number string, post_code string, website string")
    ids = spark.createDataFrame([(1, "C1", "checksum_valid"), (1, "C9", "checksum_valid")], "venue_id long, business_id string, how string")
    got = {x["venue_id"]: (x["business_id"], x["method"], x["needs_review"]) for x in r.resolve_registry_match(venues, ids, companies).collect()}
    assert got == {1: ("C1", "business_id", 0), 2: ("C2", "name", 0), 3: ("C3", "name_address", 0), 4: ("C4", "website", 0), 5: (None, "none", 1)}


def test_substring_pairs_agree_with_all_pairs(spark):
    names = spark.createDataFrame([(n,) for n in ("naoise", "aoi helsinki", "ab", "b", "cafe ab", "xyz")], "name string")
    targets = spark.createDataFrame([(n,) for n in ("aoi", "ab", "b", "helsinki", "zz", "q")], "target string")
    got = {(x["target"], x["name"]) for x in r.substring_pairs(targets, names).collect()}
    assert got == {(t["target"], n["name"]) for t in targets.collect() for n in names.collect() if t["target"] in n["name"]}


EXTRACT = """Aoi Oy 1234567-1
Sähköposti Toimisto@aoi.fi
Puhelin 09 123
Toimitusjohtaja (Rekisteröity 09.01.2020 08:20:39)
Toimitusjohtaja Korpela Veli-Matti 01.02.1970
Puheenjohtaja Korpela Veli-Matti 01.02.1970
Jäsen Mets Piret 03.04.1980
Tilintarkastaja Ernst & Young Oy 05.05.1990
"""


def test_extracts(spark):
    e = spark.createDataFrame([("1234567-1", EXTRACT)], "business_id string, text string")
    got = sorted((x["person_name"], x["role"]) for x in r.extract_officers(e).collect())
    assert got == [("Piret Mets", "board member"), ("Veli-Matti Korpela", "managing director")]
    assert not any("19" in str(v) for x in r.extract_officers(e).collect() for v in x if isinstance(v, str))
    assert tuple(r.extract_registered_contact(e).first()) == ("1234567-1", "toimisto@aoi.fi", "09 123", None)
    ids = spark.createDataFrame([(v, "1234567-1") for v in range(5)], "venue_id long, business_id string")
    assert r.expand_officers_to_venues(r.extract_officers(e), ids).count() == 10


def test_exclusion(spark):
    rows = spark.createDataFrame([(1, "FI", ["restructuring"], None, None, None), (2, "FI", ["bankruptcy"], None, None, None), (3, "FI", [], "2020", None, None), (4, "EE", None, None, None, "Kustutatud"), (5, "EE", None, None, None, None), (6, "FI", None, None, "CEASED", None)], "venue_id long, country string, situation_flags array<string>, endDate string, trade_status string, ee_status string")
    assert [x["exclusion_reason"] for x in r.register_exclusion(rows).orderBy("venue_id").collect()] == [None, "bankruptcy", "ceased", "inactive", None, "ceased"]
