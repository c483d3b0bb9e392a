from pyspark.sql import functions as F

from leadloom.functions.text import ee_ids, fi_id_valid, fi_ids, normalise_name, plausible_email, shared_inbox
from leadloom.operators import contacts as c
from leadloom.operators import sheet


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


def test_names(spark):
    for raw, want in (("Ravintola Åoi Oy", "aoi"), ("Kohvik OÜ", "kohvik"), ("OÜ", "ou"), (None, ""), ("Café  Ö-Baari!", "o")):
        assert one(spark, normalise_name(F.col("a")), a=raw) == want


def test_business_ids(spark):
    for raw, want in (("1234567-1", True), ("2468013-5", True), ("1234567-1", True), ("2345678-9", False), ("1234567-2", False), ("123456-7", False), (None, False)):
        assert one(spark, fi_id_valid(F.col("a")), a=raw) is want
    assert one(spark, fi_ids(F.col("a")), a="x 1234567-1, 1234567-1 and 2345678-9") == ["1234567-1"]
    assert one(spark, ee_ids(F.col("a")), a="Registrikood: 12345678") == ["12345678"]
    assert one(spark, ee_ids(F.col("a")), a="12345678 is our registry code") == ["12345678"]
    assert one(spark, ee_ids(F.col("a")), a="registrikood" + " x" * 40 + " 12345678") == []
    assert one(spark, ee_ids(F.col("a")), a="registrikood 92345678") == []


def test_plausible(spark):
    for raw, want in (("paavo@aoi.fi", True), ("logo@2x.png", False), ("x@sentry.io", False), ("x@cdn.shopify.com", False), ("noreply@aoi.fi", False), ("u0041@aoi.fi", False), ("a..b@aoi.fi", False), ("info@mysite.com", False), (None, False)):
        assert one(spark, plausible_email(F.col("a")), a=raw) is want
    assert one(spark, plausible_email(F.col("a"), own_domain="us.fi"), a="x@mail.us.fi") is False
    assert one(spark, shared_inbox(F.col("a")), a="info.hki@aoi.fi") is True


HTML = """<p>Rekisterinpitäjä Aoi Oy 1234567-1. Omistaja Paavo Kivela, <a href="mailto:paavo.kivela@aoi.fi?x=1">mail</a> paavo.kivela@aoi.fi</p>
<p>Myyntipäällikkö Saara Rinne saara (at) aoi [dot] fi</p><p>info@aoi.fi</p><a data-cfemail="7b1a3b1a14125515120e">x</a>
<a href="https://www.instagram.com/aoi_hki/">i</a><a href="https://facebook.com/sharer">s</a><p>logo@2x.png</p>"""


def test_harvest(spark):
    pages = spark.createDataFrame([(1, HTML), (2, None)], "page_id long, html string")
    got = {r["email"]: r for r in c.harvest_contacts(pages, ["page_id"]).collect()}
    assert got["paavo.kivela@aoi.fi"]["channel"] == "mailto" and got["paavo.kivela@aoi.fi"]["contact_name"] == "Paavo Kivela"
    assert got["saara@aoi.fi"]["channel"] == "obfuscated" and got["saara@aoi.fi"]["contact_name"] == "Saara Rinne" and got["saara@aoi.fi"]["contact_role"] == "sales manager"
    assert got["info@aoi.fi"]["contact_name"] is None and got["info@aoi.fi"]["confidence"] == "medium"
    assert "logo@2x.png" not in got
    assert [(r["platform"], r["handle"]) for r in c.harvest_socials(pages, ["page_id"]).collect()] == [("instagram", "aoi_hki")]
    assert [r["business_id"] for r in c.harvest_business_ids(pages, ["page_id"], F.col("html")).collect()] == ["1234567-1"]


INCOMING = "seq long, venue_id long, email string, contact_name string, contact_role string, source string, source_url string, confidence string, verification_status string"


def resolve(spark, rows, old=None):
    new = spark.createDataFrame([(k, 1, e, n, r, s, None, "high", None) for k, (e, n, r, s) in enumerate(rows)], INCOMING)
    return c.resolve_contacts(old if old is not None else spark.createDataFrame([], c.CONTACT), new)


def test_resolve(spark):
    got = resolve(spark, [(None, "Paavo Kivela", None, "register"), ("Paavo@aoi.fi", "paavo kivela", "owner", "privacy")]).collect()
    assert len(got) == 1 and got[0]["email"] == "paavo@aoi.fi" and got[0]["source"] == "privacy" and got[0]["contact_role"] == "owner" and got[0]["contact_name"] == "Paavo Kivela"
    got = resolve(spark, [("a@aoi.fi", "Paavo Kivela", None, "privacy"), (None, "Paavo Kivela", "owner", "register"), ("A@AOI.fi", None, None, "x"), ("b@aoi.fi", "Paavo Kivela", None, "x"), (None, None, None, "x"), ("", "", None, "x")]).orderBy("email").collect()
    assert [r["email"] for r in got] == ["a@aoi.fi", "b@aoi.fi"] and got[0]["contact_role"] == "owner" and got[0]["source"] == "privacy"


def test_resolve_again_changes_nothing(spark):
    rows = [("a@aoi.fi", "Paavo Kivela", None, "p"), (None, "Saara Rinne", "owner", "r"), ("saara@aoi.fi", "Saara Rinne", None, "p")]
    first = resolve(spark, rows)
    again = resolve(spark, rows, first)
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))


def test_screen_and_verdicts(spark):
    venues = spark.createDataFrame([(k, n) for k, n in ((1, "Aoi"), (2, "Kaislikko"), (3, "Hopeala"), (4, "Kitchen and Bar"))], "venue_id long, name string")
    sites = spark.createDataFrame([(1, "aoi.fi"), (2, "kaislikko.fi"), (3, "hopeala.ee"), (4, "kitchenandbar.fi")], "venue_id long, domain string")
    rows = [(1, "Paavo Kivela"), (2, "Kaislikko Helsinki"), (1, "Privacy Policy"), (1, "Gift Shoppe"), (2, "Gift Shoppe"), (3, "Gift Shoppe"), (1, "Saara Rinne"), (2, "Saara Rinne"), (3, "Saara Rinne"), (3, "Hopeala Tamm")]
    contacts = spark.createDataFrame([(v, n, "owner", f"x{k}@a.fi", "website") for k, (v, n) in enumerate(rows)], "venue_id long, contact_name string, contact_role string, email string, source string")
    matches = spark.createDataFrame([(1, "C1"), (2, "C1")], "venue_id long, business_id string")
    got = {(r["venue_id"], r["contact_name"]): r for r in c.name_screen(contacts, venues, sites, matches).collect()}
    assert got[1, "Paavo Kivela"]["hard"] == [] and got[1, "Paavo Kivela"]["soft"] is None
    assert got[2, "Kaislikko Helsinki"]["hard"] and got[1, "Privacy Policy"]["clean_name"] is None and got[3, "Hopeala Tamm"]["hard"]
    assert "group owner" in got[1, "Saara Rinne"]["soft"] and got[1, "Saara Rinne"]["email"]
    verdicts = spark.createDataFrame([("gift shoppe", "Gift Shoppe", 0, None), ("paavo kivela", "Paavo Kivela", 1, "Paavo V. Kivela")], "name_norm string, name string, is_person int, cleaned_name string")
    after = {(r["venue_id"], r["email"]): r for r in c.apply_verdicts(contacts, verdicts).collect()}
    assert after[1, "x3@a.fi"]["contact_name"] is None and after[1, "x3@a.fi"]["contact_role"] is None and after[1, "x0@a.fi"]["contact_name"] == "Paavo V. Kivela"
    left = [r["name"] for r in c.name_candidates(contacts, verdicts).collect()]
    assert left[0] == "Saara Rinne" and "Gift Shoppe" not in left
    assert c.unjudged_count(contacts, verdicts).first()["unjudged"] == len({n for _, n in rows}) - 2


def test_guesses(spark):
    f = lambda name, domain, known: one(spark, F.to_json(c.address_candidates(F.col("n"), F.col("d"), F.split("k", ","))), n=name, d=domain, k=known)
    assert f("Paavo Kivela", "www.aoi.fi", "") == '["paavo@aoi.fi","paavo.kivela@aoi.fi","p.kivela@aoi.fi","paavokivela@aoi.fi"]'
    assert f("Liisa Mäki", "aoi.fi", "paavo.kivela@aoi.fi").startswith('["liisa.maki@aoi.fi"')
    assert f("Matti", "aoi.fi", "") == "[]"
    given = spark.createDataFrame([("Sini",), ("Petri",)], "name string")
    rows = spark.createDataFrame([(1, "sini@a.fi", None), (2, "petri.salo@a.fi", None), (3, "info@a.fi", None), (4, "xx.salo@a.fi", None), (5, "petri@a.fi", "Kept")], "venue_id long, email string, contact_name string")
    assert [r["contact_name"] for r in c.names_from_addresses(rows, given).orderBy("venue_id").collect()] == ["Sini", "Petri Salo", None, None, "Kept"]
    words = spark.createDataFrame([("Anna-Sini Tamm",), ("Pärnu mnt",)], "name string")
    assert [(r["first_is_given"], r["is_address"]) for r in c.name_evidence(words, given).orderBy("name").collect()] == [(True, False), (False, True)]


def test_sheet(spark):
    rows = [(1, 1, None, "Olli Salo", "managing director", "register", "high", None), (1, 2, "guess@a.fi", None, None, "pattern_guess", "low", None), (1, 3, "info@a.fi", None, None, "website", "medium", None)]
    contacts = spark.createDataFrame(rows, "venue_id long, first_seq long, email string, contact_name string, contact_role string, source string, confidence string, verification_status string")
    eligible = spark.createDataFrame([(1, "Aoi", None, "helsinki", "FI", "+358 1", "u", None, None)], "venue_id long, name string, city string, city_slug string, country string, phone string, url string, international_phone string, company_name string")
    r = sheet.contact_sheet(eligible, contacts).first()
    assert (r["first_name"], r["email"], r["email_type"], r["city"], r["backup_email"], r["country"]) == ("Olli", "info@a.fi", "shared inbox", "Helsinki", "", "Finland") and len(r) == 13
