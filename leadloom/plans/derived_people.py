"""Queries of registers, contacts and venues on rows that Spark derives from suppliers, customers and orders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import contacts as c
from ..operators import quality as q
from ..operators import register as r
from ..operators import sheet as s
from ..operators import venues as v
from .catalog import query, table
from .derived_pages import customers, page_rows, text_of


def suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier")


def padded(n: Column) -> Column:
    return F.lpad(n.cast("string"), 4, "0")


def numbered(n: Column) -> Column:
    """Nine digits, so that no number is cut or begins with another; longer ones stay."""
    return F.when(n < 1_000_000_000, F.lpad(n.cast("string"), 9, "0")).otherwise(n.cast("string"))


# --- matching ---


@query("""
    WITH i AS (SELECT o_custkey AS venue_id, 'B' || o_orderkey % 40 AS business_id, CASE WHEN o_orderstatus = 'F' THEN 'checksum_valid' ELSE 'keyword_corroborated' END AS how FROM orders)
    SELECT venue_id, business_id, CAST(1.0 AS DOUBLE) AS confidence, 'business_id' AS method FROM (
        SELECT venue_id, business_id, row_number() OVER (PARTITION BY venue_id ORDER BY how <> 'checksum_valid', business_id) AS n
        FROM i JOIN customer ON c_custkey = venue_id WHERE business_id IN (SELECT 'B' || s_suppkey FROM supplier)) WHERE n = 1
""")
def matched_by_id(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("venue_id"), text_of("B", F.col("o_orderkey") % 40).alias("business_id"), F.when(F.col("o_orderstatus") == "F", "checksum_valid").otherwise("keyword_corroborated").alias("how"))
    return r.match_by_business_id(customers(spark, sf_dir).select(F.col("k").alias("venue_id")), ids, suppliers(spark, sf_dir).select(text_of("B", F.col("s_suppkey")).alias("business_id")))


@query("""
    SELECT c_custkey AS venue_id, min('B' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0')) AS business_id, CAST(0.85 AS DOUBLE) AS confidence, 'website' AS method
    FROM customer JOIN supplier ON s_suppkey % 50 = c_custkey % 50 AND s_suppkey % 4 > 0 WHERE c_custkey % 9 > 0 GROUP BY 1
""")
def matched_by_website(spark, sf_dir):
    venues = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.when(F.col("k") % 9 > 0, text_of("c", F.col("k") % 50, ".fi")).alias("domain"))
    site = F.when(F.col("s_suppkey") % 4 == 1, text_of("https://www.shop.c", F.col("s_suppkey") % 50, ".fi/x?y")).when(F.col("s_suppkey") % 4 == 2, text_of("C", F.col("s_suppkey") % 50, ".fi")).when(F.col("s_suppkey") % 4 == 3, text_of("http://c", F.col("s_suppkey") % 50, ".fi#z"))
    return r.match_by_website(venues, suppliers(spark, sf_dir).select(text_of("B", padded(F.col("s_suppkey"))).alias("business_id"), site.alias("website")))


_BY_NAME = """
    by_name AS (
        SELECT c_custkey AS venue_id, 'B' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS business_id,
            CAST(CASE WHEN c_custkey % 2 = 0 THEN 1.0 WHEN c_custkey % 3 = 0 THEN 0.95 ELSE 0.9 END AS DOUBLE) AS confidence, CASE WHEN c_custkey % 3 = 0 THEN 'name_address' ELSE 'name' END AS method
        FROM customer JOIN supplier ON s_suppkey = c_custkey)
"""


def _named(spark, sf_dir):
    """Venues and companies of one number: equal names for even ones, else one more word; one address for every third."""
    number = F.when(F.col("k") % 6 == 0, None).otherwise("12")
    venues = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), text_of("Ravintola Kalla", numbered(F.col("k")), " Oy").alias("name"), F.lit("katu").alias("street"), number.alias("number"), F.lit("FI-00100").alias("postcode"), F.lit(None).cast("string").alias("domain"))
    name = F.when(F.col("s_suppkey") % 2 == 0, text_of("kalla", numbered(F.col("s_suppkey")))).otherwise(text_of("kalla", numbered(F.col("s_suppkey")), " helsinki"))
    companies = suppliers(spark, sf_dir).select(text_of("B", padded(F.col("s_suppkey"))).alias("business_id"), F.array(name, F.lit("other")).alias("names_norm"), F.lit("katu").alias("street"), F.lit("12").alias("building_number"), F.when(F.col("s_suppkey") % 3 == 0, "00100").otherwise("00200").alias("post_code"), F.lit(None).cast("string").alias("website"))
    return venues, companies


@query(f"WITH {_BY_NAME} SELECT * FROM by_name")
def matched_by_name(spark, sf_dir):
    return r.match_by_name(*_named(spark, sf_dir))


@query(f"WITH {_BY_NAME} SELECT * FROM by_name")
def matched_estonian(spark, sf_dir):
    """The same companies with one name and an address line each."""
    venues, companies = _named(spark, sf_dir)
    line = companies.select("business_id", companies["names_norm"][0].alias("name_norm"), F.lit("Katu 12, Tallinn").alias("address"), "post_code")
    return r.match_ee(venues, line)


@query(f"""
    WITH {_BY_NAME}, first AS (SELECT c_custkey AS venue_id, 'B0001' AS business_id, CAST(1.0 AS DOUBLE) AS confidence, 'business_id' AS method FROM customer WHERE c_custkey % 10 = 0),
    second AS (SELECT * FROM by_name WHERE venue_id NOT IN (SELECT venue_id FROM first)),
    third AS (SELECT c_custkey AS venue_id, 'B0002' AS business_id, CAST(0.85 AS DOUBLE) AS confidence, 'website' AS method FROM customer WHERE c_custkey % 4 = 1 AND c_custkey NOT IN (SELECT venue_id FROM first) AND c_custkey NOT IN (SELECT venue_id FROM second)),
    found AS (SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third)
    SELECT c_custkey AS venue_id, business_id, coalesce(confidence, 0) AS confidence, coalesce(method, 'none') AS method, CAST(method IS NULL AS INTEGER) AS needs_review FROM customer LEFT JOIN found ON venue_id = c_custkey
""")
def registry_cascade(spark, sf_dir):
    """By id, then by name and address, then by website; what is left is for review."""
    venues, companies = _named(spark, sf_dir)
    venues = venues.withColumn("domain", F.when(F.col("venue_id") % 4 == 1, "kaksi.fi"))
    companies = companies.withColumn("website", F.when(F.col("business_id") == "B0002", "www.kaksi.fi"))
    ids = venues.where("venue_id % 10 = 0").select("venue_id", F.lit("B0001").alias("business_id"), F.lit("checksum_valid").alias("how"))
    return r.resolve_registry_match(venues, ids, companies)


# --- registers ---


@query("""
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '1') AS business_id, 'Aoi ' || s_suppkey || ' OÜ' AS name, 'aoi ' || s_suppkey AS name_norm, 'Registrisse kantud' AS status, '10' || s_suppkey % 900 AS post_code FROM supplier WHERE s_suppkey % 5 > 0
""")
def flattened_estonian(spark, sf_dir):
    code = F.when(F.col("s_suppkey") % 5 == 0, text_of("12", F.col("s_suppkey") % 9)).otherwise(text_of("EE", F.lpad(F.col("s_suppkey").cast("string"), 8, "1")))
    rows = suppliers(spark, sf_dir).select(code.alias("business_id"), text_of(" Aoi ", F.col("s_suppkey"), " OÜ").alias("name"), F.lit("Registrisse kantud ").alias("status"), F.lit("Tänav 1").alias("address"), text_of("EE-10", F.col("s_suppkey") % 900).alias("post_code"))
    return r.register_flatten_ee(rows).select("business_id", "name", "name_norm", "status", "post_code")


@query("""
    SELECT 'F' || s_suppkey AS business_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Ravintola Aoi' || s_suppkey || ' Oy' ELSE 'Sivu' || s_suppkey END AS primary_name,
        CASE WHEN s_suppkey % 2 = 0 THEN 'aoi' || s_suppkey ELSE 'sivu' || s_suppkey END AS name_norm, 'katu' AS street, CAST(s_suppkey % 30 AS VARCHAR) AS building_number, '00100' AS post_code, 'HELSINKI' AS post_office,
        'Ravintolat' AS main_business_desc, CAST(s_suppkey % 3 = 0 AS INTEGER) AS in_employer_register, CAST(s_suppkey % 4 = 0 AS INTEGER) AS vat_liable,
        CASE s_suppkey % 5 WHEN 0 THEN 'bankruptcy' WHEN 1 THEN 'restructuring' WHEN 2 THEN 'other' ELSE '' END AS situation_flags FROM supplier
""")
def flattened_finnish(spark, sf_dir):
    """Main names before others, visiting addresses before postal ones, the Finnish post office, entries that haven't ended."""
    from ..sources.readers import FI_COMPANY

    situation = F.when(F.col("s_suppkey") % 5 == 0, '[{"type":"KONKURSSI"}]').when(F.col("s_suppkey") % 5 == 1, '[{"type":"x","descriptions":[{"languageCode":"1","description":"Yrityssaneeraus"}]}]').when(F.col("s_suppkey") % 5 == 2, '[{"type":"SELV"}]').otherwise("[]")
    main = F.when(F.col("s_suppkey") % 2 == 0, text_of('{"name":"Ravintola Aoi', F.col("s_suppkey"), ' Oy","type":"1"},{"name":"Old","type":"1","endDate":"2020"}')).otherwise('{"name":" ","type":"1"}')
    raw = text_of(
        '{"businessId":"F', F.col("s_suppkey"), '","names":[{"name":"Sivu', F.col("s_suppkey"), '","type":"3"},', main, '],"mainBusinessLine":{"type":"56101","descriptions":[{"languageCode":"3","description":"Restaurants"},{"languageCode":"1","description":"Ravintolat"}]},',
        '"addresses":[{"type":2,"street":"PL","postCode":"00001"},{"type":1,"street":"Gatan","buildingNumber":"', F.col("s_suppkey") % 30, '","postCode":"FI-00100","postOffices":[{"city":"HELSINGFORS","languageCode":"2"},{"city":"HELSINKI","languageCode":"1"}]}],',
        '"registeredEntries":[{"type":"41","register":"7"', F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(',"endDate":"2021"'), '},{"type":"80","register":"6","status":"', F.when(F.col("s_suppkey") % 4 == 0, "1").otherwise("2"), '"}],"companySituations":', situation, "}",
    )
    rows = r.register_flatten_fi(suppliers(spark, sf_dir).select(F.from_json(raw, FI_COMPANY).alias("c")).select("c.*"))
    return rows.select("business_id", "primary_name", "name_norm", "street", "building_number", "post_code", "post_office", "main_business_desc", "in_employer_register", "vat_liable", F.array_join("situation_flags", ",").alias("situation_flags"))


@query("SELECT count(*) AS scanned, count(CASE WHEN s_suppkey % 2 = 0 THEN 1 END) AS kept, count(CASE WHEN s_suppkey % 4 = 0 THEN 1 END) AS with_website, CAST(count(CASE WHEN s_suppkey % 6 = 0 THEN 1 END) AS BIGINT) AS employers, TRUE AS website_usable FROM supplier")
def register_load(spark, sf_dir):
    kept = suppliers(spark, sf_dir).where(F.col("s_suppkey") % 2 == 0).select(F.when(F.col("s_suppkey") % 4 == 0, "w").alias("website"), (F.col("s_suppkey") % 3 == 0).cast("int").alias("in_employer_register"))
    return r.register_load_stats(suppliers(spark, sf_dir), kept).select("scanned", "kept", "with_website", "employers", "website_usable")


def _records(spark, sf_dir):
    """Person records by supplier: without a code, without a list, with an empty list, or with two people, one of whom has
    left or has no name."""
    n = F.col("s_suppkey") % 6
    other = F.when(n == 4, '{"eesnimi":"Rein","nimi_arinimi":"Lepp","lopp_kpv":"2020-01-01"}').otherwise('{"isiku_roll":"JUHL"}')
    people = text_of('"kaardile_kantud_isikud":[{"eesnimi":"Piret', F.col("s_suppkey"), '","nimi_arinimi":"Mets","isiku_roll":"JUHL"},', other, "]")
    own = F.when(n == 0, '{"nimi":"X"}').when(n == 1, text_of('{"ariregistri_kood":"', F.col("s_suppkey"), '","esindusoiguse_tavad":[{"x":"y"}]}')).when(n == 2, text_of('{"ariregistri_kood":"', F.col("s_suppkey"), '","isikud":[]}'))
    return suppliers(spark, sf_dir).select(F.try_parse_json(own.otherwise(text_of('{"ariregistri_kood":"', F.col("s_suppkey"), '",', people, "}"))).alias("record"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS business_id, 'Piret' || s_suppkey || ' Mets' AS person_name, 'JUHL' AS role FROM supplier WHERE s_suppkey % 6 > 2")
def current_people(spark, sf_dir):
    return r.current_persons(_records(spark, sf_dir))


@query("""
    WITH n AS (SELECT s_suppkey % 6 AS n FROM supplier)
    SELECT count(*) AS records, count(CASE WHEN n = 0 THEN 1 END) AS no_code, count(CASE WHEN n = 1 THEN 1 END) AS no_list, CAST(count(CASE WHEN n = 2 THEN 1 END) AS BIGINT) AS empty_lists,
        CAST(2 * count(CASE WHEN n > 2 THEN 1 END) AS BIGINT) AS people, count(CASE WHEN n IN (3, 5) THEN 1 END) AS no_name, count(CASE WHEN n = 4 THEN 1 END) AS ended, count(CASE WHEN n > 2 THEN 1 END) AS kept FROM n
""")
def person_losses(spark, sf_dir):
    return r.person_losses(_records(spark, sf_dir))


@query("""
    WITH n AS (SELECT s_suppkey % 6 AS n FROM supplier),
    k AS (SELECT 'record' AS level, unnest(CASE n WHEN 0 THEN ['nimi'] WHEN 1 THEN ['ariregistri_kood', 'esindusoiguse_tavad'] WHEN 2 THEN ['ariregistri_kood', 'isikud'] ELSE ['ariregistri_kood', 'kaardile_kantud_isikud'] END) AS json_key FROM n
        UNION ALL SELECT 'list', CASE n WHEN 2 THEN 'isikud' ELSE 'kaardile_kantud_isikud' END FROM n WHERE n > 1
        UNION ALL SELECT 'person', unnest(CASE n WHEN 4 THEN ['eesnimi', 'nimi_arinimi', 'isiku_roll', 'eesnimi', 'nimi_arinimi', 'lopp_kpv'] ELSE ['eesnimi', 'nimi_arinimi', 'isiku_roll', 'isiku_roll'] END) FROM n WHERE n > 2)
    SELECT level, json_key, count(*) AS n FROM k GROUP BY 1, 2
""")
def person_keys(spark, sf_dir):
    return r.person_keys(_records(spark, sf_dir))


def _order_records(spark, sf_dir):
    """A company for each customer, in the keys of one release or another, with its orders as people of the card: named in
    one of six ways, some without a name, some who have left."""
    o, one = table(spark, sf_dir, "orders"), lambda key, value: text_of(f'"{key}":"', value, '"')
    given, own = text_of("G", F.col("o_custkey")), text_of("S", F.col("o_orderkey"))
    ways = [(("eesnimi", given), ("nimi_arinimi", own)), (("first_name", given), ("last_name", own)), (("Given Name", given), ("Surname", own)), (("isiku_nimi", text_of(given, " ", own)),), (("Eesnimi", given), ("Perekonnanimi", own)), (("eesnimi", given), ("nimi", own))]
    named = F.coalesce(*[F.when(F.col("o_orderkey") % 6 == k, F.concat_ws(",", *[one(key, v) for key, v in way])) for k, way in enumerate(ways)])
    roles = F.concat_ws(",", one("isiku_roll", F.col("o_orderpriority")), F.when(F.col("o_totalprice") > 100_000, text_of('"isiku_roll_tekstina":"r', F.col("o_orderkey"), '"')))
    left = F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"), '"lopp_kpv":"1995"').otherwise('"lopp_kpv":""')
    person = text_of("{", F.concat_ws(",", F.when(F.col("o_orderstatus") != "P", named), F.lit('"kaardi_nr":[{"nr":1}]'), roles, left), "}")
    people = o.select("o_custkey", "o_orderkey", person.alias("person")).groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "person"))), lambda x: x["person"]), ",").alias("people"))
    rows = customers(spark, sf_dir).join(people, F.col("k") == F.col("o_custkey"), "left")
    code = F.when(F.col("c_nationkey") % 3 == 0, text_of('"ariregistri_kood":', F.col("k"))).when(F.col("c_nationkey") % 3 == 1, text_of('"Registrikood":"', F.col("k"), '"')).otherwise(text_of('"kood":"","registry_code":"', F.col("k"), '"'))
    key = F.element_at(F.array(*map(F.lit, ("kaardile_kantud_isikud", "Persons", "Kande isikud", "esindus"))), (F.col("c_nationkey") % 4 + 1).cast("int"))
    cards = F.when(F.col("people").isNotNull(), text_of('"', key, '":[', F.col("people"), ',"no object"]'))
    return rows.select(text_of("{", F.concat_ws(",", code, F.lit('"esindusoiguse_normaalregulatsioonid":[{"nimi":"Rule Two"}]'), cards, text_of('"Nimi":"', F.col("c_name"), '"')), "}").alias("record"))


_PEOPLE = """
    WITH p AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderkey % 6 = 5 THEN 'G' || o_custkey ELSE 'G' || o_custkey || ' S' || o_orderkey END END AS person_name,
        CASE WHEN o_totalprice > 100000 THEN 'r' || o_orderkey ELSE o_orderpriority END AS role, o_orderdate < DATE '1998-01-01' AS ended FROM orders)
    SELECT CAST(o_custkey AS VARCHAR) AS business_id, person_name, role, ended FROM p WHERE person_name IS NOT NULL
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, NULL, FALSE FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM p WHERE person_name IS NOT NULL)
"""


@query(_PEOPLE)
def people_of_all_releases(spark, sf_dir):
    """Every family of keys; a company none of whose people has a name is a person itself, one whose people have all left
    is not."""
    return r.register_persons(_order_records(spark, sf_dir))


@query(_PEOPLE)
def people_of_a_dump(spark, sf_dir):
    """The same records written as a dump to the shared checkpoint folder and read again by ranges of 64 KB."""
    from ..functions.components import ready_to_checkpoint
    from ..sources.readers import read_register_persons

    ready_to_checkpoint(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/dump-{uuid.uuid4().hex}"
    _order_records(spark, sf_dir).write.text(path)
    return r.register_persons(read_register_persons(spark, path, range_bytes=1 << 16))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS business_id, 'Piret Mets' AS person_name, CASE WHEN s_suppkey % 2 = 0 THEN 'board member' ELSE 'JUHL' END AS role FROM supplier WHERE s_suppkey % 3 = 0")
def board_names(spark, sf_dir):
    rows = suppliers(spark, sf_dir).select(F.col("s_suppkey").cast("string").alias("business_id"), F.when(F.col("s_suppkey") % 3 == 0, "Piret Mets").when(F.col("s_suppkey") % 3 == 1, "Firma OÜ").otherwise("Solo").alias("person_name"), F.when(F.col("s_suppkey") % 2 == 0, " ").otherwise("JUHL").alias("role"))
    return r.board_members(rows)


def _extracts(spark, sf_dir):
    text = text_of(
        "Aoi Oy 1234567-1\r\nToimitusjohtaja (Rekisteröity 09.01.2020 08:20:39)\nPuheenjohtaja Korpela Anna Liisa 01.02.1970\n", F.when(F.col("s_suppkey") % 2 == 0, "Toimitusjohtaja Korpela Anna Liisa 01.02.1970\n").otherwise(""), F.when(F.col("s_suppkey") % 3 == 0, "Varajäsen, Lahti Jussi 02.03.1980\n").otherwise(""),
        "Tilintarkastaja Audit Oy 05.05.1990\nJäsen Firma Ab 05.05.1990\nPuhelin 09 ", F.col("s_suppkey"), "\nPuhelin ", F.when(F.col("s_suppkey") % 5 == 0, "040 1").otherwise("-"), "\nSähköposti Info", F.col("s_suppkey"), "@Aoi.fi\n", F.when(F.col("s_suppkey") % 4 == 0, text_of("www-osoite www.x", F.col("s_suppkey"), ".fi\n")).otherwise(""),
    )
    return suppliers(spark, sf_dir).select(F.col("s_suppkey").cast("string").alias("business_id"), text.alias("text"))


_OFFICERS = """
    officers AS (SELECT CAST(s_suppkey AS VARCHAR) AS business_id, 'Anna Liisa Korpela' AS person_name, CASE WHEN s_suppkey % 2 = 0 THEN 'managing director' ELSE 'board chair' END AS role, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS INTEGER) AS rank FROM supplier
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'Jussi Lahti', 'deputy board member', CAST(4 AS INTEGER) FROM supplier WHERE s_suppkey % 3 = 0)
"""


@query(f"WITH {_OFFICERS} SELECT business_id, person_name, role, rank FROM officers")
def extracted_officers(spark, sf_dir):
    """The best role of each person; stamps, companies and auditors are left out."""
    return r.extract_officers(_extracts(spark, sf_dir)).select("business_id", "person_name", "role", "rank")


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS business_id, 'info' || s_suppkey || '@aoi.fi' AS email, CASE WHEN s_suppkey % 5 = 0 THEN '040 1' ELSE '09 ' || s_suppkey END AS phone, CASE WHEN s_suppkey % 4 = 0 THEN 'www.x' || s_suppkey || '.fi' END AS website FROM supplier
""")
def registered_contacts(spark, sf_dir):
    return r.extract_registered_contact(_extracts(spark, sf_dir))


@query(f"""
    WITH {_OFFICERS}, i AS (SELECT c_custkey AS venue_id, CAST(c_custkey % 8 AS VARCHAR) AS business_id FROM customer)
    SELECT venue_id, CAST(NULL AS VARCHAR) AS email, person_name AS contact_name, role AS contact_role, 'virre:' || lower(person_name) AS dedupe_key, 'register' AS source, 'high' AS confidence FROM i JOIN officers USING (business_id)
    UNION ALL SELECT venue_id, 'info' || business_id || '@aoi.fi', NULL, NULL, 'info' || business_id || '@aoi.fi', 'register', 'high' FROM i WHERE business_id IN (SELECT business_id FROM officers)
""")
def officer_contacts(spark, sf_dir):
    """A company's officers at each of its venues, and its filed address."""
    ids = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), (F.col("k") % 8).cast("string").alias("business_id"))
    e = _extracts(spark, sf_dir)
    return r.officers_to_contacts(r.extract_officers(e), r.extract_registered_contact(e), ids)


@query("""
    SELECT c_custkey AS venue_id, 'Piret Mets' AS contact_name, 'JUHL' AS contact_role, 'register' AS source, 'medium' AS confidence FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 7 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)
""")
def board_contacts(spark, sf_dir):
    matches = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.when(F.col("k") % 3 > 0, (F.col("k") % 7).cast("string")).alias("business_id"))
    board = suppliers(spark, sf_dir).where(F.col("s_suppkey") % 2 == 0).select(F.col("s_suppkey").cast("string").alias("business_id"), F.lit("Piret Mets").alias("person_name"), F.lit("JUHL").alias("role"))
    return r.board_contacts(matches, board).select("venue_id", "contact_name", "contact_role", "source", "confidence")


@query("SELECT DISTINCT 'B' || o_custkey AS business_id FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def pending_extracts(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(text_of("B", F.col("o_custkey")).alias("business_id"), F.when(F.col("o_orderstatus") == "F", "checksum_valid").otherwise("keyword_corroborated").alias("how"))
    return r.pending_extracts(ids, suppliers(spark, sf_dir).select(text_of("B", F.col("s_suppkey")).alias("business_id")))


# --- names ---


@query("""
    SELECT lower(replace(p_brand, '#', ' ')) AS name_norm, count(DISTINCT 'C' || o_custkey) AS n_companies, count(DISTINCT l_orderkey) AS n_venues, min('C' || o_custkey) AS company
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1
""")
def name_owners(spark, sf_dir):
    """Brands as names seen at orders, which are matched to their customers as companies."""
    contacts = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("venue_id"), F.col("p_brand").alias("contact_name"))
    matches = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("venue_id"), F.when(F.col("o_orderstatus") != "P", text_of("C", F.col("o_custkey"))).alias("business_id"))
    return c.group_owners(contacts, matches)


_WHO = """
    who AS (SELECT o_custkey AS venue_id, o_orderkey AS n, CASE o_orderkey % 8 WHEN 0 THEN 'Anna Korpela' WHEN 1 THEN 'ANNA KORPELA' WHEN 2 THEN 'Privacy Policy' WHEN 3 THEN 'Aoi Helsinki' WHEN 4 THEN 'Maija Rinne' WHEN 5 THEN 'Solo' WHEN 6 THEN 'Joulu Lounas' END AS contact_name,
        CASE WHEN o_orderkey % 3 = 0 THEN 'register' ELSE 'website' END AS source, 'x' || o_orderkey || '@a.fi' AS email FROM orders)
"""


def _who(spark, sf_dir):
    n = F.col("o_orderkey")
    name = F.when(n % 8 == 0, "Anna Korpela").when(n % 8 == 1, "ANNA KORPELA").when(n % 8 == 2, "Privacy Policy").when(n % 8 == 3, "Aoi Helsinki").when(n % 8 == 4, "Maija Rinne").when(n % 8 == 5, "Solo").when(n % 8 == 6, "Joulu Lounas")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("venue_id"), n.alias("n"), name.alias("contact_name"), F.lit("owner").alias("contact_role"), F.when(n % 3 == 0, "register").otherwise("website").alias("source"), text_of("x", n, "@a.fi").alias("email"))


@query(f"""
    WITH {_WHO}, sites AS (SELECT lower(contact_name) AS k, count(DISTINCT venue_id) AS n_sites FROM who WHERE contact_name IS NOT NULL GROUP BY 1)
    SELECT who.n, concat_ws('; ', CASE WHEN contact_name IN ('Privacy Policy', 'Aoi Helsinki', 'Solo', 'Joulu Lounas') THEN 'not a person-shaped name' END, CASE WHEN contact_name = 'Maija Rinne' AND venue_id % 2 = 0 THEN 'repeats the venue''s name' END,
            CASE WHEN lower(contact_name) = 'anna korpela' AND venue_id % 5 = 0 THEN 'shares a word with the site''s domain' END) AS hard,
        CASE WHEN n_sites >= 3 THEN 'at ' || n_sites || ' venues' END AS soft FROM who JOIN sites ON k = lower(contact_name)
""")
def screened_names(spark, sf_dir):
    """Hard and soft reasons against names; the given tables match no venue to a company here."""
    venues = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.when(F.col("k") % 2 == 0, "Maija Rinne Oy").otherwise("Kaislikko").alias("name"))
    sites = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.when(F.col("k") % 5 == 0, "korpela-x.fi").alias("domain"))
    rows = c.name_screen(_who(spark, sf_dir), venues, sites, venues.select("venue_id", F.lit(None).cast("string").alias("business_id")))
    return rows.select("n", F.array_join("hard", "; ").alias("hard"), "soft")


@query(f"""
    WITH {_WHO} SELECT lower(contact_name) AS name_key, min(contact_name) AS name, count(DISTINCT venue_id) AS venues, count(CASE WHEN source <> 'register' THEN 1 END) AS scraped FROM who
    WHERE contact_name IS NOT NULL AND lower(contact_name) <> 'solo' GROUP BY 1 HAVING count(CASE WHEN source <> 'register' THEN 1 END) > 0
""")
def name_candidates(spark, sf_dir):
    verdicts = table(spark, sf_dir, "region").select(F.lit("solo").alias("name_norm")).distinct()
    return c.name_candidates(_who(spark, sf_dir), verdicts).select("name_key", "name", "venues", "scraped")


@query(f"WITH {_WHO} SELECT count(DISTINCT lower(contact_name)) AS unjudged FROM who WHERE source <> 'register' AND lower(contact_name) <> 'solo'")
def unjudged(spark, sf_dir):
    return c.unjudged_count(_who(spark, sf_dir), table(spark, sf_dir, "region").select(F.lit("SOLO").alias("name")).distinct())


@query(f"""
    WITH {_WHO} SELECT n, CASE contact_name WHEN 'Joulu Lounas' THEN NULL WHEN 'Maija Rinne' THEN 'Maija K. Rinne' ELSE contact_name END AS contact_name, CASE WHEN contact_name = 'Joulu Lounas' THEN NULL ELSE 'owner' END AS contact_role, email FROM who
""")
def judged_names(spark, sf_dir):
    k = F.col("r_regionkey")
    verdicts = table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.when(k == 0, "joulu lounas").otherwise("maija rinne").alias("name_norm"), k.cast("int").alias("is_person"), F.when(k == 1, "Maija K. Rinne").alias("cleaned_name"))
    return c.apply_verdicts(_who(spark, sf_dir), verdicts).select("n", "contact_name", "contact_role", "email")


def _given(spark, sf_dir):
    return table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "Anna").otherwise("Maija").alias("name"))


@query("""
    WITH n AS (SELECT c_custkey, c_custkey % 5 AS k FROM customer)
    SELECT c_custkey, k IN (0, 1) AS first_is_given, k IN (0, 1, 2) AS any_is_given, k = 3 AS is_address,
        CASE WHEN k IN (0, 1) THEN 'first word is a known given name' ELSE 'first word is not in the given-name list' END || CASE WHEN k = 2 THEN '; but a later word is a given name' ELSE '' END || CASE WHEN k = 3 THEN '; contains a street-name ending' ELSE '' END AS hint FROM n
""")
def name_evidence(spark, sf_dir):
    n = F.col("k") % 5
    names = customers(spark, sf_dir).select("c_custkey", F.when(n == 0, "Ánna Korpela").when(n == 1, "Aino-Maija Rinne").when(n == 2, "Korpela Anna").when(n == 3, "Satamakatu").otherwise("Big Deal").alias("name"))
    return c.name_evidence(names, _given(spark, sf_dir)).select("c_custkey", "first_is_given", "any_is_given", "is_address", "hint")


@query("""
    SELECT c_custkey AS venue_id, CASE c_custkey % 5 WHEN 0 THEN 'Anna Korpela' WHEN 1 THEN 'Maija' WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 'Kept' END AS contact_name FROM customer
""")
def names_from_addresses(spark, sf_dir):
    n = F.col("k") % 5
    email = F.when(n == 0, "anna.korpela@a.fi").when(n == 1, "maija@a.fi").when(n == 2, "info@a.fi").when(n == 3, "xx.salo@a.fi").otherwise("anna@a.fi")
    rows = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), email.alias("email"), F.when(n == 4, "Kept").alias("contact_name"))
    return c.names_from_addresses(rows, _given(spark, sf_dir)).select("venue_id", "contact_name")


@query("""
    SELECT c_custkey AS venue_id, 'Anna Korpelä' AS contact_name, CASE WHEN c_custkey % 3 = 0 THEN 'anna.korpela@a0.fi' WHEN c_custkey % 3 = 1 THEN 'a.korpela@a1.fi' ELSE 'anna@a2.fi' END AS email, 'low' AS confidence, 'pattern_guess' AS source FROM customer WHERE c_custkey % 2 = 0
""")
def address_guesses(spark, sf_dir):
    """The shape that a domain's known addresses have."""
    people = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.lit("Anna Korpelä").alias("contact_name"), F.lit(None).cast("string").alias("email"))
    known = table(spark, sf_dir, "region").where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "x.yy@a0.fi").otherwise("x.y@a1.fi").alias("email"))
    known = known.withColumn("email", F.when(F.col("email") == "x.yy@a0.fi", "matti.salo@a0.fi").otherwise("m.salo@a1.fi"))
    sites = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), text_of("a", F.col("k") % 3, ".fi").alias("domain"))
    return c.address_patterns(people, people.where("venue_id % 2 = 0"), sites, known).select("venue_id", "contact_name", "email", "confidence", "source")


@query("""
    WITH s AS (SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'deliverable' WHEN '2' THEN 'accept_all' WHEN '3' THEN 'undeliverable' ELSE 'unknown' END AS verification_status FROM orders)
    SELECT *, CASE verification_status WHEN 'deliverable' THEN 'verified' WHEN 'accept_all' THEN 'catchall_guess' WHEN 'undeliverable' THEN 'low' ELSE 'unverified' END AS confidence FROM s
""")
def mapped_verification(spark, sf_dir):
    k = F.substring("o_orderpriority", 1, 1)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == "1", "OK").when(k == "2", "catch-all").when(k == "3", "invalid").alias("result"))
    return c.map_verification(rows).select("o_orderkey", "verification_status", "confidence")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Anna ' || c_mktsegment WHEN 1 THEN 'Maija Rinne' END AS registrant FROM customer")
def registrants(spark, sf_dir):
    n = F.col("k") % 4
    text = F.when(n == 0, text_of("domain: x\nRegistrant Name: Anna ", F.col("c_mktsegment"), " \nname: Other Person")).when(n == 1, "holder...: Solo\nperson: Maija Rinne").when(n == 2, "registrant: Redacted for privacy").otherwise("")
    return c.registrant_names(customers(spark, sf_dir).select("c_custkey", text.alias("text"))).select("c_custkey", "registrant")


@query("SELECT c_custkey, email FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'a@aoi.fi' WHEN 1 THEN 'logo@2x.png' WHEN 2 THEN 'noreply@aoi.fi' END AS email FROM customer) WHERE email IS NULL OR email = 'a@aoi.fi'")
def purged_contacts(spark, sf_dir):
    return c.purge_implausible(customers(spark, sf_dir).select("c_custkey", F.when(F.col("k") % 4 == 0, "a@aoi.fi").when(F.col("k") % 4 == 1, "logo@2x.png").when(F.col("k") % 4 == 2, "noreply@aoi.fi").alias("email")))


@query("""
    SELECT c_custkey AS venue_id, 'anna@aoi.fi' AS email, 'Anna Korpela' AS contact_name, 'jobad' AS source, 'medium' AS confidence FROM customer WHERE c_custkey % 2 = 0 AND (c_custkey % 3 = 0) = (c_custkey % 4 = 0)
""")
def jobad_contacts(spark, sf_dir):
    """Ads that name their venue, on a board of its country."""
    venues = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.col("c_name").alias("name"), F.when(F.col("k") % 3 == 0, "EE").otherwise("FI").alias("country"))
    text = text_of(F.when(F.col("k") % 2 == 0, F.upper("c_name")).otherwise("Nobody"), ": kysy Anna Korpela anna@aoi.fi")
    ads = page_rows(spark, sf_dir).select(F.col("k").alias("venue_id"), F.lit("u").alias("url"), F.when(F.col("k") % 4 == 0, "EE").otherwise("FI").alias("board_country"), text.alias("text"))
    return c.jobad_contacts(ads, venues).select("venue_id", "email", "contact_name", "source", "confidence")


# --- merged contacts ---


@query("""
    WITH r AS (SELECT o_orderkey AS seq, o_custkey % 50 AS venue_id, CASE WHEN o_orderkey % 3 <> 0 THEN 'a' || o_orderkey % 4 || '@x.fi' END AS email, CASE WHEN o_orderkey % 5 = 0 THEN 'owner' END AS role FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0),
    e AS (SELECT venue_id, email, min(seq) AS first_seq, min_by(role, CASE WHEN role IS NOT NULL THEN seq END) AS contact_role FROM r WHERE email IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT venue_id, min(seq) AS first_seq, min_by(role, CASE WHEN role IS NOT NULL THEN seq END) AS contact_role FROM r WHERE email IS NULL GROUP BY 1)
    SELECT venue_id, email, NULL AS contact_name, contact_role, email AS dedupe_key, first_seq FROM e
    UNION ALL SELECT venue_id, NULL, 'Anna Korpela', contact_role, 'name:anna korpela', first_seq FROM b
""")
def merged_contacts(spark, sf_dir):
    """Addresses without names, and one name without an address: neither takes the other's."""
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        n.alias("seq"), (F.col("o_custkey") % 50).alias("venue_id"), F.when(n % 3 != 0, text_of(" A", n % 4, "@x.fi")).alias("email"), F.when((n % 3 == 0) & (n % 2 == 0), "Anna Korpela").alias("contact_name"),
        F.when(n % 5 == 0, "owner").alias("contact_role"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("source_url"), F.lit("high").alias("confidence"), F.lit(None).cast("string").alias("verification_status"))
    return c.resolve_contacts(spark.createDataFrame([], c.CONTACT), rows).select("venue_id", "email", "contact_name", "contact_role", "dedupe_key", "first_seq")


@query("""
    WITH b AS (SELECT o_custkey AS venue_id, min(o_orderkey) AS bare FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1),
    n AS (SELECT o_custkey AS venue_id, o_orderkey AS seq, 'p' || o_orderkey || '@x.fi' AS email FROM orders WHERE o_orderkey % 4 = 1),
    t AS (SELECT n.venue_id, min(seq) AS since FROM n GROUP BY 1),
    alone AS (SELECT b.venue_id, bare FROM b LEFT JOIN t USING (venue_id) WHERE since IS NULL OR bare < since),
    p AS (SELECT n.venue_id, min(seq) AS taken FROM n JOIN alone USING (venue_id) WHERE seq > bare GROUP BY 1)
    SELECT alone.venue_id, CASE WHEN taken IS NOT NULL THEN 'p' || taken || '@x.fi' END AS email, CASE WHEN taken IS NOT NULL THEN 'page' ELSE 'register' END AS source, bare AS first_seq FROM alone LEFT JOIN p USING (venue_id)
    UNION ALL SELECT n.venue_id, email, 'page', seq FROM n LEFT JOIN p USING (venue_id) WHERE taken IS NULL OR seq <> taken
""")
def promoted_contacts(spark, sf_dir):
    """One name at every venue: known from the register first, it takes the first address that comes after."""
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").where(n % 4 < 2).select(
        n.alias("seq"), F.col("o_custkey").alias("venue_id"), F.when(n % 4 == 1, text_of("p", n, "@x.fi")).alias("email"), F.lit("Anna Korpela").alias("contact_name"), F.lit(None).cast("string").alias("contact_role"),
        F.when(n % 4 == 1, "page").otherwise("register").alias("source"), F.lit(None).cast("string").alias("source_url"), F.lit("high").alias("confidence"), F.lit(None).cast("string").alias("verification_status"))
    return c.resolve_contacts(spark.createDataFrame([], c.CONTACT), rows).select("venue_id", "email", "source", "first_seq")


# --- venues and reports ---


@query("""
    SELECT c_custkey AS venue_id FROM customer WHERE c_custkey % 3 > 0 AND NOT (c_custkey % 4 = 0)
""")
def eligible_venues(spark, sf_dir):
    rows = customers(spark, sf_dir).select(F.col("k").alias("venue_id"))
    matches = rows.where("venue_id % 2 = 0 OR venue_id % 3 = 0").select("venue_id", F.when(F.col("venue_id") % 3 == 0, "ceased").alias("exclusion_reason"), F.lit("c").alias("company_name"))
    places = rows.where("venue_id % 2 = 0").select("venue_id", F.when(F.col("venue_id") % 4 == 0, "CLOSED_PERMANENTLY").otherwise("OPERATIONAL").alias("business_status"), F.lit("+358").alias("international_phone"))
    return v.outreach_eligible(rows, matches, places).select("venue_id")


@query("""
    SELECT c_custkey AS venue_id, 'c' || c_custkey || '.fi' AS domain, 'https://www.c' || c_custkey || '.fi' AS base_url FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 > 0 AND c_custkey % 5 > 0
""")
def seeded_sites(spark, sf_dir):
    site = F.when(F.col("k") % 3 == 0, "ftp://x.fi").otherwise(text_of("HTTPS://www.c", F.col("k"), ".fi/a?b"))
    rows = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), (F.col("k") % 2 == 0).alias("accepted"), site.alias("website"), F.when(F.col("k") % 5 == 0, "CLOSED_PERMANENTLY").alias("business_status"))
    return v.seed_sites(rows)


@query("""
    WITH p AS (SELECT o_custkey AS venue_id, CAST(o_orderkey % 3 AS INTEGER) AS query_no, o_orderstatus = 'F' AS accepted, o_orderkey % 7 / 7.0 AS similarity, CAST(o_orderkey AS VARCHAR) AS id FROM orders),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY venue_id, query_no ORDER BY accepted DESC, similarity DESC, id) AS n FROM p) WHERE n = 1),
    best AS (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY CASE WHEN accepted THEN 0 ELSE 1 END, CASE WHEN accepted THEN query_no ELSE -query_no END) AS m FROM top)
    SELECT venue_id, query_no, accepted, id FROM best WHERE m = 1
""")
def chosen_places(spark, sf_dir):
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("venue_id"), (n % 3).cast("int").alias("query_no"), (F.col("o_orderstatus") == "F").alias("accepted"), (n % 7 / 7.0).alias("similarity"), F.struct(n.cast("string").alias("id")).alias("place"))
    return v.best_place(rows).select("venue_id", "query_no", "accepted", F.col("place.id").alias("id"))


@query("SELECT c_custkey AS venue_id, 'C' || c_custkey % 20 AS business_id, CAST(c_custkey % 2 AS INTEGER) AS in_employer_register, CASE WHEN c_custkey % 20 < 10 THEN CAST(3 AS INTEGER) END AS venue_count FROM customer")
def scored_venues(spark, sf_dir):
    rows = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), text_of("C", F.col("k") % 20).alias("business_id"), (F.col("k") % 2).cast("int").alias("in_employer_register"))
    groups = rows.where("venue_id % 20 < 10").select("business_id", F.lit(3).alias("venue_count")).distinct()
    return v.scored_venues(rows.select("venue_id"), rows, groups).select("venue_id", "business_id", "in_employer_register", "venue_count")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 2")
def work_to_retry(spark, sf_dir):
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(n % 3 == 0, "error").when(n % 3 == 2, "done").alias("status"))
    return v.pending_status(rows, "status", ("error",)).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1 ORDER BY c_custkey LIMIT 25")
def first_odd_customers(spark, sf_dir):
    return v.limit_first_n(customers(spark, sf_dir).where("c_custkey % 2 = 1").select("c_custkey"), "c_custkey", 25)


@query("""
    SELECT 'country:' || CASE c_custkey % 3 WHEN 0 THEN 'FI' WHEN 1 THEN 'EE' ELSE 'none' END AS measure, count(*) AS n FROM customer GROUP BY 1
    UNION ALL SELECT 'phone', count(CASE WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 0 THEN 1 END) FROM customer UNION ALL SELECT 'address', count(CASE WHEN c_acctbal > 0 THEN 1 END) FROM customer
    UNION ALL SELECT 'site', count(*) FROM customer UNION ALL SELECT 'crawled', count(CASE WHEN c_custkey % 4 = 0 THEN 1 END) FROM customer
    UNION ALL SELECT 'any_email', count(DISTINCT CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END) FROM orders UNION ALL SELECT 'named', count(DISTINCT CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 < 2 THEN o_custkey END) FROM orders
""")
def coverage(spark, sf_dir):
    from .catalog import _contacts

    country = F.when(F.col("k") % 3 == 0, "FI").when(F.col("k") % 3 == 1, "EE")
    venues = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), country.alias("country"), F.when(F.col("k") % 2 == 0, "1").alias("phone"), F.when(F.col("c_acctbal") > 0, "s").alias("street_address"))
    places = customers(spark, sf_dir).where("k % 5 = 0").select(F.col("k").alias("venue_id"), F.lit("+358").alias("international_phone"))
    sites = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.lit("d").alias("domain"), F.when(F.col("k") % 4 == 0, "done").alias("crawl_status"))
    return q.coverage_report(venues, places, sites, _contacts(spark, sf_dir))


@query("SELECT o_orderpriority AS tier, o_orderstatus AS crawl_status, count(*) AS n FROM orders GROUP BY 1, 2")
def tier_statuses(spark, sf_dir):
    return q.tier_status_counts(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("tier"), F.col("o_orderstatus").alias("crawl_status")))


@query("SELECT l_returnflag AS method, count(*) AS n FROM lineitem GROUP BY 1")
def match_methods(spark, sf_dir):
    return q.match_method_counts(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("method")))


@query("SELECT count(CASE WHEN c_custkey % 2 = 1 THEN 1 END) AS employers, count(CASE WHEN c_custkey % 3 = 0 THEN 1 END) AS excluded, (SELECT count(*) FROM nation) AS groups, CAST((SELECT sum(n_regionkey) FROM nation) AS BIGINT) AS venues_in_groups FROM customer")
def register_sums(spark, sf_dir):
    matches = customers(spark, sf_dir).select((F.col("k") % 2).cast("int").alias("in_employer_register"), F.when(F.col("k") % 3 == 0, "ceased").alias("exclusion_reason"))
    return q.register_totals(matches, table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("venue_count")))


@query("""
    SELECT 'contacts:' || CASE WHEN o_orderstatus = 'P' THEN 'pattern_guess' ELSE 'website' END AS measure, count(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT 'judged', count(*) FROM labels UNION ALL SELECT 'people', count(CASE WHEN quality = 1 THEN 1 END) FROM labels UNION ALL SELECT 'companies_loaded', count(*) FROM supplier UNION ALL SELECT 'venues_matched', count(CASE WHEN c_custkey % 2 = 0 THEN 1 END) FROM customer
""")
def enrichment(spark, sf_dir):
    from .catalog import _contacts

    verdicts = table(spark, sf_dir, "labels").select(F.col("quality").alias("is_person"))
    return q.enrichment_counts(_contacts(spark, sf_dir), verdicts, suppliers(spark, sf_dir), customers(spark, sf_dir).select(F.when(F.col("k") % 2 == 0, "b").alias("business_id")))


@query("""
    WITH k AS (SELECT o_orderkey AS n FROM orders)
    SELECT n, CASE WHEN n % 7 = 0 THEN '' WHEN n % 7 = 1 THEN 'catch-all (unconfirmed)' WHEN n % 7 = 2 THEN 'verified' WHEN n % 7 = 3 THEN 'guessed' WHEN n % 7 = 4 THEN 'shared inbox' ELSE 'personal' END AS email_type FROM k
""")
def email_types(spark, sf_dir):
    n = F.col("o_orderkey")
    m = n % 7
    rows = table(spark, sf_dir, "orders").select(
        n.alias("n"), F.when(m == 0, None).when(m == 4, "info.hki@a.fi").otherwise("anna@a.fi").alias("email"), F.when((m == 1) & (n % 2 == 0), "accept_all").when((m == 2) & (n % 2 == 0), "deliverable").alias("verification_status"),
        F.when((m == 1) & (n % 2 == 1), "catchall_guess").when((m == 2) & (n % 2 == 1), "verified").otherwise("high").alias("confidence"), F.when(m == 3, "pattern_guess").otherwise("website").alias("source"))
    return rows.select("n", s.email_type().alias("email_type"))


@query("""
    WITH c AS (SELECT o_custkey AS venue_id, o_orderkey AS first_seq, CASE WHEN o_orderkey % 5 < 2 THEN 'N' || o_orderkey END AS contact_name,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 WHEN '4' THEN 3 ELSE 4 END AS o FROM orders)
    SELECT venue_id, first_seq, contact_name FROM (SELECT *, row_number() OVER (PARTITION BY venue_id ORDER BY o, first_seq % 3 = 0, first_seq) AS n FROM c WHERE contact_name IS NOT NULL) WHERE n = 1
""")
def best_named(spark, sf_dir):
    from .catalog import _contacts

    return s.best_named_contact(_contacts(spark, sf_dir)).select("venue_id", "first_seq", "contact_name")


@query("""
    WITH c AS (SELECT o_custkey AS venue_id, o_orderkey AS first_seq, 'p' || o_orderkey || '@x.fi' AS email, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE 1 END,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 WHEN '4' THEN 3 ELSE 4 END, o_orderkey) AS n FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT venue_id, first_seq, email, 'y.fi' AS site_domain FROM c WHERE n = 1 AND venue_id % 3 = 1
""")
def off_domain_chosen(spark, sf_dir):
    from .catalog import _contacts

    sites = customers(spark, sf_dir).select(F.col("k").alias("venue_id"), F.when(F.col("k") % 3 == 0, "x.fi").when(F.col("k") % 3 == 1, "Y.fi").alias("domain"))
    return c.off_domain_chosen(_contacts(spark, sf_dir), sites).select("venue_id", "first_seq", "email", "site_domain")
