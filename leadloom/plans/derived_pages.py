"""Queries of page jobs on pages that Spark writes from customers: one of each kind that the jobs tell apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import host_of
from ..operators import contacts as c
from ..operators import pages as p
from .catalog import query, table


def text_of(*parts: Column | str) -> Column:
    """Concatenation of columns and literal texts."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))


def page_rows(spark, sf_dir):
    """Customers of which pages are made. A split of their file holds many more of them than one of stored pages does, so
    they are dealt to all cores first."""
    parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return customers(spark, sf_dir).repartition(parts, "k")


@query("""
    WITH s AS (SELECT c_custkey AS page_id, CASE c_custkey % 8 WHEN 0 THEN 'wordpress' WHEN 1 THEN 'squarespace' WHEN 2 THEN 'wix' WHEN 7 THEN 'shopify' ELSE 'unknown' END AS cms,
        c_custkey % 8 IN (3, 5) OR c_custkey % 16 = 6 AS is_blocked, c_custkey % 8 = 4 AS is_shell FROM customer)
    SELECT *, CASE WHEN is_blocked THEN 'last_resort' WHEN cms IN ('wordpress', 'squarespace') THEN 'api' WHEN cms = 'wix' OR is_shell THEN 'render' ELSE 'static' END AS tier FROM s
""")
def crawl_tier_kinds(spark, sf_dir):
    n = F.col("k") % 8
    marker = F.when(n == 0, '<link href="/wp-content/x.css">').when(n == 1, '<script src="https://static1.squarespace.com/a.js"></script>').when(n == 2, '<img src="https://static.wixstatic.com/x.png">')
    marker = marker.when(n == 3, "<p>Attention Required</p>").when(n == 7, '<script src="https://cdn.shopify.com/s.js"></script>').otherwise("")
    body = F.when(n == 4, F.repeat("c_name", F.lit(2))).otherwise(F.repeat("c_name", F.lit(40)))
    status = F.when(n == 5, 403).when(F.col("k") % 16 == 6, 503).otherwise(200)
    pages = page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), status.alias("http_status"), text_of("<html><body>", marker, "<p>", body, "</p></body></html>").alias("html"))
    rows = p.blocked_or_shell(pages).withColumn("cms", p.detect_cms(F.col("html")))
    return p.crawl_tier(rows).select("page_id", "cms", "is_blocked", "is_shell", "tier")


@query("""
    WITH links AS (
        SELECT c_custkey AS page_id, 'https://www.c' || c_custkey || '.fi' AS site, c_custkey AS k FROM customer),
    kinds AS (
        SELECT page_id, site || '/tietosuoja' AS link, 'privacy' AS kind, 1 AS priority FROM links WHERE k % 2 = 0
        UNION ALL SELECT page_id, site || '/p' || k % 5, 'contact', 5 FROM links UNION ALL SELECT page_id, site || '/meista', 'about', 6 FROM links
        UNION ALL SELECT page_id, site || '/tyopaikat', 'careers', 3 FROM links WHERE k % 3 = 0 UNION ALL SELECT page_id, site || '/x', 'events', 2 FROM links
        UNION ALL SELECT page_id, site, 'home', 4 FROM links UNION ALL SELECT page_id, site || '/menu', 'other', 9 FROM links)
    SELECT page_id, link, kind, CAST(priority AS INTEGER) AS priority, CAST(row_number() OVER (PARTITION BY page_id ORDER BY priority, link) AS INTEGER) AS rank FROM kinds
""")
def rank_link_kinds(spark, sf_dir):
    """Kinds by anchors and by paths; files, administration and other hosts don't count."""
    some = text_of(
        F.when(F.col("k") % 2 == 0, '<a href="/tietosuoja">Tietosuojaseloste</a>').otherwise(""), text_of('<a href="/p', F.col("k") % 5, '">Yhteystiedot</a><a class="b" href=\'/meista/\'>Me</a>'),
        F.when(F.col("k") % 3 == 0, '<a href="/tyopaikat">Avoimet</a>').otherwise(""), '<a href="/x#top">Juhlat ja muut</a><a href="/">Etusivu</a><a href="/menu"><img></a><a href="/liite.pdf">Privacy</a><a href="https://other.fi/privacy">Privacy</a><a href="/wp-admin/x">Menu</a>',
    )
    pages = page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), text_of("https://www.c", F.col("k"), ".fi/fi").alias("url"), some.alias("html"))
    links = p.page_links(pages)
    return p.rank_links(links.where(p.crawlable(F.col("link"), host_of(F.col("url")))), "page_id")


@query("""
    WITH l AS (SELECT c_custkey AS probed_id, CASE WHEN c_custkey % 11 <> 0 THEN c_name || CASE WHEN c_custkey % 2 = 0 THEN '-Lizard' ELSE '' END END AS title, 'Desc ' || c_custkey AS description,
        'en' AS lang, lower(c_mktsegment) AS city_slug, 'c' || c_custkey AS venue_slug, c_custkey + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS listing_id, c_custkey + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS image_id FROM customer)
    SELECT *, title IS NULL AS refused, nullif(concat_ws('; ', CASE WHEN c_image THEN 'image id mismatch' END, CASE WHEN c_own THEN 'canonical id mismatch' END), '') AS review_reason, CAST(c_image OR c_own AS INTEGER) AS needs_review
    FROM (SELECT *, image_id <> probed_id AS c_image, listing_id <> probed_id AS c_own FROM l)
""".replace("SELECT *, title IS NULL AS refused", "SELECT probed_id, title, description, lang, city_slug, venue_slug, listing_id, image_id, title IS NULL AS refused"))
def listing_fields(spark, sf_dir):
    """Titles with hyphens keep them; the site's name goes."""
    title = F.when(F.col("k") % 11 == 0, "").otherwise(text_of(F.col("c_name"), F.when(F.col("k") % 2 == 0, "-Lizard | Site").otherwise(" | site ")))
    own, image = F.col("k") + (F.col("k") % 7 == 0).cast("int"), F.col("k") + (F.col("k") % 5 == 0).cast("int")
    html = text_of('<META content="', title, '" property="og:title"><meta property="og:description" content="Desc ', F.col("k"), '"><link href=\'https://x.fi/en/', F.lower("c_mktsegment"), "/c", F.col("k"), "/", own, '\' rel="canonical"><meta property=og:image content="/a/restaurant/', image, '/x.jpg">')
    rows = p.listing_guards(p.listing_meta(page_rows(spark, sf_dir).select(F.col("k").alias("probed_id"), html.alias("html")), site="Site"))
    return rows.select("probed_id", "title", "description", "lang", "city_slug", "venue_slug", "listing_id", "image_id", "refused", "review_reason", "needs_review")


def _ld(*nodes: Column) -> Column:
    return text_of('<script type="application/ld+json">{"@graph":[', F.concat_ws(",", *nodes), "]}</script>")


@query("""
    SELECT c_custkey AS page_id, CASE c_custkey % 3 WHEN 0 THEN 'Own' WHEN 1 THEN 'Second' ELSE 'Bar' END AS name, CASE c_custkey % 3 WHEN 1 THEN '1' WHEN 2 THEN '2' END AS telephone,
        CAST(CASE c_custkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 0 ELSE 1 END AS INTEGER) AS type_rank FROM customer
""")
def jsonld_choice(spark, sf_dir):
    """The page's own id comes first; an id that only contains it doesn't count; then the type; then the substance."""
    own = F.when(F.col("k") % 3 == 0, text_of('{"@type":"LocalBusiness","@id":"https://x.fi/v/', F.col("k"), '/","name":"Own"}'))
    first = F.when(F.col("k") % 3 < 2, text_of('{"@type":["Thing","Restaurant"],"@id":"/v/1', F.col("k"), '","name":"First","url":"u","image":"i"}'))
    second = F.when(F.col("k") % 3 < 2, text_of('{"@type":"Restaurant","@id":"/v/2', F.col("k"), '","name":"Second","telephone":"1"}'))
    bar = F.lit('{"@type":"Bar","name":"Bar","telephone":"2","menu":"m"}')
    place = F.lit('{"@type":"Organization","name":"Org","telephone":"3","menu":"m","address":{"streetAddress":"K 1"}}')
    pages = page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), _ld(own, first, second, bar, place).alias("html"))
    return p.best_jsonld_node(p.jsonld_nodes(pages), wanted_id="page_id").select("page_id", "name", "telephone", "type_rank")


@query("""
    SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 0 THEN '040 ' || c_custkey WHEN 1 THEN '+35840' || c_custkey WHEN 2 THEN '+358 9 12345' || c_custkey % 10 END AS phone,
        CASE c_custkey % 4 WHEN 0 THEN 'Katu ' || c_custkey WHEN 1 THEN 'Tie ' || c_custkey || ', Turku' WHEN 2 THEN 'Kauppatori 1' END AS street, CASE c_custkey % 4 WHEN 0 THEN '00100' WHEN 2 THEN '20100' END AS postcode,
        CASE WHEN c_custkey % 4 = 0 THEN CAST(4.5 AS DOUBLE) END AS rating, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 9 AS INTEGER) END AS reviews, CASE WHEN c_custkey % 4 = 0 THEN 'sushi' ELSE '' END AS tags, CAST(c_custkey % 5 = 0 AS INTEGER) AS is_michelin,
        CASE c_custkey % 4 WHEN 0 THEN 'phone:jsonld+postcode:jsonld' WHEN 1 THEN 'phone:tel' WHEN 2 THEN 'phone:text+postcode:text' ELSE '' END AS trace FROM customer
""")
def detail_fields(spark, sf_dir):
    """Structured data first, then links to telephones and maps, then the text; coordinates are no address."""
    n = F.col("k") % 4
    ld = _ld(text_of('{"@type":"Restaurant","telephone":"040 ', F.col("k"), '","servesCuisine":["sushi","sushi"],"address":{"streetAddress":"Katu ', F.col("k"), '","postalCode":"00100"},"aggregateRating":{"ratingValue":"4.5","reviewCount":', F.col("k") % 9, "}}"))
    tel = text_of('<a href="tel:+35840', F.col("k"), '">x</a><a href="https://www.google.com/maps/search/?api=1&query=Tie%20', F.col("k"), '%2C+Turku">m</a>')
    seen = text_of("<p>+358 9 12345", F.col("k") % 10, ', 20100 Turku</p><a href="https://maps.google.fi/?q=60.1,24.9">m</a><a href="https://google.fi/maps/place/Kauppatori+1/@60">m</a>')
    html = text_of(F.when(n == 0, ld).when(n == 1, tel).when(n == 2, seen).otherwise('<a href="https://maps.google.fi/?q=60.1,24.9">m</a>'), F.when(F.col("k") % 5 == 0, "<p>A Michelin star</p>").otherwise(""))
    rows = p.detail_fields(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), html.alias("html")))
    return rows.select("page_id", "phone", "street", "postcode", "rating", "reviews", F.array_join("tags", ",").alias("tags"), "is_michelin", F.array_join("trace", "+").alias("trace"))


@query("""
    SELECT c_custkey AS page_id, CAST(c_custkey % 3 AS INTEGER) AS ld_blocks, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Bar' ELSE 'Bar,Hotel' END AS ld_types, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'name' ELSE 'menu,name' END AS ld_keys,
        CAST(c_custkey % 2 AS INTEGER) AS tel_links, CAST(1 AS INTEGER) AS map_links, c_name || ' m' AS opening FROM customer
""")
def page_profiles(spark, sf_dir):
    block = '<script type="application/ld+json">{"@type": "%s", "%s": "x"}</script>'
    html = text_of(F.when(F.col("k") % 3 > 0, block % ("Bar", "name")).otherwise(""), F.when(F.col("k") % 3 > 1, block % ("Hotel", "menu")).otherwise(""), "<h1>", F.col("c_name"), "</h1>", F.when(F.col("k") % 2 == 1, '<a href="tel:1"></a>').otherwise(""), '<a href="https://maps.google.fi/?q=x">m</a>')
    rows = p.page_profile(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), html.alias("html")))
    return rows.select("page_id", "ld_blocks", F.array_join("ld_types", ",").alias("ld_types"), F.array_join("ld_keys", ",").alias("ld_keys"), "tel_links", "map_links", "opening")


@query("""
    WITH l AS (SELECT c_custkey AS page_id, unnest(range(0, CAST(c_custkey % 4 AS BIGINT))) AS n FROM customer)
    SELECT page_id, CAST(n AS INTEGER) AS pos, 'https://c' || page_id || '.fi/' || n AS link FROM l
    UNION ALL SELECT c_custkey, CAST(-1 AS INTEGER), 'https://c' || c_custkey || '.fi/home' FROM customer
""")
def sitemap_and_home_links(spark, sf_dir):
    """A sitemap's distinct lines, along with the home page's link."""
    line = lambda n: text_of("<url><loc> https://c", F.col("k"), ".fi/", n, " </loc></url>")
    body = text_of(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda n: F.when(n < F.col("k") % 4, line(n)).otherwise("")), ""), F.when(F.col("k") % 4 > 0, line(F.lit(0))).otherwise(""))
    maps = p.sitemap_urls(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), body.alias("body")), "body", 10)
    home = page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), F.lit(-1).alias("pos"), text_of("https://c", F.col("k"), ".fi/home").alias("link"))
    return p.page_union(maps, home)


@query("""
    SELECT c_custkey AS id, 'u' || c_custkey AS url, 't' || c_custkey AS title, '<p>' || c_name || '</p>' AS html FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, '/i', 's', 'b' || c_custkey FROM customer WHERE c_custkey % 3 = 1
""")
def cms_pages(spark, sf_dir):
    """Pages in two content systems' answers; a third of the answers are no JSON."""
    posts = text_of('[{"link":"u', F.col("k"), '","title":{"rendered":"t', F.col("k"), '"},"content":{"rendered":"<p>', F.col("c_name"), '</p>"}}]')
    items = text_of('{"items":[{"fullUrl":"/i","title":"s","body":"b', F.col("k"), '"}]}')
    return p.flatten_cms_api(page_rows(spark, sf_dir).select(F.col("k").alias("id"), F.when(F.col("k") % 3 == 0, posts).when(F.col("k") % 3 == 1, items).otherwise("<html>").alias("body")))


@query("""
    SELECT c_custkey AS venue_id, CAST(NULL AS VARCHAR) AS email, 'Anna ' || c_mktsegment AS contact_name, 'website_cms_user' AS source, 'low' AS confidence FROM customer WHERE c_custkey % 2 = 0
""")
def cms_user_contacts(spark, sf_dir):
    body = F.when(F.col("k") % 2 == 0, text_of('[{"name":" Anna ', F.col("c_mktsegment"), '"},{"name":"admin"}]')).otherwise("[]")
    users = p.cms_user_names(page_rows(spark, sf_dir).select(F.col("k").alias("venue_id"), F.lit("u").alias("url"), body.alias("body")))
    return c.cms_user_contacts(users).select("venue_id", "email", "contact_name", "source", "confidence")


@query("""
    SELECT DISTINCT 'sitemap' AS kind, 'https://c' || c_custkey % 20 || '.fi/s.xml' AS value FROM customer
    UNION SELECT 'city_slug', lower(c_mktsegment) FROM customer UNION SELECT 'api_path', '/api/v' || c_custkey % 7 || '/x' FROM customer
""")
def discovered(spark, sf_dir):
    body = text_of("User-agent: *\nSitemap: https://c", F.col("k") % 20, '.fi/s.xml\n<a href="/en/', F.lower("c_mktsegment"), '/">x</a><a href="/blog/">b</a>"/api/v', F.col("k") % 7, '/x"')
    return p.discovery_scan(page_rows(spark, sf_dir).select(body.alias("body")))


@query("""
    SELECT c_custkey AS page_id, 'fi' || c_custkey || '@aoi.fi' AS email, 'mailto' AS channel, 'high' AS confidence, CAST(NULL AS VARCHAR) AS contact_name, CAST(NULL AS VARCHAR) AS contact_role FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT c_custkey, 'anna@aoi.fi', 'obfuscated', 'high', 'Anna Korpela', 'sales manager' FROM customer WHERE c_custkey % 5 = 1
    UNION ALL SELECT c_custkey, 'jussi@aoi.fi', 'text', 'medium', 'Jussi Lahti', 'owner' FROM customer WHERE c_custkey % 5 = 2
    UNION ALL SELECT c_custkey, 'info@aoi.fi', 'text', 'medium', NULL, 'owner' FROM customer WHERE c_custkey % 5 = 3
    UNION ALL SELECT c_custkey, 'a@aoi.net', 'cfemail', 'high', NULL, NULL FROM customer WHERE c_custkey % 5 = 4
""")
def harvested_pages(spark, sf_dir):
    """Every channel, with the name and role nearest to the address; words that are no names stay out."""
    n = F.col("k") % 5
    html = F.when(n == 0, text_of('<a href="mailto:fi', F.col("k"), '@aoi.fi?x=1">Christmas Buffet</a> logo@2x.png <p>Wolt Delivery fi', F.col("k"), "@aoi.fi</p>"))
    html = html.when(n == 1, "<p>Myyntipäällikkö Anna Korpela</p> anna (at) aoi [dot] fi <p>Foodora Wolt x@example.com</p>")
    html = html.when(n == 2, text_of("<p>Restaurant manager Maija Rinne, ", F.repeat(F.lit("kesä "), F.lit(20)), "</p><p>Owner Jussi Lahti jussi@aoi.fi</p>"))
    html = html.when(n == 3, "<p>Omistaja Jussi Lahti info@aoi.fi</p>").otherwise('<a data-cfemail="7b1a3b1a141255151e0f">x</a>')
    return c.harvest_contacts(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), html.alias("html")), ["page_id"])


@query("""
    SELECT c_custkey AS page_id, lower(c_mktsegment) || c_custkey || '@aoi.fi' AS email, CASE WHEN c_nationkey % 3 = 2 THEN 'mailto' ELSE 'text' END AS channel, CASE WHEN c_nationkey % 3 = 2 THEN NULL WHEN c_acctbal > 3000 THEN 'sales manager' WHEN c_acctbal > 0 THEN 'owner' END AS contact_role,
        CASE WHEN c_nationkey % 3 = 2 THEN NULL WHEN c_acctbal > 3000 THEN 'Jörg Väyrynen' WHEN c_acctbal > 0 THEN 'Anna Korpela' END AS contact_name FROM customer
""")
def harvested_references(spark, sf_dir):
    """Addresses, names and roles behind named, decimal and hexadecimal references, some without their semicolon. An
    address that is in a link only has no place in the text, and so no one near it."""
    local = F.lower("c_mktsegment")
    spelt = F.transform(F.split(local, ""), lambda x: F.when(x == "i", "&#105;").when(x == "u", "&#x75;").otherwise(x))
    written = text_of(F.array_join(spelt, ""), F.col("k"), F.when(F.col("c_nationkey") % 3 == 0, "&#64;").when(F.col("c_nationkey") % 3 == 1, "&#x40;").otherwise("&commat;"), "aoi&period;fi")
    owner = F.when(F.col("c_acctbal") > 3000, "Myyntip&auml;&#228;llikk&#xF6; J&ouml;rg&nbsp;V&aumlyrynen").when(F.col("c_acctbal") > 0, "&Omicron;&#79;mistaja Anna&#160;Korpela").otherwise("&lt;&amp;&gt;")
    html = text_of("<p>", owner, "</p> ", F.when(F.col("c_nationkey") % 3 == 2, text_of('<a href="m&#97;ilto&colon;', written, '">x</a>')).otherwise(text_of("<p>", written, "</p>")))
    rows = c.harvest_contacts(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), html.alias("html")), ["page_id"])
    return rows.select("page_id", "email", "channel", "contact_role", "contact_name")


@query("""
    SELECT c_custkey AS page_id, 'instagram' AS platform, 'aoi_' || c_custkey AS handle FROM customer UNION ALL SELECT c_custkey, 'linkedin', 'aoi-oy' FROM customer WHERE c_custkey % 2 = 0
""")
def harvested_socials(spark, sf_dir):
    html = text_of('<a href="https://www.instagram.com/aoi_', F.col("k"), '/">i</a><a href="https://instagram.com/aoi_', F.col("k"), '">i</a><a href="https://facebook.com/sharer">s</a>', F.when(F.col("k") % 2 == 0, '<a href="https://fi.linkedin.com/company/aoi-oy/">l</a>').otherwise(""))
    return c.harvest_socials(page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), html.alias("html")), ["page_id"]).select("page_id", "platform", "handle").distinct()


@query("""
    SELECT c_custkey AS page_id, CAST(0 AS INTEGER) AS pos, '1234567-1' AS business_id, 'FI' AS id_country, 'checksum_valid' AS how FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS INTEGER), CAST(10000000 + c_custkey AS VARCHAR), 'EE', 'keyword_corroborated' FROM customer WHERE c_custkey % 5 < 3 AND (c_custkey % 2 = 1 OR c_custkey % 3 <> 0)
    UNION ALL SELECT c_custkey, CAST(0 AS INTEGER), CAST(10000000 + c_custkey AS VARCHAR), 'EE', 'keyword_corroborated' FROM customer WHERE c_custkey % 5 < 3 AND c_custkey % 2 = 0 AND c_custkey % 3 = 0
""".replace("CAST(0 AS INTEGER) AS pos, '1234567-1'", "CAST(CASE WHEN c_custkey % 3 = 0 AND c_custkey % 5 < 3 THEN 1 ELSE 0 END AS INTEGER) AS pos, '1234567-1'"))
def harvested_ids(spark, sf_dir):
    """Finnish ids with a right check digit, Estonian ones near a register's word, the page's country first."""
    text = text_of("x 1234567-2 ", F.when(F.col("k") % 2 == 0, "Y-tunnus 1234567-1 1234567-1 ").otherwise(""), F.when(F.col("k") % 5 < 3, "Registrikood: ").otherwise("puh "), F.col("k") + 10_000_000)
    pages = page_rows(spark, sf_dir).select(F.col("k").alias("page_id"), F.when(F.col("k") % 3 == 0, "EE").otherwise("FI").alias("country"), text.alias("text"))
    return c.harvest_business_ids(pages, ["page_id"], F.col("text"), "country")
