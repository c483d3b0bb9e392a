"""Jobs over stored pages: links, kinds, ranks, routes, structured data, listing fields.

Everything is columns over rows of pages. A null page counts as empty; extra columns pass through where a job returns its
input's rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.references import let, once
from ..functions.text import city_label, fold, host_of, path_of, slugify, visible_text  # noqa: F401
from ..functions.urls import absolute_url
from .jsonld import best_jsonld_node, best_node, business_nodes, jsonld_nodes  # noqa: F401

_ANCHOR = "(?is)<a\\b[^>]*>.*?</a>"
_HREF = "(?is)^<a\\b[^>]*?\\bhref\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, whatever its place and quotes; empty if it isn't there."""
    pattern = f"(?is)\\b{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", absolute: bool = True) -> DataFrame:
    """(key, url, pos, link, anchor) of every anchor with an href: its absolute URL and at most 120 characters of text,
    or else of its aria-label or title."""
    anchors = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_ANCHOR), F.lit(0))
    rows = pages.select(key, url, F.posexplode(anchors).alias("pos", "tag"))
    href = F.concat(*[F.regexp_extract("tag", _HREF, g) for g in (1, 2, 3)])
    head = F.regexp_extract("tag", "(?is)^<a\\b[^>]*>", 0)
    label = F.coalesce(F.nullif(visible_text(F.col("tag")), F.lit("")), F.nullif(attribute(head, "aria-label"), F.lit("")), attribute(head, "title"))
    found = once(rows, href=href).where("href <> ''")
    return once(found, link=absolute_url(F.col(url), F.col("href")) if absolute else F.col("href"), anchor=F.substring(label, 1, 120)).select(key, url, "pos", "link", "anchor")


def _flat(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(F.coalesce(c, F.lit("")))), "\\s+", " "))


def _any(words: tuple[str, ...], before: str, after: str) -> str:
    escaped = "|".join(sorted((w.replace(".", "\\.").replace("-", "\\-") for w in words), key=len, reverse=True))
    return f"(^|{before})({escaped})({after}|$)"


def page_kind(link: Column, anchor: Column) -> Column:
    """Struct (kind, priority): by the anchor's words first, then by the path's; one pattern a kind."""
    return let(F.struct(_flat(anchor).alias("text"), _flat(path_of(link)).alias("path")), lambda x: _kind(x["text"], x["path"]))


def _kind(text: Column, path: Column) -> Column:
    made = lambda k, p: F.struct(F.lit(k).alias("kind"), F.lit(p).alias("priority"))
    out = None
    for kind, priority, phrases, _ in fixed.PAGE_KINDS:
        test = text.rlike(_any(phrases, "[^a-z0-9]", "[^a-z0-9]"))
        out = F.when(test, made(kind, priority)) if out is None else out.when(test, made(kind, priority))
    for kind, priority, _, pieces in fixed.PAGE_KINDS:
        out = out.when(path.rlike(_any(pieces, "[/\\-_]", "[/\\-_.]")), made(kind, priority))
    return out.when(path.isin("", "/"), made("home", fixed.HOME_PRIORITY)).otherwise(made("other", fixed.OTHER_PRIORITY))


def crawlable(link: Column, site: Column) -> Column:
    """Web links to the site's own host that aren't files or administration."""
    bare = ~F.lower(link).rlike("^(mailto:|tel:|javascript:|#|data:)") & (link != "")
    web = ~link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | link.rlike("(?i)^https?:")
    own = host_of(link).isin("") | (host_of(link) == F.regexp_replace(F.lower(site), "^www\\.", ""))
    return bare & web & own & ~path_of(link).rlike(fixed.SKIPPED_EXTENSIONS) & ~path_of(link).rlike(fixed.SKIPPED_PATHS)


def rank_links(links: DataFrame, site_key: str, limit: int = 15) -> DataFrame:
    """The pages of each site worth reading: per URL its best kind (the first on ties), by priority, then URL."""
    clean = let(F.regexp_replace(F.regexp_replace("link", "#.*$", ""), "/+$", ""), lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("/")))
    pos = F.col("pos") if "pos" in links.columns else F.lit(0)
    kinds = once(links.select(site_key, clean.alias("__clean"), "link", "anchor", pos.alias("at")), k=page_kind(F.col("link"), F.col("anchor"))).select(site_key, F.col("__clean").alias("link"), "k", "at")
    best = kinds.groupBy(site_key, "link").agg(F.min(F.struct("k.priority", "at", "k.kind")).alias("k")).select(site_key, "link", "k.kind", "k.priority")
    order = Window.partitionBy(site_key).orderBy("priority", "link")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def page_union(home_links: DataFrame, sitemap_links: DataFrame) -> DataFrame:
    """Links of the home page and the sitemap, before ranking."""
    return home_links.unionByName(sitemap_links, allowMissingColumns=True)


def sitemap_urls(captures: DataFrame, body: str, limit: int) -> DataFrame:
    """(…, pos, link): the first distinct <loc> entries of each body."""
    found = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit("(?is)<loc>\\s*(.*?)\\s*</loc>"), F.lit(1))
    return captures.select(*(c for c in captures.columns if c != body), F.posexplode(F.slice(F.array_distinct(found), 1, limit)).alias("pos", "link"))


def blocked_or_shell(pages: DataFrame, html: str = "html", status: str = "http_status", markers: str = "(captcha|access denied|attention required|are you a robot|cf-browser-verification)", text: Callable[[Column], Column] = visible_text) -> DataFrame:
    """Adds is_blocked (status 403 or 503, or a marker in the first 4000 characters) and is_shell (under 400 characters
    of visible text, as `text` gives it)."""
    marked = F.lower(F.substring(F.coalesce(html, F.lit("")), 1, 4000)).rlike(markers)
    return once(pages, is_blocked=F.coalesce(F.col(status).isin(403, 503), F.lit(False)) | marked, is_shell=F.length(text(F.col(html))) < 400)


def detect_cms(html: Column, link_header: Column | None = None) -> Column:
    """The first content system with a marker; a response header decides before the page does."""
    out = F.when(link_header.contains("api.w.org"), F.lit("wordpress")) if link_header is not None else F.when(F.lit(False), F.lit(""))
    for name, markers in fixed.CMS_MARKERS:
        out = out.when(html.rlike(markers), F.lit(name))
    return out.otherwise(F.lit("unknown"))


def crawl_tier(sites: DataFrame) -> DataFrame:
    """Adds tier, from cms, is_blocked and is_shell: how a site's pages are to be got."""
    return sites.withColumn("tier", F.when(F.col("is_blocked"), F.lit("last_resort")).when(F.col("cms").isin("wordpress", "squarespace"), F.lit("api")).when(F.col("cms").isin("wix", "webflow") | F.col("is_shell"), F.lit("render")).otherwise(F.lit("static")))


def listing_meta(pages: DataFrame, html: str = "html", site: str | None = None) -> DataFrame:
    """Adds title (without the site's name after a bar; any name that stands after a bar and spaces if `site` isn't
    given), description, image_id, and lang, city_slug, venue_slug, listing_id of the canonical URL. The order of a tag's
    attributes doesn't matter."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?is)<(?:meta|link)\\b[^>]*>"), F.lit(0))
    names = F.transform(tags, lambda t: F.struct(t.alias("tag"), attribute(t, "property").alias("property"), attribute(t, "rel").alias("rel")))
    tag = lambda name: F.try_element_at(F.filter("__tags", lambda t: (t["property"] == name) | (t["rel"] == name)), F.lit(1))["tag"]
    given = lambda name, att: F.trim(attribute(tag(name), att))
    rows = once(once(pages, __tags=names), __title=given("og:title", "content"), __description=given("og:description", "content"), __image=given("og:image", "content"), __canonical=given("canonical", "href"))
    value = lambda name: F.nullif(F.col(name), F.lit(""))
    piece = lambda k: F.nullif(F.regexp_extract(value("__canonical"), "^(?:https?://[^/]+)?/([a-z]{2})/([^/]+)/([^/]+)/([0-9]+)", k), F.lit(""))
    suffix = r"\s+\|\s+[^|]*$" if site is None else r"(?i)\s*\|\s*" + re.escape(site) + r"\s*$"
    title = F.trim(F.regexp_replace(visible_text(value("__title")), suffix, ""))
    return once(
        rows, title=F.nullif(title, F.lit("")), description=value("__description"), image_id=F.regexp_extract(value("__image"), "/restaurant/([0-9]+)/", 1).try_cast("long"),
        lang=piece(1), city_slug=piece(2), venue_slug=piece(3), listing_id=piece(4).try_cast("long"),
    ).drop("__tags", "__title", "__description", "__image", "__canonical")


def listing_guards(listings: DataFrame, probed: str = "probed_id") -> DataFrame:
    """Adds refused (no title), needs_review and review_reason (an image or canonical id other than the one asked for)."""
    reasons = F.concat_ws("; ", F.when(F.col("image_id") != F.col(probed), F.lit("image id mismatch")), F.when(F.col("listing_id") != F.col(probed), F.lit("canonical id mismatch")))
    return listings.withColumns({"refused": F.coalesce(F.trim("title"), F.lit("")) == "", "review_reason": F.nullif(reasons, F.lit("")), "needs_review": (reasons != "").cast("int")})


def map_address(html: Column) -> Column:
    """The address in the first link to a map that names one, as its query, destination or place; bare coordinates don't
    count."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(fixed.MAP_LINK), F.lit(1))
    given = lambda u, pattern: F.trim(F.try_url_decode(F.nullif(F.regexp_extract(u, pattern, 1), F.lit(""))))
    named = lambda x: F.when((x != "") & ~x.rlike(r"^[-0-9.,\s]+$"), x)
    places = [*(rf"[?&](?:amp;)?{k}=([^&#]+)" for k in ("q", "query", "destination", "daddr")), r"/maps/place/([^/@?]+)"]
    found = F.transform(links, lambda u: F.coalesce(*[named(given(u, x)) for x in places]))
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(1))


def detail_fields(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """phone, street (or else the address in a map link), postcode, rating, reviews, tags and three keyword flags: JSON-LD
    first, then patterns; `trace` says which gave the phone and the postcode."""
    none = lambda c: F.nullif(c, F.lit(""))
    tel = none(F.regexp_extract(F.coalesce(html, F.lit("")), "(?i)href=[\"']tel:([^\"']+)", 1))
    rows = pages.select(key, best_node(business_nodes(F.col(html))).alias("n"), visible_text(F.col(html)).alias("text"), tel.alias("tel"), map_address(F.col(html)).alias("on_map"))
    seen = none(F.regexp_extract("text", "(\\+(?:358|372)[0-9 ()-]{6,14}[0-9])", 1))
    rows = rows.withColumns({"seen": seen, "code": none(F.regexp_extract("text", "\\b([0-9]{5})\\b", 1)), "low": F.lower("text")})
    flag = lambda words: F.rlike("low", F.lit(words)).cast("int")
    trace = F.array(
        F.when(F.col("n.telephone").isNotNull(), F.lit("phone:jsonld")).when(F.col("tel").isNotNull(), F.lit("phone:tel")).when(F.col("seen").isNotNull(), F.lit("phone:text")),
        F.when(F.col("n.postcode").isNotNull(), F.lit("postcode:jsonld")).when(F.col("code").isNotNull(), F.lit("postcode:text")),
    )
    return rows.select(
        key, F.coalesce("n.telephone", "tel", "seen").alias("phone"), F.coalesce("n.street", "on_map").alias("street"), F.coalesce("n.postcode", "code").alias("postcode"), F.col("n.rating").try_cast("double").alias("rating"), F.col("n.reviews").try_cast("int").alias("reviews"),
        F.array_sort(F.array_distinct(F.coalesce("n.cuisine", F.array()))).alias("tags"), flag("michelin").alias("is_michelin"), flag("(special|campaign) offer|tarjous|pakkumine").alias("has_offer"), flag("gift ?card|lahjakortti|kinkekaart").alias("has_gift_card"),
        F.filter(trace, lambda x: x.isNotNull()).alias("trace"),
    )


def page_profile(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per page: JSON-LD blocks, their types and keys (sorted), telephone and map links, and the first 600 characters of
    its text."""
    source = F.coalesce(html, F.lit(""))
    every = lambda p, group=0: F.regexp_extract_all(source, F.lit(p), F.lit(group))
    blocks = F.array_join(every(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", 1), "\n")
    inside = lambda p: F.array_sort(F.array_distinct(F.regexp_extract_all(blocks, F.lit(p), F.lit(1))))
    return pages.select(
        key,
        F.size(every(r"(?i)application/ld\+json")).alias("ld_blocks"),
        inside(r'"@type"\s*:\s*\[?\s*"([^"]+)"').alias("ld_types"),
        inside(r'"([A-Za-z]\w*)"\s*:').alias("ld_keys"),
        F.size(every("(?i)href=[\"']tel:")).alias("tel_links"),
        F.size(every(fixed.MAP_LINK)).alias("map_links"),
        F.substring(visible_text(F.col(html)), 1, 600).alias("opening"),
    )


def flatten_cms_api(captures: DataFrame, body: str = "body") -> DataFrame:
    """(…, url, title, html) of content interfaces' JSON: an array of pages, or an object with items. Anything else gives
    no rows."""
    rest = [c for c in captures.columns if c != body]
    rows = captures.select(*rest, F.try_parse_json(F.coalesce(body, F.lit(""))).alias("v"))
    wp = "array<struct<link:string,title:struct<rendered:string>,content:struct<rendered:string>>>"
    sq = "struct<items:array<struct<fullUrl:string,title:string,body:string>>>"
    text = F.when(F.col("v").isNotNull(), F.to_json("v"))
    pages = F.transform(F.from_json(text, wp), lambda p: F.struct(p["link"].alias("url"), p["title"]["rendered"].alias("title"), p["content"]["rendered"].alias("html")))
    items = F.transform(F.from_json(text, sq)["items"], lambda p: F.struct(p["fullUrl"].alias("url"), p["title"].alias("title"), p["body"].alias("html")))
    either = F.when(text.startswith("["), pages).otherwise(items)
    return rows.select(*rest, F.inline(either)).where("html is not null")


def discovery_scan(captures: DataFrame, body: str = "body", skip: tuple[str, ...] = ("en", "fi", "et", "sv", "blog", "contact")) -> DataFrame:
    """Distinct (kind, value): sitemap lines, city slugs of links, and paths that look like an interface's."""
    text = F.coalesce(body, F.lit(""))
    of = lambda kind, pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    found = F.concat(of("sitemap", "(?im)^\\s*sitemap:\\s*(\\S+)"), of("city_slug", "(?i)href=[\"']/(?:[a-z]{2}/)?([a-z][a-z-]+)/?[\"']"), of("api_path", "[\"'](/(?:api|graphql|wp-json)/[^\"'\\s]*)[\"']"))
    return captures.select(F.inline(found)).where(~((F.col("kind") == "city_slug") & F.col("value").isin(*skip))).distinct()


def cms_user_names(captures: DataFrame, body: str = "body") -> DataFrame:
    """(…, contact_name) of a content system's user list: display names of two words or more."""
    rest = [x for x in captures.columns if x != body]
    text = F.to_json(F.try_parse_json(F.coalesce(body, F.lit(""))))
    names = F.transform(F.from_json(text, "array<struct<name:string>>"), lambda u: F.trim(u["name"]))
    return captures.select(*rest, F.explode(F.filter(names, lambda n: F.size(F.split(n, "\\s+")) >= 2)).alias("contact_name"))
