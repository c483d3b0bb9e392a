"""Structured data of pages: business nodes of JSON-LD blocks at any depth, as columns.

The walk goes by level: a fold over as many steps as a block has brackets replaces the objects and lists of a level by
those within them, and keeps the objects that are businesses; steps after the last level do nothing. Values keep the
order of the text. Defined results: a block that is no JSON is tried again up to its last brace and then left out; null
html has no nodes; a string that looks like an object is text; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.references import let, once

_BLOCK = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
_STRING = r'(?s)"(?:[^"\\]|\\.)*+"'
#: Keys whose values aren't walked.
NOT_WALKED = ("review", "author", "aggregateRating")

_TEXTS = "array<string>"
NODE = "pos int, type_rank int, filled int, node_id string, name string, telephone string, street string, postcode string, city string, rating string, reviews string, lat string, lon string, cuisine array<string>"


def _none() -> Column:
    return F.array().cast(_TEXTS)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def _nested(v: Column) -> Column:
    return F.rlike(_kind(v), F.lit("^(OBJECT|ARRAY)"))


def _within(text: Column) -> Column:
    """Texts of the objects and lists right within an object or a list, in order."""
    raw, typed = F.map_entries(F.from_json(text, "map<string,string>")), F.map_entries(F.from_json(text, "map<string,variant>"))
    values = F.zip_with(raw, typed, lambda r, t: F.when(_nested(t["value"]) & ~r["key"].isin(*NOT_WALKED), r["value"]))
    elements = F.zip_with(F.from_json(text, _TEXTS), F.from_json(text, "array<variant>"), lambda r, t: F.when(_nested(t), r))
    return F.filter(F.coalesce(F.when(F.startswith(text, F.lit("{")), values).otherwise(elements), _none()), lambda x: x.isNotNull())


def _types(raw: Column) -> Column:
    given = F.try_element_at(raw, F.lit("@type"))
    return F.transform(F.when(F.startswith(given, F.lit("[")), F.from_json(given, _TEXTS)).otherwise(F.array(given)), F.lower)


def _rank(raw: Column) -> Column:
    """The best rank of an object's types, or null."""
    rank = lambda t: F.coalesce(*[F.when(t == name, F.lit(k)) for name, k in fixed.BUSINESS_TYPES.items()])
    return F.array_min(F.filter(F.transform(_types(raw), rank), lambda k: k.isNotNull()))


def _businesses(block: Column) -> Column:
    """Texts of a block's business objects."""
    strings = F.regexp_replace(block, _STRING, "")
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(strings) - F.length(F.translate(strings, "[{", ""))))
    is_one = lambda x: F.startswith(x, F.lit("{")) & _rank(F.from_json(x, "map<string,string>")).isNotNull()
    start = F.struct(F.array(block).cast(_TEXTS).alias("todo"), _none().alias("found"))
    step = lambda at: F.struct(F.flatten(F.transform(at["todo"], _within)).alias("todo"), F.concat(at["found"], F.filter(at["todo"], is_one)).alias("found"))
    return F.aggregate(steps, start, lambda at, _: F.when(F.size(at["todo"]) > 0, step(at)).otherwise(at))["found"]


def _blocks(html: Column) -> Column:
    cut = lambda b: F.substring(b, F.lit(1), F.length(b) - F.length(F.call_function("substring_index", b, F.lit("}"), F.lit(-1))))
    listed = lambda b: F.concat(F.lit("["), b, F.lit("]"))  # noqa: E731  so that what follows a value counts as an error
    one = lambda b: F.try_parse_json(listed(b)).isNotNull() & (F.size(F.from_json(listed(b), "array<variant>")) == 1)
    valid = lambda b: F.when(one(b), b).when(F.contains(b, F.lit("}")), let(cut(b), lambda c: F.when(one(c), c)))
    blocks = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_BLOCK), F.lit(1)), lambda b: F.regexp_replace(valid(b), r"^\s+", ""))
    return F.filter(blocks, lambda b: b.isNotNull())


def _node(text: Column, pos: Column) -> Column:
    def fields(x: Column) -> Column:
        raw, typed = x["raw"], x["typed"]
        get = lambda m, name: F.try_element_at(m, F.lit(name))
        plain = lambda name: F.when(~_nested(get(typed, name)), get(raw, name))
        part = lambda name: F.from_json(F.when(F.startswith(_kind(get(typed, name)), F.lit("OBJECT")), get(raw, name)), "map<string,string>")
        inner = lambda name, key: F.when(~F.rlike(get(part(name), key), F.lit(r"^[\[{]")), get(part(name), key))
        empty = lambda name: get(raw, name).isNull() | get(raw, name).isin("", "[]", "{}") | (_kind(get(typed, name)) != "STRING") & get(raw, name).rlike("^(false|-?0(\\.0*)?)$")
        filled = sum(((~empty(k)).cast("int") for k in fixed.BUSINESS_KEYS), F.lit(0))
        cuisine = F.when(empty("servesCuisine"), _none()).when(F.startswith(_kind(get(typed, "servesCuisine")), F.lit("ARRAY")), F.from_json(get(raw, "servesCuisine"), _TEXTS)).otherwise(F.array(get(raw, "servesCuisine")))
        return F.struct(
            pos.cast("int").alias("pos"), _rank(raw).alias("type_rank"), filled.alias("filled"), plain("@id").alias("node_id"), plain("name").alias("name"), plain("telephone").alias("telephone"),
            inner("address", "streetAddress").alias("street"), inner("address", "postalCode").alias("postcode"), inner("address", "addressLocality").alias("city"), inner("aggregateRating", "ratingValue").alias("rating"),
            inner("aggregateRating", "reviewCount").alias("reviews"), inner("geo", "latitude").alias("lat"), inner("geo", "longitude").alias("lon"), cuisine.alias("cuisine"),
        )

    return let(F.struct(F.from_json(text, "map<string,string>").alias("raw"), F.from_json(text, "map<string,variant>").alias("typed")), fields)


def business_nodes(html: Column) -> Column:
    """array<struct<NODE>> of a page, level by level, block after block."""
    found = F.transform(F.flatten(F.transform(_blocks(html), _businesses)), _node)
    return F.when(F.contains(F.lower(html), F.lit("ld+json")), found).otherwise(F.array().cast(f"array<struct<{NODE.replace(' ', ':').replace(',:', ',')}>>"))


def _order(node: Column, wanted: Column | None) -> list[Column]:
    miss = F.lit(0)
    if wanted is not None:
        own, wanted = F.regexp_replace(node["node_id"], "/+$", ""), wanted.cast("string")
        miss = F.when(F.endswith(own, F.concat(F.lit("/"), wanted)) | (node["node_id"] == wanted), 0).otherwise(1)
    return [miss.alias("miss"), node["type_rank"].alias("rank"), (-node["filled"]).alias("less"), node["pos"].alias("at")]


def best_node(nodes: Column, wanted: Column | None = None) -> Column:
    """One of a page's nodes: of the wanted id (the node's @id, or its last part) if any, else of the better type, then
    the fullest, then the first."""
    return F.array_min(F.transform(nodes, lambda n: F.struct(*_order(n, wanted), n.alias("node"))))["node"]


def jsonld_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, NODE): a row for each business node."""
    return once(pages.select(key, F.col(html).alias("__html")), __nodes=business_nodes(F.col("__html"))).select(key, F.inline("__nodes"))


def best_jsonld_node(nodes: DataFrame, key: str = "page_id", wanted_id: str | None = None) -> DataFrame:
    """best_node of the rows of each key."""
    node = F.struct(*nodes.columns)
    order = F.struct(*_order(node, F.col(wanted_id) if wanted_id else None))
    return nodes.groupBy(key).agg(F.min_by(node, order).alias("n")).select("n.*")
