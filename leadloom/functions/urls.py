"""References of pages to absolute URLs (RFC 3986, 5.2), as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .references import let

_SPLIT = "(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$"
#: Schemes whose references may be relative, and the form in which their URLs have a host.
RELATIVE = ("", "http", "https", "ftp", "file", "sftp", "ws", "wss")
#: Those whose last segment may have parameters behind a semicolon.
WITH_PARAMS = ("", "http", "https", "ftp", "sftp")


def _parts(url: Column) -> Column:
    """Struct of a URL's scheme (or none), host, path, params (behind a semicolon in the last segment), query, fragment."""
    clean = F.regexp_replace(F.regexp_replace(url, "^[\\x{0}-\\x{20}]+", ""), "[\\t\\r\\n]", "")
    part = lambda c, k: F.regexp_extract(c, _SPLIT, k)
    return let(clean, lambda c: F.struct(F.lower(part(c, 1)).alias("scheme"), part(c, 2).alias("host"), part(c, 3).alias("path"), part(c, 4).alias("query"), part(c, 5).alias("fragment")))


def _path_and_params(path: Column, scheme: Column) -> Column:
    pattern, has = "(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$", scheme.isin(*WITH_PARAMS)
    return F.struct(F.when(has, F.regexp_extract(path, pattern, 1)).otherwise(path).alias("path"), F.when(has, F.regexp_extract(path, pattern, 2)).otherwise("").alias("params"))


def _without_dots(segments: Column) -> Column:
    """The path of segments: a dot stands for nothing, two take the segment before away."""
    none, dots = F.array().cast("array<string>"), lambda s: s.isin(".", "..")
    step = lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s)))
    folded = lambda x: F.concat(F.aggregate(x, none, step), F.when(dots(F.element_at(x, -1)), F.array(F.lit(""))).otherwise(none))
    return let(segments, lambda x: F.array_join(F.when(F.exists(x, dots), folded(x)).otherwise(x), "/"))


def _merged(base_path: Column, path: Column) -> Column:
    folder = let(F.split(base_path, "/", -1), lambda x: F.when(F.element_at(x, -1) != "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))
    inner = lambda x: F.filter(F.slice(x, F.lit(2), F.greatest(F.size(x) - 2, F.lit(0))), lambda s: s != "")
    relative = let(F.concat(folder, F.split(path, "/", -1)), lambda x: F.when(F.size(x) > 1, F.concat(F.slice(x, 1, 1), inner(x), F.slice(x, -1, 1))).otherwise(x))
    return F.coalesce(F.nullif(_without_dots(F.when(F.startswith(path, F.lit("/")), F.split(path, "/", -1)).otherwise(relative)), F.lit("")), F.lit("/"))


def _joined(x: Column) -> Column:
    """The URL of a struct's scheme, host, path, params, query and fragment."""
    scheme, slash = x["scheme"], F.lit("/")
    some = lambda mark, c: F.when(c != "", F.concat(F.lit(mark), c)).otherwise("")
    rooted = lambda w: F.when((w == "") | F.startswith(w, slash), w).otherwise(F.concat(slash, w))
    bare = lambda w: F.startswith(w, F.lit("//")) | (scheme != "") & ((w == "") | F.startswith(w, slash))
    place = let(F.concat(x["path"], some(";", x["params"])), lambda w: F.when(x["host"] != "", F.concat(F.lit("//"), x["host"], rooted(w))).when(bare(w), F.concat(F.lit("//"), w)).otherwise(w))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), place, some("?", x["query"]), some("#", x["fragment"]))


def _resolved(v: Column) -> Column:
    """Of a struct of base, href and their parts b and u."""
    b, u = v["b"], v["u"]
    scheme = F.when(u["scheme"] != "", u["scheme"]).otherwise(b["scheme"])

    def near(p: Column) -> Column:
        same = (p["own"]["path"] == "") & (p["own"]["params"] == "")
        path = F.when(same, p["base"]["path"]).otherwise(_merged(p["base"]["path"], p["own"]["path"]))
        near_ = (scheme, b["host"], path, F.when(same, p["base"]["params"]).otherwise(p["own"]["params"]), F.when(same & (u["query"] == ""), b["query"]).otherwise(u["query"]), u["fragment"])
        far = (scheme, u["host"], p["own"]["path"], p["own"]["params"], u["query"], u["fragment"])
        names = ("scheme", "host", "path", "params", "query", "fragment")
        return let(F.when(u["host"] != "", F.struct(*[c.alias(n) for c, n in zip(far, names, strict=True)])).otherwise(F.struct(*[c.alias(n) for c, n in zip(near_, names, strict=True)])), _joined)

    odd = lambda x: F.contains(x["host"], F.lit("[")) != F.contains(x["host"], F.lit("]"))
    both = let(F.struct(_path_and_params(b["path"], b["scheme"]).alias("base"), _path_and_params(u["path"], scheme).alias("own")), near)
    out = F.when(odd(b) | odd(u), F.lit(None)).when((scheme != b["scheme"]) | ~scheme.isin(*RELATIVE), v["href"]).otherwise(both)
    return F.when(v["base"] == "", v["href"]).when(v["href"] == "", v["base"]).otherwise(out)


def absolute_url(base: Column, href: Column) -> Column:
    """What a reference on a page means. White space round it doesn't count; null counts as empty; an empty one means the
    page, and on a page without a URL all stay as they are. So do those of schemes without relative forms. Empty queries
    and fragments, and empty segments within a relative path, go. A host with one square bracket gives null."""
    white = "[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}]+"
    own = F.struct(F.coalesce(base, F.lit("")).alias("base"), F.regexp_replace(F.coalesce(href, F.lit("")), f"^{white}|{white}$", "").alias("href"))
    return let(own, lambda x: let(F.struct(x["base"].alias("base"), x["href"].alias("href"), _parts(x["base"]).alias("b"), _parts(x["href"]).alias("u")), _resolved))
