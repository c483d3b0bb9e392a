"""URL filters: rules by host and path, and for what no rule decides a trust walk over the graph of hosts.

Every page's URL and every absolute link of a page is held against the rules. A host's trust seed is the share of its
URLs that rules allow, its distrust seed the share that they block. Personalised PageRank carries trust along host edges
and distrust against them (who links to a blocked host is suspect): each round a host passes DAMPING percent of what has
just reached it on, in equal parts. Masses are whole numbers of 1/UNIT of a seed and parts are rounded down, so results
don't hang on the order of sums, and a walk ends by itself or after ROUNDS. A host is blocked when its distrust is over its
trust by more than THRESHOLD of a full seed: a host of its own most of whose URLs are blocked, or one close to such.

Everything is columns and joins. Links are reduced to (host, host, URLs of each kind) within a page and before each
shuffle, and then the graph has a row for each pair of hosts. A host with many edges is spread over tasks by a salt that
its edges and its mass share. Of the pages only id, host and path take part in the last join, salted by page.

Defined results: a null URL, or one without "://", has an empty host and path, no rule, and is judged as a host without
evidence, which is allowed; null html has no links; a host's links to itself are no edges; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

UNIT, DAMPING, ROUNDS, AT_ONCE = 10**9, 85, 40, 5
#: Part of a full seed by which distrust has to be over trust, in 1/100.
THRESHOLD = 50
#: Edges of a host in one task, pages' salts in the last join, and the blocked hosts that are broadcast at most.
EDGES_A_TASK, SALTS, BROADCAST = 20_000, 32, 100_000

#: The target of an anchor that names another host.
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (between the first :// and /, ?, # or the end; A-Z lower-cased) and path (then up to ? or #)."""
    place = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(place, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (size, rule, verdict) of the longest rule that fits, or null; block wins over allow for the same rule."""
    fits = [F.when((F.concat(F.lit("."), host).endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, h, p in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def host_evidence(pages: DataFrame, rules: list[Rule], url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(host, urls, allowed, blocked) of all URLs of pages and links, and the different (src, dst) of hosts that link."""

    def judged(df: DataFrame) -> DataFrame:
        host, path = host_and_path(F.col("u"))
        at = df.select(*(c for c in df.columns if c != "u"), host.alias("host"), path.alias("path")).where("host <> ''")
        return at.withColumn("verdict", ruled(F.col("host"), F.col("path"), rules)["verdict"])

    source, _ = host_and_path(F.col(url_col))
    links = F.transform(F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(LINK), F.lit(1)), lambda x: F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).otherwise(x))
    targets = judged(pages.where(F.contains(html_col, F.lit("//"))).select(source.alias("src"), F.explode(links).alias("u")))
    both = judged(pages.select(F.col(url_col).alias("u"))).select("host", "verdict").unionByName(targets.select("host", "verdict"))
    seen = both.groupBy("host").agg(F.count("*").alias("urls"), F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"))
    return seen, targets.where("src <> '' and src <> host").select("src", F.col("host").alias("dst")).distinct()


def walk(seeds: DataFrame, edges: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, mass) of everything that the seeds' masses reach; edges: (kind, src, dst), different rows."""
    degree = edges.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    salts = F.ceil(F.col("degree") / EDGES_A_TASK).cast("int")
    large = degree.where(F.col("degree") > EDGES_A_TASK).select("kind", "src", salts.alias("salts"))
    spread = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")
    graph = cut(edges.join(large, ["kind", "src"], "left").select("kind", "src", "dst", spread.alias("salt")))
    degree = cut(degree.select("kind", "src", "degree", salts.alias("salts")))
    now = cut(seeds.select("kind", "host", F.col("mass").cast("long").alias("mass")))
    met = [now]
    for at in range(0, rounds, AT_ONCE):
        steps, here = [], now.withColumn("round", F.lit(0))
        for k in range(min(AT_ONCE, rounds - at)):
            part = F.expr(f"(mass * {damping}) div (100 * degree)")
            out = here.withColumnRenamed("host", "src").join(degree, ["kind", "src"]).select("kind", "src", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).where("part > 0")
            here = out.join(graph, ["kind", "src", "salt"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum("part").alias("mass")).withColumn("round", F.lit(k + 1))
            steps.append(here)
        found = cut(reduce(DataFrame.unionByName, steps))
        met.append(found.select("kind", "host", "mass"))
        now = found.where(F.col("round") == len(steps)).select("kind", "host", "mass")
        if now.isEmpty():
            break
    return reduce(DataFrame.unionByName, met).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def host_scores(pages: DataFrame, rules: list[Rule], url_col: str = "url", html_col: str = "html", damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust), in 1/UNIT of a full seed, of every host that has or gets either."""
    seen, links = host_evidence(pages, rules, url_col, html_col)
    share = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.expr(f"({c} * {UNIT}L) div urls").alias("mass"))
    seeds = seen.select("host", F.inline(F.array(share("trust", "allowed"), share("distrust", "blocked")))).where("mass > 0")
    edges = links.select(F.inline(F.array(F.struct(F.lit("trust").alias("kind"), "src", "dst"), F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0).cast("long")).alias(kind)
    return walk(seeds, edges, damping, rounds).groupBy("host").agg(of("trust"), of("distrust"))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: int = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict, trust and distrust (of a page without a rule) of each page.

    rules: (allow or block, host, path), where a rule fits its host and all subdomains and paths that start with its own;
    they are put into the plan as they are, so they are a list of moderate length."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("r", ruled(F.col("host"), F.col("path"), rules))
    scores = cut(host_scores(pages, rules, url_col, html_col))
    if scores.count() <= BROADCAST:
        known = rows.join(F.broadcast(scores), "host", "left")
    else:
        salted = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        known = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    worse = F.coalesce(F.col("distrust") - F.col("trust") > threshold * UNIT // 100, F.lit(False))
    free = F.col("r").isNull()
    verdict = F.when(free, F.when(worse, "block").otherwise("allow")).otherwise(F.col("r.verdict"))
    return known.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), *[F.when(free, F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in ("trust", "distrust")])
