"""The registered query of each operator: its production parameters over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_decode
from .hamming_topk import embedding_codes, hamming_top_k
from .hilbert_ann import nearest_by_curves
from .html_text import main_text
from .line_dedup import dedup_lines
from .middle import fill_in_middle, restored
from .packing import pack_documents
from .simhash import simhash_components
from .suffix_dedup import remove_repeats
from .token_counts import count_tokens
from .toxicity import held_out, toxicity
from .url_filter import Rule, judge_urls
from .whitening import whiten

#: The rules of op13: verdict, host, path.
URL_RULES: list[Rule] = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_top_k(embedding_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_lines(_documents(spark, sf_dir))
    return left.select("doc_id", "lines.*", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir)).select("doc_id", "repeats.*")


def op8_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_curves(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_documents(spark, sf_dir))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


ORACLES = {
    "op4_exact_topk": """
        WITH c AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
        ok AS (SELECT vec_id, list_transform(v[1:64], lambda x: x > 0) AS b FROM c
               WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
        d AS (SELECT q.vec_id AS query_id, r.vec_id,
                     CAST(len(list_filter(list_zip(q.b, r.b), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
              FROM ok q JOIN ok r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0),
        n AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM d)
        SELECT query_id, rank, vec_id, distance FROM n WHERE rank <= 10
    """,
    "op12_fill_in_middle": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256(concat('7:', CAST(doc_id AS VARCHAR))) AS h,
                          regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
        d AS (SELECT doc_id, x, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                     CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
        p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(x) AS restored_sha256 FROM p
    """,
    "op13_url_filter": r"""
        WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        own AS (SELECT page_id, row_number() OVER () AS k, coalesce(url, '') AS u, coalesce(html, '') AS html FROM pages),
        links AS (SELECT k, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]+)', 1)) AS u FROM own),
        every AS (SELECT k, true AS page, u FROM own UNION ALL SELECT k, false, CASE WHEN u LIKE '//%' THEN 'http:' || u ELSE u END FROM links),
        placed AS (SELECT k, page, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM every),
        judged AS (SELECT k, page, host, path, arg_max(r.h || r.p, (length(r.h || r.p), r.verdict)) AS rule, arg_max(r.verdict, (length(r.h || r.p), r.verdict)) AS verdict
                   FROM (SELECT *, row_number() OVER () AS n FROM placed) LEFT JOIN rules r ON ends_with('.' || host, '.' || r.h) AND starts_with(path, r.p) GROUP BY n, k, page, host, path),
        seen AS (SELECT host, count(*) AS urls, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked FROM judged WHERE host <> '' GROUP BY host),
        pairs AS (SELECT DISTINCT a.host AS src, b.host AS dst FROM judged a JOIN judged b ON a.k = b.k AND a.page AND NOT b.page WHERE a.host <> '' AND b.host <> '' AND a.host <> b.host),
        edges AS (SELECT kind, src, dst, count(*) OVER (PARTITION BY kind, src) AS degree
                  FROM (SELECT 'trust' AS kind, src, dst FROM pairs UNION ALL SELECT 'distrust', dst, src FROM pairs)),
        walk(step, kind, host, mass) AS (
            SELECT 0, kind, host, CAST(mass AS BIGINT) FROM (SELECT 'trust' AS kind, host, allowed * 1000000000 // urls AS mass FROM seen UNION ALL SELECT 'distrust', host, blocked * 1000000000 // urls FROM seen) WHERE mass > 0
            UNION ALL
            SELECT w.step + 1, w.kind, e.dst, CAST(sum(w.mass * 85 // (100 * e.degree)) AS BIGINT) FROM walk w JOIN edges e ON e.kind = w.kind AND e.src = w.host WHERE w.step < 40 AND w.mass * 85 // (100 * e.degree) > 0 GROUP BY w.step, w.kind, e.dst),
        scores AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) - coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS worse FROM walk GROUP BY host)
        SELECT o.page_id, j.host, j.path, j.rule, coalesce(j.verdict, CASE WHEN coalesce(s.worse, 0) > 500000000 THEN 'block' ELSE 'allow' END) AS verdict
        FROM own o JOIN judged j ON j.k = o.k AND j.page LEFT JOIN scores s ON s.host = j.host
    """,
}
