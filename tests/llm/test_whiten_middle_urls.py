"""Whitening, fill-in-the-middle and URL filters, against brute force."""

import glob
import os
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import middle, queries, url_filter, whitening

SF = "/root/testdata/sf0.01"


def rows(df):
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    return sorted(map(tuple, df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_url_filter"])
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert rows(queries.queries()[name](spark, SF).toPandas()) == rows(con.sql(queries.oracle_sql()[name]).df())


# --- whitening ---


def exact(xs):
    """n, deviations and the covariance of different whole-number vectors, in fractions."""
    fit = [list(x) for x in {tuple(x) for x in xs}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    y = [[n * x[i] - s[i] for i in range(d)] for x in fit]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)]
    return n, s, np.array(cov)


def held(got, ids, xs, components):
    """Every row against the eigenvectors of the exact covariance; either sign, one for all rows."""
    n, s, cov = exact(xs)
    e, u = np.linalg.eigh(cov)
    order = np.argsort(-e)[:components]
    assert len(got) == len(ids) * len(order) and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.max() <= 1e-4
    y = np.array([[n * a - b for a, b in zip(x, s, strict=True)] for x in xs], dtype=object)
    for k, o in enumerate(order):
        own = got[got.component == k + 1].set_index("vec_id").loc[ids]
        assert np.allclose(own.explained, e[o] / e.sum(), rtol=1e-9)
        want = (y.astype(float) / n) @ u[:, o] / np.sqrt(e[o])
        sign = np.sign((want * own.whitened).sum())
        assert np.allclose(own.whitened * sign, want, rtol=0, atol=1e-7)
        assert list(own.deviation) == [sum(v * v for v in r) if sum(v * v for v in r) < 1 << 63 else None for r in y]


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    v[7] = v[8] = v[9]
    v[10] = 0.0
    data = [(k, v[k].tolist()) for k in range(300)]
    odd = [(900, None), (901, [float("nan")] * 6), (902, [None] + [1.0] * 5), (903, [float("inf")] * 6), (904, [])]
    short = [(1000 + k, [float(k), -float(k * k)]) for k in range(9)]  # a length of its own
    alone = [(2000, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([*data, *odd, *short, *alone], "vec_id long, embedding array<double>").withColumns({"n": F.lit("a"), "x": F.lit(1), "component": F.lit(9)})
    got = whitening.whiten(df).toPandas()
    assert set(got.vec_id) == {k for k, _ in [*data, *short, *alone]}
    held(got[got.vec_id < 900], list(range(300)), [[int(np.floor(256 * c)) for c in x] for x in v.tolist()], 4)
    held(got[got.vec_id.between(1000, 1999)], list(range(1000, 1009)), [[256 * k, -256 * k * k] for k in range(9)], 4)
    one = got[got.vec_id == 2000]  # no variance
    assert list(one.component) == [1, 2, 3] and one.whitened.isna().all() and one.explained.isna().all() and set(one.deviation) == {0} and set(one.identity_error) == {0.0}
    assert whitening.whiten(df.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    v = np.random.default_rng(1).normal(size=(40, 3)).tolist()
    df = spark.createDataFrame([*enumerate(v), (0, v[0]), (None, v[1])], "vec_id long, embedding array<float>")
    got = whitening.whiten(df, components=2).toPandas()
    assert len(got) == 84 and set(got.n) == {40}
    twice = got[(got.vec_id == 0) & (got.component == 1)]
    assert len(twice) == 2 and twice.whitened.nunique() == 1


@pytest.mark.parametrize("factor", [1.0, 1e4, 1e12])
def test_sums_stay_exact_for_large_entries(spark, factor):
    """From one limb to many, and beyond 64 bits, where deviations are null."""
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(200, 4)) * factor).tolist()
    v[0] = [sum(c) / 200 for c in zip(*v, strict=True)]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")).toPandas()
    assert got.deviation.isna().any() == (factor > 1e4)
    n, s, cov = exact([[int(np.floor(256 * c)) for c in x] for x in v])
    e = np.sort(np.linalg.eigvalsh(cov))[::-1]
    for k in range(4):
        assert np.allclose(got[got.component == k + 1].explained, e[k] / e.sum(), rtol=1e-9)
    assert set(got.n) == {n} and got.identity_error.max() < 1e-9


def test_polarisation_is_the_covariance():
    rng = np.random.default_rng(2)
    for span in (100, 1 << 30, 1 << 55):
        x = rng.integers(-span, span, size=(50, 5))
        s = [sum(map(int, c)) for c in x.T]
        c = whitening.Centre(50, s, max(abs(50 * int(v) - s[i]) for r in x for i, v in enumerate(r)))
        sums = [[0] * 5 for _ in range(5)]
        for k, m in c.squares(x).items():
            for i in range(5):
                for j in range(i, 5):
                    sums[i][j] += int(m[i, j]) << whitening.LIMB * k
        y = [[50 * int(v) - s[i] for i, v in enumerate(r)] for r in x]
        assert all(sums[i][j] == sum((r[i] + r[j]) ** 2 if i != j else r[i] ** 2 for r in y) for i in range(5) for j in range(i, 5))
        want = [[float(Fraction(sum(r[i] * r[j] for r in y), 50**3)) for j in range(5)] for i in range(5)]
        assert np.array_equal(whitening.covariance(sums, 50), np.array(want))


# --- fill in the middle ---


def test_tree_finds_every_cut():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", "\n", "中", "𝄞", "\r", "\n\n"]) for _ in range(rng.randint(0, 60)))
        units = [u + "\n" for u in text.split("\n")[:-1]] + [u for u in [text.split("\n")[-1]] if u]
        tree = middle.UnitTree(text.encode(), block=rng.choice([1, 2, 3, 7, 16]))
        assert tree.units == len(units)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.behind(k) == (len(head.encode()), len(head))


def test_forms_and_round_trip(spark):
    texts = [None, "", "\n", "one", "a\nb\nc", "a\r\nb\u2028c\n", "<P>x", "y<M>", "<", "<P\n>S>\n<S\n", "é\n𝄞\n" * 5000, "x" * 300_000 + "\n" + "tail", "a\nb\nc"]
    data = [(k, t, "n") for k, t in enumerate(texts * 20)] + [(None, "a\nb", "n")]
    df = spark.createDataFrame(data, "doc_id long, text string, n string").withColumn("output", F.lit("x"))
    made = middle.fill_in_middle(df)
    got = made.withColumn("back", middle.restored(F.col("output"), F.col("form"))).toPandas().sort_values("doc_id", na_position="last")
    forms = set()
    for r, (k, t, _) in zip(got.itertuples(), data, strict=True):
        t = t or ""
        units = [u + "\n" for u in t.split("\n")[:-1]] + [u for u in [t.split("\n")[-1]] if u]
        assert r.back == t and r.n == len(units)
        h = middle.draws(7, k)
        a, b = sorted((h[0] % (r.n + 1), h[1] % (r.n + 1)))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not t or any(m in t for m in ("<P>", "<S>", "<M>"))
        want = "plain" if plain else "spm" if h[3] % 100 < 50 else "psm"
        assert r.form == want
        assert r.output == {"plain": t, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[want]
        if plain:
            assert np.isnan(r.prefix_chars) and np.isnan(r.middle_chars)
        else:
            assert (r.prefix_chars, r.middle_chars) == (len(pre), len(mid))
        forms.add(want)
    assert forms == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(df.limit(0)).count() == 0
    assert set(middle.fill_in_middle(df, rate=0).select("form").distinct().toPandas().form) == {"plain"}


# --- URL filters ---

RULES = queries.URL_RULES


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
    j = next((i for i, c in enumerate(rest[k:], k) if c in "?#"), len(rest))
    return host, rest[k:j]


def judged(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if f".{host}".endswith(f".{h}") and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_scores(pages, links):
    """Trust and distrust of hosts by the same walk over dictionaries."""
    seen, edges = {}, set()
    for (_, url, _), out in zip(pages, links, strict=True):
        src = place(url)[0]
        for u in [url, *out]:
            h, p = place(u)
            if h:
                n, a, b = seen.get(h, (0, 0, 0))
                v = judged(h, p)[1]
                seen[h] = (n + 1, a + (v == "allow"), b + (v == "block"))
        edges |= {(src, h) for h in (place(u)[0] for u in out) if src and h and h != src}
    out = {}
    for kind, k in (("trust", 1), ("distrust", 2)):
        graph = {}
        for a, b in edges:
            graph.setdefault(*((a, []) if kind == "trust" else (b, []))).append(b if kind == "trust" else a)
        now = {h: x[k] * url_filter.UNIT // x[0] for h, x in seen.items() if x[k]}
        total = dict(now)
        for _ in range(url_filter.ROUNDS):
            then = {}
            for h, m in now.items():
                for t in graph.get(h, ()):
                    then[t] = then.get(t, 0) + m * url_filter.DAMPING // (100 * len(graph[h]))
            now = {h: m for h, m in then.items() if m}
            for h, m in now.items():
                total[h] = total.get(h, 0) + m
        out[kind] = total
    return out


def linked_pages():
    rng = random.Random(8)
    hosts = ["a.com", "www.example.com", "example.com", "x.example.com", "bad.net", "worse.net", "good.org", "b.org", "c.org", "d.org", "E.Org", "hub.org", "net", "com"]
    hosts += [f"s{k}.org" for k in range(20)]
    pages, links = [], []
    for k in range(200):
        src = rng.choice(hosts[:14] if k % 3 else ["hub.org"])
        url = f"http://{src}{rng.choice(['/en/1', '/es/2', '/fr/', '/fr', '', '/de/x?q=/en/', '?a', '#/es/'])}"
        out = [f"{rng.choice(['http:', 'HTTPS:', ''])}//{rng.choice(hosts)}{rng.choice(['/es/7', '/', '', '/en/8'])}" for _ in range(rng.randint(0, 4))]
        anchors = "".join(f"<p><A class='x' {rng.choice(['href', 'HREF'])} = {q}{u}{q}>t</A>" for u in out for q in [rng.choice(["'", '"'])])
        pages.append((k, url, f'<a href="/own/path">o</a><link href="http://cdn.net/es/">{anchors}<a href=mailto:x@y.net>m</a>'))
        links.append([u if "://" in u else "http:" + u for u in out])
    for url in (None, "no-scheme.net/es/", "http://", "ftp://u@good.org:80/x", "x://y://z", "http://ÄA.net/es/\nq"):
        pages.append((len(pages), url, None))
        links.append([])
    pages.append(pages[3])
    links.append(links[3])
    return pages, links


@pytest.mark.parametrize("per_task, broadcast", [(url_filter.EDGES_A_TASK, url_filter.BROADCAST), (3, 0)])
def test_urls_against_brute_force(spark, monkeypatch, per_task, broadcast):
    monkeypatch.setattr(url_filter, "EDGES_A_TASK", per_task)
    monkeypatch.setattr(url_filter, "BROADCAST", broadcast)
    pages, links = linked_pages()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "verdict": F.lit("v"), "salt": F.lit(1)})
    got = sorted(url_filter.judge_urls(df, RULES).collect(), key=lambda r: r["page_id"])
    scores, order, why = brute_scores(pages, links), sorted(pages, key=lambda r: r[0]), set()
    assert len(got) == len(order)
    for r, (_, url, _) in zip(got, order, strict=True):
        host, path = place(url)
        rule, verdict = judged(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule is None:
            t, d = (scores[k].get(host, 0) for k in ("trust", "distrust"))
            assert (r["trust"], r["distrust"]) == (t, d)
            verdict = "block" if d - t > url_filter.UNIT // 2 else "allow"
            why.add((verdict, t > 0, d > 0))
        assert r["verdict"] == verdict
    assert {v for v, _, _ in why} == {"allow", "block"} and (("allow", True, True) in why or ("block", True, True) in why)
    assert url_filter.judge_urls(df.limit(0), RULES).count() == 0


def test_no_rules_and_no_python(spark):
    df = spark.createDataFrame(linked_pages()[0], "page_id long, url string, html string")
    out = url_filter.judge_urls(df, [])
    assert {(r["rule"], r["verdict"]) for r in out.collect()} == {(None, "allow")}
    plan = url_filter.judge_urls(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
