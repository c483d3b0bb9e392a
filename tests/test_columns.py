"""Character references and URL resolution as columns, against the standard library."""

import html
import random
from html.entities import html5
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from leadloom.functions.references import unescape
from leadloom.functions.text import fold, normalise_text, visible_text
from leadloom.functions.urls import absolute_url


def test_unescape_is_the_library_s(spark):
    rng = random.Random(6)
    names = list(html5)
    texts = [f"a&{n}b &{n.rstrip(';')} &{n.rstrip(';')}x; &{n[:-2]}" for n in names]
    texts += [f"&#{k}; &#{k} &#x{k:x}; &#X{k:X}z &#000{k};" for k in (*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**12, 10**40)]
    texts += ["", "&", "&&amp;;", "&amp;lt;", "& amp;", "&;", "&#;", "&#x;", "&#xg;", "&notit; &notin; &no", "&" + "a" * 40 + ";", "info&#64;aoi.fi", "&Ouml;&ouml &auml", "é&eacute;𝄞&#x1D11E;&", "a=1&copy=2&lt", "\n&\tamp;"]
    texts += ["".join(rng.choice(["&", "#", "x", "amp", ";", "not", "in", "64", "é", " ", "lt", "\n", "&#38", "0"]) for _ in range(12)) for _ in range(1500)]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(4).select("k", unescape(F.col("t")).alias("x")).collect()
    assert {r["k"]: r["x"] for r in got} == {k: html.unescape(t) for k, t in enumerate(texts)}
    assert spark.createDataFrame([(None,)], "t string").select(unescape(F.col("t")).alias("x")).first()["x"] is None


@pytest.mark.parametrize("source, want", [("<p>a&nbsp;b&#8195;c&shy;d</p>", "a b c\xadd"), ("x &lt;b&gt; y<b>z</b>", "x <b> y z"), ("<script>&lt;</script>&auml;iti", "äiti"), (" a　\x1cb ", "a b"), (None, "")])
def test_visible_text(spark, source, want):
    assert spark.createDataFrame([(source,)], "t string").select(visible_text(F.col("t")).alias("x")).first()["x"] == want


@pytest.mark.parametrize("source, want", [("Nguyễn", "Nguyen"), ("ﬁlet Oﬀice", "filet Office"), ("Åbo ß Þór", "Abo ss THor"), ("ｶﾌｪ Ｃａｆｅ①", "ｶﾌｪ Cafe1"), ("Ĳsselmeer", "IJsselmeer"), ("Ωmega", "Ωmega")])
def test_fold(spark, source, want):
    row = spark.createDataFrame([(source,)], "t string").select(fold(F.col("t")).alias("x"), normalise_text(F.col("t")).alias("y")).first()
    assert row["x"] == want and row["y"].isascii()


def test_urls_are_the_library_s(spark):
    rng = random.Random(9)
    bases = ["http://a/b/c/d;p?q", "https://www.x.fi", "https://x.fi/", "https://x.fi/a//b/../c/", "http://x.fi:80/p;a/q;b?c#d", "HTTP://X.fi/a", "http://x.fi?q", "", "file:///a/b", "//x.fi/p", "a/b", "mailto:a@b", "https://[::1]/x", "/root/dir/page"]
    hrefs = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x", "g#s/./x", "http:g", "http:///x", "HTTPS://Y.fi/A?b#c", "mailto:x@y.fi", "tel:+358 1", "javascript:void(0)", "data:text/html,a", " /trim\n", "a\tb", "//y.fi", "///y", "a//b", "//[x", "/a b/ä?ö", "?", "#", "g?", "1:2", "a;b;c/d;e;", "/..", "/a/..", "%2e%2e/x"]
    hrefs += ["".join(rng.choice(["a", "/", "..", ".", "?", "#", ";", ":", "b", "//", "http:", "=", "é"]) for _ in range(rng.randint(1, 7))) for _ in range(700)]
    pairs = [(b, h) for b in bases for h in hrefs]

    def want(b, h):
        try:
            return urljoin(b, h.strip())
        except ValueError:
            return None

    got = spark.createDataFrame(pairs, "b string, h string").distinct().select("b", "h", absolute_url(F.col("b"), F.col("h")).alias("x")).collect()
    wrong = [(r["b"], r["h"], r["x"], want(r["b"], r["h"])) for r in got if r["x"] != want(r["b"], r["h"])]
    assert not wrong, (len(wrong), wrong[:10])
