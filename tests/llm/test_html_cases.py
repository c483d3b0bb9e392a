"""Structure rules of the main text, and site templates against a brute-force count."""

import pytest

from leadloom.llm import html_text
from leadloom.llm.html_text import LEAST_PAGES, SHARE, Page, main_text, site_templates

LONG = "story " * 60


@pytest.mark.parametrize("html, want", [
    ('<div class="with-sidebar"><p>story', "story"), ('<div class="story no-comments"><p>story', "story"), ('<div class="elementor-widget-text"><p>story', "story"),
    ('<div class="social-history"><p>story', "story"), ('<div id="related-work"><p>story', "story"), (f'<form id="aspnetForm"><div><p>{LONG}</p></div><div class="menu">x</div></form>', LONG.strip()),
    ('<article>Main</article><div id="comments"><article class="comment-body">reader comment</article></div>', "Main"), ("<main>story</main><aside><article>teaser</article></aside>", "story"),
    ("<div>whole story, longer than it</div><article>teaser</article>", "whole story, longer than it\n\nteaser"), ('<p>a <span class="ad">buy</span> b</p>', "a b"),
    ('<div class="site-footer">f</div><div class="main-menu">m</div><p>x', "x"), ("<header><h1>Site</h1></header><p>x", "x"), ("<p>" + "y" * 200_000, "y" * 200_000), ("", ""),
])
def test_structure(html, want):
    assert Page(html).text(set()) == want


def rows_of_hosts():
    box = lambda k: f'<div class="x{k}"><p>Follow our letters {k % 3}</p><p>Every week</p></div>'
    rows = [(k, f"https://a.fi/{k}", f"<p>Text {k}</p>{box(1)}{box(k) if k % 2 else ''}") for k in range(24)]
    rows += [(100 + k, f"https://b.fi/{k}", f"<p>Other {k}</p><p>Once</p>") for k in range(LEAST_PAGES - 1)]
    return rows + [(200 + k, "https://a.fi/0", rows[0][2]) for k in range(30)]  # copies of one page


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_templates(spark, monkeypatch, broadcast):
    monkeypatch.setattr(html_text, "BROADCAST", broadcast)
    rows = rows_of_hosts()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    of_host = {}
    for _, url, html in rows:
        of_host.setdefault(url.split("/")[2], {})[html] = Page(html)
    want = {}
    for host, own in of_host.items():
        counts = {}
        for page in own.values():
            for h in {h for h, _, _ in page.subtrees}:
                counts[h] = counts.get(h, 0) + 1
        want[host] = {h for h, n in counts.items() if n >= LEAST_PAGES and n >= SHARE * len(own)}
    found = site_templates(pages.selectExpr("split(url, '/')[2] AS host", "xxhash64(html) AS key", "html"))
    assert {r["host"]: set(r["templates"]) for r in found.collect()} == {h: x for h, x in want.items() if x}
    got = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    assert got == {k: of_host[url.split("/")[2]][html].text(want[url.split("/")[2]]) for k, url, html in rows}
    changed = sum(got[k] != Page(html).text(set()) for k, _, html in rows)
    assert changed >= 24 and got[2] == "Text 2" and got[3] == "Text 3\n\nFollow our letters 0" and got[100] == "Other 0\n\nOnce"


@pytest.mark.parametrize("unit", ["<ul><li>a b c", "<div class=ad>x y", "<article>x<div class=menu>y", "<span class=ad>x", "<nav><main>x", "<article>x</article><div class=ad>y</div>"])
def test_time_grows_with_the_page(unit):
    """Deep or many elements: ten times the page takes about ten times as long, not a hundred times."""
    import time

    def took(n):
        began = time.process_time()
        Page(unit * n).text({1})
        return time.process_time() - began

    took(100)
    assert took(40_000) < 40 * took(4_000) + 0.2
