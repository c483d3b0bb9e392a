"""The walk through structured data, against one over Python's objects."""

import json
import random
import re

from pyspark.sql import functions as F

from leadloom.functions import fixed
from leadloom.operators import pages as p


def walked(html):
    out = []
    for block in re.findall(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", html):
        try:
            level = [json.loads(block)]
        except ValueError:
            try:
                level = [json.loads(block[: block.rfind("}") + 1])]
            except ValueError:
                continue
        level = [x for x in level if isinstance(x, (dict, list))]
        while level:
            below = []
            for x in level:
                if isinstance(x, list):
                    below += [v for v in x if isinstance(v, (dict, list))]
                else:
                    kinds = x.get("@type")
                    ranks = [fixed.BUSINESS_TYPES[str(k).lower()] for k in (kinds if isinstance(kinds, list) else [kinds]) if str(k).lower() in fixed.BUSINESS_TYPES]
                    if ranks:
                        part = lambda key, x=x: x[key] if isinstance(x.get(key), dict) else {}
                        text = lambda v: None if v is None or isinstance(v, (dict, list)) else str(v)
                        c = x.get("servesCuisine")
                        out.append((len(out), min(ranks), sum(bool(x.get(k)) for k in fixed.BUSINESS_KEYS), text(x.get("name")), text(part("address").get("streetAddress")), text(part("geo").get("latitude")), [str(v) for v in (c if isinstance(c, list) else [c] if c else [])]))
                    below += [v for k, v in x.items() if isinstance(v, (dict, list)) and k not in ("review", "author", "aggregateRating")]
            level = below
    return out


def test_random_blocks(spark):
    rng = random.Random(12)

    def value(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return rng.choice(["x", "{\"@type\":\"Bar\"}", "[1]", "", 0, 3, None, "a\"}b", "ä", [], {}])
        if kind < 0.5:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        out = {rng.choice(["a", "b", "z", "review", "author", "item", "@graph", "geo", "menu"]): value(depth - 1) for _ in range(rng.randint(0, 3))}
        if rng.random() < 0.7:
            out["@type"] = rng.choice(["Restaurant", "BAR", ["Thing", "Hotel"], "Thing", ["Bar", "Restaurant"], None])
        if rng.random() < 0.5:
            out |= {"name": rng.choice(["N", None, {"x": 1}]), "address": rng.choice([{"streetAddress": "K 1"}, "text", None, [{"streetAddress": "no"}]]), "servesCuisine": rng.choice(["sushi", ["a", "b"], [], None])}
            out |= {"geo": rng.choice([{"latitude": "60.1"}, None, {"latitude": {"v": 1}}]), "telephone": rng.choice(["1", "", None])}
        return out

    pages = []
    for k in range(300):
        blocks = [json.dumps(value(rng.randint(0, 7)), ensure_ascii=rng.random() < 0.5) + rng.choice(["", "", "", " trailing;"]) for _ in range(rng.randint(0, 3))]
        pages.append((k, "<p>x</p>".join(f'<script id=1 type="application/LD+json">\n{b}</script>' for b in blocks)))
    pages.append((300, '<script type="application/ld+json">' + '{"a":[' * 40 + '{"@type":"Bar","name":"deep"}' + "]}" * 40 + "</script>"))
    df = spark.createDataFrame([*pages, (301, None)], "page_id long, html string").withColumn("name", F.lit("clash")).repartition(4)
    got = {}
    for r in p.jsonld_nodes(df).collect():
        got.setdefault(r["page_id"], []).append((r["pos"], r["type_rank"], r["filled"], r["name"], r["street"], r["lat"], r["cuisine"]))
    want = {k: walked(h) for k, h in pages}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v} and 300 in got
    plan = p.detail_fields(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
