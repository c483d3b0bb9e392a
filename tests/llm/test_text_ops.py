"""Packing, encoding, counting, HTML and toxicity against the libraries or brute force."""

import array
import hashlib
import random
import zlib

import pytest

from leadloom.llm import bpe, common, packing, token_counts, toxicity
from leadloom.llm.html_text import LEAST_PAGES, Page, main_text

TEXTS = [(1, None, "a"), (2, "", "b"), (3, "a  b\n\n c<|endoftext|> d  \x00 x\x1c y", "c"), (3, "hello hello world", "c"), (None, "é漢字 😀 x" * 50, "d"), (5, " ".join(f"w{i}" for i in range(3000)), "e"), (5, " ".join(f"w{i}" for i in range(3000)), "e"), (6, "x" * 5000, "f"), (7, "The  'll thé's  end \n", "g")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, word string")


def ids_of(name, text):
    return array.array("I", common.tokenizer(common.public_vocabulary(name)).encode(text or "", add_special_tokens=False).ids)


def key(rows):
    return sorted(map(str, rows))


def test_chunks_give_the_library_s_ids():
    rng = random.Random(1)
    letters = [*"ab  \n\n\t\r'sd12é ,.! \x1cćΑΣ漢", "<|endoftext|>", "<|endo", "'ll", "\x00", "The", "thé", "Ö."]
    plain, words = common.ChunkIds(common.public_vocabulary("byte_bpe_50k.json")), packing.WordIds(common.public_vocabulary("word_bpe_49k.json"))
    counter = token_counts.MergeCounter(common.public_vocabulary("byte_bpe_50k.json"))
    for _ in range(4000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        want = ids_of("byte_bpe_50k.json", s)
        assert plain.of(common.spaced_chunks(s)) == want.tobytes(), s
        assert counter.count(s) == len(want), s
        assert words.of(common.word_chunks(s)) == ids_of("word_bpe_49k.json", s).tobytes(), s


def test_words_with_signs_pass_the_library_by(monkeypatch):
    rng = random.Random(2)
    words = packing.WordIds(common.public_vocabulary("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "SIGNS", 400)
    seen, encode = set(), words.encode
    monkeypatch.setattr(words, "encode", lambda chunks: seen.update(chunks) or encode(chunks))
    signs = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    for k in range(600):
        c = rng.choice(["word", "THÉ", "Öß", "a"]) + "".join(rng.choice(signs) for _ in range(rng.randint(1, 8)))
        assert words.of([c]) == ids_of("word_bpe_49k.json", c).tobytes(), c
        assert c not in seen or k > 399
    assert len(words.ends) == 400
    for c in ("don't", "a1%%", "a%%b", "%%a", "a'", "ab<|endoftext|>", "e\u0301%", "x" * 39 + "%%", "漢%%"):
        assert words.of([c]) == ids_of("word_bpe_49k.json", c).tobytes() and c in seen, c


def test_a_text_of_more_words_than_are_remembered(monkeypatch):
    monkeypatch.setattr(common, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(packing, "CHUNKS", 10)
    words = packing.WordIds(common.public_vocabulary("word_bpe_49k.json"))
    for shift in (0, 7):
        text = " ".join(f"{'abcdefgh'[k % 8]}{'stuvwxyz'[k // 8]} {k} 漢{k}" for k in range(shift, 60))
        assert words.of(common.word_chunks(text)) == ids_of("word_bpe_49k.json", text).tobytes()


def test_encode_decode(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 600)
    want = []
    for d, t, _ in TEXTS:
        ids = ids_of("byte_bpe_50k.json", t)
        want.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert key(tuple(r) for r in bpe.encode_decode(docs).collect()) == key(want)
    assert key(r["decoded"] for r in bpe.encode_decode(docs, digests=False).collect()) == key(t or "" for _, t, _ in TEXTS)
    assert bpe.encode_decode(docs.limit(0)).count() == 0


def test_counts(docs):
    want = [(d, len((t or "").encode()), len(ids_of("byte_bpe_50k.json", t)), len(ids_of("byte_bpe_50k.json", t)) > 512) for d, t, _ in TEXTS]
    assert key(tuple(r) for r in token_counts.count_tokens(docs).collect()) == key(want)


def test_packing(docs):
    rows = packing.pack_documents(docs, length=64, with_ids=True).collect()
    bins = {}
    for r in rows:
        assert 1 <= r["length"] <= 64 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    want = [len(ids_of("word_bpe_49k.json", t)) + 1 for _, t, _ in TEXTS]
    assert sum(r["length"] for r in rows) == sum(want)
    full = {(str(r["doc_id"]), r["piece"]): r for r in rows}
    assert all(full[k]["start"] == k[1] * 64 for k in full)
    assert len(bins) <= -(-sum(want) // 64) + 5


def test_best_fit_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert [b.place(n) for n in (6, 7, 8, 3, 4)] == [(0, 0), (1, 0), (2, 0), (1, 7), (0, 6)]


def test_html(spark):
    menu = '<div class="x"><p>Subscribe now</p><p>Second line</p></div>'
    rows = [(k, f"https://a.fi/{k}", f"<nav>m</nav>{menu}<p>Text {k}&nbsp;&amp;<br>more</p><footer>f</footer>") for k in range(LEAST_PAGES + 2)]
    rows += [(100, "https://b.fi/1", "<p>Text 1</p>"), (101, None, None), (102, "https://a.fi/x", ""), (100, "https://b.fi/1", "<p>Text 1</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS host", "1 AS key")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text(pages).collect()}
    assert got[3] == ("Text 3 & more", 13) and got[100] == ("Text 1", 6) and got[101] == ("", 0) and got[102] == ("", 0)
    assert main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html, want", [
    ('<div class="cookie">We use</div><h1>T</h1><p>a&nbsp;b<br>c</p><form>x<p>y</p></form><aside>no</aside><p>z &lt;3 &eacute', "T\n\na b c\n\nz <3 é"), ("<p>one<p>two<nav>m</nav> three<li class=menu>q<li>ok", "one\n\ntwo\n\nthree\n\nok"),
    ('<article><header><h1>T</h1></header><p>x</p><div id="comments"><div>c1</div></div><p>y</article>', "T\n\nx\n\ny"), ("a < b", "a < b"), ("<p>cut <b", "cut"), ('<script>var x="<p>no</p>"</script>text', "text"), ("<nav>open<article><p>hi</p>", "hi"), ("<!-- <p>no</p> --><p>yes<!-- open", "yes"),
])
def test_page(html, want):
    assert Page(html).text(set()) == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton():
    rng, terms = random.Random(2), ["idiot", "moron", "worthless", "disgusting", "scum", "vequ*", "lowei*", "pathetics*", "abab"]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        t = list(rng.choice(terms).rstrip("*"))
        for _ in range(rng.randint(0, 3)):
            i, what = rng.randint(0, len(t)), rng.random()
            t[i : i + (what > 0.35)] = [] if what > 0.7 else [rng.choice("abdiotmrnx")]
        w = "".join(t)
        found = []
        for x in terms:
            s = x.rstrip("*")
            d = min(distance(s, w[:k]) for k in range(len(w) + 1)) if x[-1] == "*" else distance(s, w)
            if d <= toxicity.edits_allowed(x):
                found.append((d, -len(x), x))
        want = (min(found)[2], min(found)[0]) if found and w else None
        assert lexicon.find(w) == want, w


def test_toxicity_held_out(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity(d, labels).join(labels.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out()).toPandas()
    assert (scored.predicted == scored.toxic).mean() >= 0.9 and scored.score.between(0, 1).all()
    model = toxicity.fit(d, labels)
    reader = toxicity.Reader(model.weights)
    say = lambda t: model.score(reader.hits(t))
    assert say("you idiot and moron, worthless scum") > 0.5 > say("a kind and lovely day") and say("worthles morom, idioot") > say("a kind day")
    assert say('she said "you idiot and moron" to quote them') < say("you idiot and moron, you idiot")


def test_toxicity_edges(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "x " * 20000), (3, "x " * 20000)]
    d = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, toxic string")
    for labels in (spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([(1, 1, None), (2, 1, 1)], "doc_id long, quality int, toxic int")):
        assert [r["predicted"] for r in toxicity.toxicity(d, labels).collect()] == [0] * 5
    assert toxicity.toxicity(d.limit(0), labels).count() == 0


def test_every_word_of_the_lexicon_is_looked_for_with_edits(spark):
    """150 toxic words, some of them misspelt: none is left out for being one too many."""
    import random
    import zlib
    from collections import Counter

    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    bad, fill = [word(10) for _ in range(150)], [word(6) for _ in range(300)]
    texts = [(" ".join(rng.choice(fill) if k % 3 else rng.choice(bad) for k in range(60)), 1) for _ in range(300)] + [(" ".join(rng.choice(fill) for _ in range(60)), 0) for _ in range(1500)]
    ids = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 5][: len(texts)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in zip(ids, texts, strict=True)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in zip(ids, texts, strict=True)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert set(bad) <= set(model.weights) and not set(bad) & model.innocent
    reader, none = toxicity.Reader(model.weights, model.innocent), model.score(Counter())
    found = {w: reader.hits(f"{fill[0]} {w[:4]}{w[5:]} {fill[1]}") for w in bad}
    assert all([k[:2] for k in hits] == [(w, 1)] and model.score(hits) > none for w, hits in found.items())
