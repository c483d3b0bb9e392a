"""Toxicity scores from a learned lexicon, its misspellings and the context of each hit.

Fitting, on a bounded sample of labelled rows: words and word beginnings that toxic texts use far more often than
others, mostly next to different neighbours (so that a much copied text makes no terms), become the lexicon (a beginning
stands for a stem whose endings vary). A trie holds the terms; a word is looked up by walking the trie
together with the Levenshtein automaton of the word, which keeps, for each number of edits, the set of reachable
positions as bits, so a walk ends where no position is left. Misspelt forms that other texts use as ordinary words are
set aside, and so are all misspelt forms of terms whose misspelt forms tell nothing in the sample. Each hit counts its
term's weight, by as much less for edits as hits of so many edits tell less in the sample. Hits in quotation marks (within a paragraph), or near a word of reporting, count by a share, which the sample
decides if LEAST of its texts have such hits. A small logistic regression turns these sums into a score.

Scoring is a narrow job: whole texts, no shuffle; the model (as many terms as the sample tells apart) travels with the tasks, and a
worker remembers the hits of short chunks up to a bound.

Defined results: null text counts as empty; an empty text or one without hits gets the score of no hits; repeated rows
score alike; without labelled rows of both kinds every score is 0; an empty table gives no rows; other columns pass.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_CHARS, cut, memory_of, whole_text

#: Labelled rows that the model is fitted on. What they hold bounds candidates, terms and forms; none of these is cut off.
SAMPLE_ROWS = 20_000
#: Toxic texts that a term is in and neighbours that it has at least, lengths of word beginnings that may become terms,
#: and words of context on either side.
LEAST, STEMS, CONTEXT = 4, (4, 5, 6, 7, 8), 6
#: Different neighbours that a term has at least for each of its uses; copies of one text bring the same ones.
OWN_CONTEXTS = 0.5
#: What edits leave of a weight where the sample has too few hits to tell, and shares at which quoted hits may count, the
#: first where it can't tell.
CLOSENESS, QUOTED = (1.0, 0.7, 0.5), (0.25, 0.0, 0.1, 0.5, 1.0)
#: Words of reporting in the languages of the tables (fixed values).
REPORTING = frozenset("said says wrote called quote quoted quotes reported sagte schrieb nannte zitat zitierte dit écrit appelé citation cité dijo escribió llamó cita citó".split())
#: Chunks that a worker remembers; the other caches of the subpackage may stand beside this one.
REMEMBERED = 100_000
_WORD = re.compile(r"[^\W_]+")
_QUOTED = re.compile("|".join(f"{a}(?:[^{z}\n]|\n(?!\\s*\n))+{z}" for a, z in ('""', "“”", "„“", "«»")))


def edits_allowed(term: str) -> int:
    """Of whole words: none under five letters, one under eight, else two. Of beginnings (with a star): none under
    seven letters, else one."""
    n = len(term)
    if term.endswith("*"):
        return int(n > 7)
    return 0 if n < 5 else 1 if n < 8 else 2


class Lexicon:
    """A trie of terms, searched with the Levenshtein automaton of a word."""

    def __init__(self, terms: Iterable[str]):
        self.root: dict = {}
        first, last, inner = set(), set(), set()
        for t in terms:
            stem, most = t.rstrip("*"), edits_allowed(t)
            node = self.root
            for c in stem:
                node = node.setdefault(c, {})
            node.setdefault("", []).append((t, most))
            # of most + 1 parts, one is left whole by so many edits
            cuts = [len(stem) * k // (most + 1) for k in range(most + 2)]
            parts = [stem[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            first.add(parts[0])
            inner.update(parts[1:] if t.endswith("*") else parts[1:-1])
            if most and not t.endswith("*"):
                last.add(parts[-1])
        words = lambda s: "|".join(map(re.escape, sorted(s))) or "(?!)"
        self.may_hit = re.compile(f"^(?:{words(first)})|(?:{words(last)})$|{words(inner)}").search

    def find(self, word: str) -> tuple[str, int] | None:
        """The term nearest to the word within its allowed edits, and the edits; terms of fewer edits, then longer ones,
        come first."""
        if not self.may_hit(word):
            return None
        n = len(word)
        where: dict[str, int] = {}
        for i, c in enumerate(word):
            where[c] = where.get(c, 0) | 1 << i
        every, end = (1 << n + 1) - 1, 1 << n
        best: tuple[int, int, str] | None = None
        # states[e]: bit i is set if e edits lead from the trie's path to the first i letters of the word
        stack = [(self.root, (1, 3 & every, 7 & every))]
        while stack:
            node, states = stack.pop()
            for c, below in node.items():
                if not c:
                    for term, most in below:
                        for e in range(most + 1):
                            if states[e] & end or term[-1] == "*" and states[e]:
                                key = (e, -len(term), term)
                                best = key if best is None else min(best, key)
                                break
                    continue
                m = where.get(c, 0)
                s0 = (states[0] & m) << 1
                s1 = (states[1] & m) << 1 | states[0] | states[0] << 1 | s0 << 1
                s2 = (states[2] & m) << 1 | states[1] | states[1] << 1 | s1 << 1
                if (s0 | s1 | s2) & every:
                    stack.append((below, (s0 & every, s1 & every, s2 & every)))
        return (best[2], best[0]) if best else None


class Reader:
    """Hits of a text, with chunks remembered. as_written: terms that are looked up without edits, so not in the trie."""

    def __init__(self, terms: Iterable[str], as_written: frozenset[str] = frozenset()):
        terms = list(terms)
        self.as_written = as_written.intersection(terms)
        self.lexicon = Lexicon(t for t in terms if t not in self.as_written)
        self.known: dict[str, tuple] = {}

    def find(self, word: str) -> tuple[str, int] | None:
        """As Lexicon.find, over both kinds of terms."""
        hit = self.lexicon.find(word)
        if self.as_written:
            own = [t for t in (word, *(word[:n] + "*" for n in STEMS if len(word) >= n)) if t in self.as_written]
            if own:
                term = max(own, key=len)
                if hit is None or hit[1] or len(term) > len(hit[0]):
                    return term, 0
        return hit

    def _chunk(self, chunk: str) -> tuple:
        """(term, form, edits) of each hit in a chunk."""
        got = self.known.get(chunk)
        if got is None:
            got = tuple((*hit, w) for w in _WORD.findall(chunk) if (hit := self.find(w)))
            if len(chunk) <= CACHE_CHARS:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known[chunk] = got
        return got

    def hits(self, text: str) -> Counter:
        """Counts of (term, edits, form, quoted)."""
        text = text.lower()
        chunks = text.replace("\n", " ").split(" ")
        try:
            found = list(map(self.known.__getitem__, chunks))
        except KeyError:
            found = list(map(self._chunk, chunks))
        out: Counter = Counter()
        if not any(found):
            return out
        quotes, place = [m.span() for m in _QUOTED.finditer(text)], 0
        for k, (chunk, got) in enumerate(zip(chunks, found, strict=True)):
            if got:
                near = chunks[max(0, k - CONTEXT) : k + CONTEXT + 1]
                reported = any(w.strip(".,:;!?\"'()") in REPORTING for w in near)
                quoted = reported or any(a <= place < b for a, b in quotes)
                for hit in got:
                    out[(*hit, quoted)] += 1
            place += len(chunk) + 1
        return out


class Model:
    """Terms with weights, forms set aside (and terms, by themselves, that count as written only), what edits leave of a weight, at which share quoted hits count, and the
    regression's coefficients."""

    def __init__(self, weights: dict[str, float], innocent: frozenset[str] = frozenset(), closeness: tuple[float, ...] = CLOSENESS, quoted: float = QUOTED[0], coef: tuple[float, ...] = (0.0,) * 3):
        self.weights, self.innocent, self.closeness, self.quoted, self.coef = weights, innocent, closeness, quoted, coef

    def features(self, hits: Iterable[tuple[tuple, int]]) -> tuple[float, float, float]:
        worth = 0.0
        terms: dict[str, float] = {}
        for (term, edits, form, in_quotes), count in hits:
            if edits and (form in self.innocent or term in self.innocent):
                continue
            share = self.closeness[edits] * (self.quoted if in_quotes else 1.0)
            worth += self.weights[term] * share * count
            terms[term] = max(terms.get(term, 0.0), share)
        return 1.0, math.log1p(worth), math.log1p(sum(terms.values()))

    def score(self, hits: Counter) -> float:
        z = sum(c * x for c, x in zip(self.coef, self.features(hits.items()), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def forms_of(text: str) -> set[str]:
    """Words of a text and, with a star, their beginnings."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton's method with a ridge on all coefficients but the first."""
    w, keep = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights (log odds) of terms whose log odds are well over zero for their counts; a term that another one, found
    nearly as often in toxic texts, is a longer form of gives way to it, and rarer forms give way to their stem."""
    scored = []
    longest: dict[str, int] = {}  # of each beginning, in how many toxic texts the most frequent longer form is
    for t, a in toxic.items():
        b = clean.get(t, 0)
        odds = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        sure = odds - 1.64 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if a >= LEAST and sure > 1.5:
            scored.append((a, t, min(odds, 8.0), sure))
            stem = t.rstrip("*")
            for n in range(1, len(stem) + (t[-1] != "*")):
                longest[stem[:n]] = max(a, longest.get(stem[:n], 0))
    chosen: dict[str, float] = {}
    for a, t, odds, _ in sorted(scored, key=lambda x: (-x[3], -len(x[1].rstrip("*")), x[1])):
        longer = t.endswith("*") and longest.get(t[:-1], 0) >= 0.95 * a
        covered = any(f"{t[:n]}*" in chosen for n in STEMS if n <= len(t.rstrip("*")) and f"{t[:n]}*" != t)
        if not longer and not covered:
            chosen[t] = odds
    return chosen


def contexts_of(text: str, terms: dict[str, float]) -> Counter:
    """How often each (term, word before, word after) is used in a text."""
    words = ["", *_WORD.findall(text.lower()), ""]
    out: Counter = Counter()
    for k in range(1, len(words) - 1):
        w = words[k]
        for t in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)):
            if t in terms:
                out[t, words[k - 1], words[k + 1]] += 1
    return out


def uses_of(rows: list[tuple[list, int]], part: int) -> dict[str, list[int]]:
    """Of misspelt hits by term (part 0) or form (part 2): in how many texts that aren't and that are toxic."""
    uses: dict[str, list[int]] = {}
    for hits, y in rows:
        for x in {k[part] for k, _ in hits if k[1]}:
            uses.setdefault(x, [0, 0])[y] += 1
    return uses


def plain_forms(rows: list[tuple[list, int]], size: dict[int, int]) -> frozenset[str]:
    """Misspelt forms that other texts use as ordinary words."""
    uses = uses_of(rows, 2)
    return frozenset(f for f, (a, b) in uses.items() if (b + 0.5) / (size[1] + 1) < 3 * (a + 0.5) / (size[0] + 1) and a)


def learned_closeness(rows: list[tuple[list, int]], innocent: frozenset[str], n_toxic: int, n_clean: int) -> tuple[float, ...]:
    """For each number of edits the log odds of its unquoted hits, over those of hits without edits."""
    seen = np.zeros((3, 2))
    for hits, y in rows:
        for e in {k[1] for k, _ in hits if not k[3] and not (k[1] and (k[2] in innocent or k[0] in innocent))}:
            seen[e][y] += 1
    odds = np.log((seen[:, 1] + 0.5) / (n_toxic + 1)) - np.log((seen[:, 0] + 0.5) / (n_clean + 1))
    if seen[0].sum() < LEAST or odds[0] <= 0:
        return CLOSENESS
    return tuple(float(np.clip(odds[e] / odds[0], 0, 1)) if seen[e].sum() >= LEAST else CLOSENESS[e] for e in range(3))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fits on at most about SAMPLE_ROWS labelled rows that aren't held out, chosen by a hash of the id."""
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").alias("id"), "toxic").where(F.col("id").isNotNull() & ~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if not n:
        return None
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(math.ceil((1 << 20) * min(1.0, SAMPLE_ROWS / n)))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).where(share)
    sample = cut(texts.join(known.where(share), "id").select("text", "toxic"))
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not size.get(1) or not size.get(0):
        return None

    def counted(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                for t in b.column(0):
                    forms = forms_of(t.as_py())
                    seen.update(forms if wanted is None else forms & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

        return rows.select("text").mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))

    toxic = {r["term"]: r["n"] for r in counted(sample.where("toxic = 1"), None).where(F.col("n") >= LEAST).collect()}
    clean = {r["term"]: r["n"] for r in counted(sample.where("toxic = 0"), frozenset(toxic)).collect()}
    chosen = choose_terms(toxic, clean, size[1], size[0])

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uses: Counter = Counter()
            for t in b.column(0):
                uses.update(contexts_of(t.as_py(), chosen))
            cols = list(zip(*uses, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in cols), pa.array(list(uses.values()), pa.int64())], ["term", "before", "after", "n"])

    uses = sample.where("toxic = 1").select("text").mapInArrow(used, "term string, before string, after string, n bigint").groupBy("term", "before", "after").agg(F.sum("n").alias("n"))
    spread = uses.groupBy("term").agg(F.count("*").alias("contexts"), F.sum("n").alias("uses")).where((F.col("contexts") >= LEAST) & (F.col("contexts") >= OWN_CONTEXTS * F.col("uses")))
    spread = {r["term"] for r in spread.collect()}
    weights = {t: odds for t, odds in chosen.items() if t in spread}  # the surest first
    if not weights:
        return None

    misspelt = [t for t in weights if t[-1] != "*" and edits_allowed(t)]
    certain = frozenset(weights.keys() - set(misspelt))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(weights, certain)
        for b in batches:
            texts = b.column(0).to_pylist()
            got = [json.dumps([[*k, c] for k, c in reader.hits(t).items()]) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string()), b.column(1).cast(pa.int32()), pa.array([zlib.crc32(t.encode()) % 2 for t in texts], pa.int32())], ["hits", "toxic", "half"])

    read_rows = sample.mapInArrow(read, "hits string, toxic int, half int").collect()
    rows = [([((t, e, f, q), c) for t, e, f, q, c in json.loads(r["hits"])], r["toxic"]) for r in read_rows]
    # forms are set aside by one half of the sample before the other half tells what misspelt forms are worth
    halves = [[x for x, r in zip(rows, read_rows, strict=True) if r["half"] == k] for k in (0, 1)]
    judged = [([(k, c) for k, c in hits if not k[1] or k[2] not in plain], y) for k in (0, 1) for plain in [plain_forms(halves[k], size)] for hits, y in halves[1 - k]]
    as_written = {t for t, (a, b) in uses_of(judged, 0).items() if a and (b + 0.5) / (size[1] + 1) < 3 * (a + 0.5) / (size[0] + 1)}
    closeness = learned_closeness(judged, frozenset(as_written), size[1], size[0])
    innocent = plain_forms(rows, size) | as_written | certain
    y = np.array([y for _, y in rows], float)
    told = sum(any(k[3] for k, _ in hits) for hits, _ in rows) >= LEAST
    models = []
    for quoted in QUOTED if told else QUOTED[:1]:
        model = Model(weights, innocent, closeness, quoted)
        x = np.array([model.features(h) for h, _ in rows])
        model.coef = tuple(logistic(x, y).tolist())
        p = 1 / (1 + np.exp(-np.clip(x @ np.array(model.coef), -40, 40)))
        models.append((float(-(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)).sum()), len(models), model))
    return min(models)[2]


def score(docs: DataFrame, model: Model | None, text_col: str = "text", as_col: str = "score") -> DataFrame:
    """docs with a score from 0 to 1."""
    if model is None:
        return docs.withColumn(as_col, F.lit(0.0))

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = (tuple(model.weights), model.innocent)
        memory = memory_of("toxicity")
        if key not in memory:
            memory.clear()
            memory[key] = Reader(model.weights, model.innocent)
        reader = memory[key]
        for t in texts:
            yield pd.Series([model.score(reader.hits(x)) for x in t], dtype=float)

    return docs.withColumn(as_col, of(whole_text(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with score (of a model fitted on the labelled rows among them) and predicted."""
    scored = score(docs, fit(docs, labels, id_col, text_col), text_col)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
