"""Token counts by byte-pair merging, without making ids.

A word's symbols are a linked list and its adjacent pairs a heap by merge rank: the pair of lowest rank (leftmost on
ties) merges again and again; the count is the initial symbols less the merges. Texts are cut into chunks whose counts
are independent (see common.spaced_chunks); a worker remembers counts of short chunks up to a bound, so a frequent
word is merged about once a worker. A narrow job: no shuffle, a row in, a row out, whole texts.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows are counted again; an empty table gives
no rows; other columns are ignored. The file's special strings inside a text count one token each, as in the library.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_CHARS, CACHE_ENTRIES, public_vocabulary, spaced_chunks, whole_text


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others take the code points from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(keep) else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts of one byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.symbols = byte_symbols()
        self.words = regex.compile(public_tokenizers.PATTERN)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.marks = set(special)
        self.of_word: dict[str, int] = {}
        self.of_chunk: dict[str, int] = {"": 0}

    def merged(self, word: bytes) -> int:
        """Symbols left of a word when no pair can merge."""
        part = [self.symbols[b] for b in word]
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := rank.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = a + b, ""
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            h = before[i]
            if h >= 0 and (r := rank.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return left

    def _word(self, word: str) -> int:
        n = self.of_word.get(word)
        if n is None:
            n = self.merged(word.encode())
            if len(word) <= CACHE_CHARS:
                if len(self.of_word) > CACHE_ENTRIES:
                    self.of_word.clear()
                self.of_word[word] = n
        return n

    def _chunk(self, chunk: str) -> int:
        n = self.of_chunk.get(chunk)
        if n is None:
            n = 0
            for seg in self.special.split(chunk) if self.special else [chunk]:
                n += 1 if seg in self.marks else sum(map(self._word, self.words.findall(seg)))
            if len(chunk) <= CACHE_CHARS:
                if len(self.of_chunk) > CACHE_ENTRIES:
                    self.of_chunk.clear()
                    self.of_chunk[""] = 0
                self.of_chunk[chunk] = n
        return n

    def count(self, text: str) -> int:
        chunks = spaced_chunks(text)
        try:
            return sum(map(self.of_chunk.__getitem__, chunks))
        except KeyError:
            return sum(map(self._chunk, chunks))


_counters: dict[str, MergeCounter] = {}


def count_tokens(docs: DataFrame, vocabulary_path: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every text."""
    path = vocabulary_path or public_vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = MergeCounter(path)
        count = _counters[path].count
        for b in batches:
            n = [count(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
