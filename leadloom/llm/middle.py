"""Fill-in-the-middle: documents cut at two unit boundaries and written in prefix-suffix-middle or suffix-prefix-middle order.

A text is a run of units (lines with their line feeds) in UTF-8. Its bytes are cut into blocks of BLOCK; a Fenwick tree
over the blocks holds how many units end and how many code points begin in each. The place behind the u-th unit is found
by binary lifting: a descent finds the last block before which fewer than u units end, with the code points up to there,
and the place is then looked for in that one block. So a text is counted once, and each cut reads one block.

Where a document is cut, and which form it gets, follows from a hash of its id and a seed alone, so a lost task makes the
same rows again. A text that is empty or holds one of the three marks stays plain.

Defined results: a null text counts as empty; a null id is hashed as an empty string; repeated rows give repeated results;
very long texts take memory of their own size; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

BLOCK = 4096
#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_CONTINUATION = bytes(range(0x80, 0xC0))


def _code_points(part: bytes) -> int:
    return len(part.translate(None, _CONTINUATION))


class UnitTree:
    """Fenwick tree over a text's blocks, with the units that end and the code points that begin in them."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.data, self.block, self.size = data, block, -(-len(data) // block)
        self.ends, self.points = [0] * (self.size + 1), [0] * (self.size + 1)
        for k in range(1, self.size + 1):
            part = data[(k - 1) * block : k * block]
            self.ends[k] += part.count(b"\n")
            self.points[k] += _code_points(part)
            if (up := k + (k & -k)) <= self.size:
                self.ends[up] += self.ends[k]
                self.points[up] += self.points[k]
        self.closed = self._total(self.ends)
        self.units = self.closed + bool(data and not data.endswith(b"\n"))

    def _total(self, tree: list[int]) -> int:
        total, k = 0, self.size
        while k:
            total, k = total + tree[k], k & (k - 1)
        return total

    def behind(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) of the first `unit` units."""
        if unit <= 0:
            return 0, 0
        if unit > self.closed:
            return len(self.data), self._total(self.points)
        at = points = 0
        step = 1 << self.size.bit_length()
        while step:
            if at + step <= self.size and self.ends[at + step] < unit:
                at += step
                unit -= self.ends[at]
                points += self.points[at]
            step >>= 1
        start = place = at * self.block
        for _ in range(unit):
            place = self.data.index(b"\n", place) + 1
        return place, points + _code_points(self.data[start:place])


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits."""
    digits = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]


def _transformed(doc_id: object, text: str, seed: int, rate: int, spm_rate: int) -> tuple:
    data, h = text.encode(), draws(seed, doc_id)
    tree = UnitTree(data)
    n = tree.units
    if not data or h[2] % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, chars_a), (b, chars_b) = tree.behind(first), tree.behind(last)
    prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
    if h[3] % 100 < spm_rate:
        return n, "spm", chars_a, chars_b - chars_a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", chars_a, chars_b - chars_a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of every text.

    rate: of 100 texts, how many are transformed; spm_rate: of 100 of these, how many begin with the suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string() if large else pa.string()]
        for b in batches:
            got = [_transformed(i.as_py(), t.as_py(), seed, rate, spm_rate) for i, t in zip(b.column(0), b.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]], names)

    large = docs.sparkSession.conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false") == "true"
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that fill_in_middle had, from its output and form."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
