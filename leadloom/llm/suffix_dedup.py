"""Exact removal of repeated byte strings by partitioned bucket-pointer refinement.

Every window of `span` bytes has a least q-gram (by a hash), and equal windows have the same one; so each text is cut
into runs of neighbouring windows with one least q-gram (superwords.py), and the runs, not the suffixes, are dealt by
it: these are the initial q-gram buckets. Buckets of a single run hold nothing that repeats and go at once. Runs with
equal content (a 128-bit hash) repeat in full and need no content. Only buckets that hold different runs fetch theirs,
each content once, and suffixes inside them are refined: positions are bucketed by 8 bytes, then sorted by the pair of
their own bucket and that of the position 8, 16, 32, ... bytes later, each pass reusing the buckets that the last one
set, until buckets are `span` deep; positions alone in a bucket drop out. Windows that share a bucket are equal.

A bucket of more than MOST contents or bytes isn't refined in one task: its contents are dealt anew by deeper q-grams (of
the bytes halfway to the span, and at last of the whole span, where a bucket holds equal windows only and is counted),
and refined there. q-grams and contents with a thousandth of all runs or more, a thousand at most, are spread over many
tasks. Copies of a text share its key, so their marks are made once and joined back.

Defined results: null text counts as empty; texts under `span` bytes lose nothing; a row that repeats with one id is a
copy like any other; an empty table gives no rows; other columns pass through. In texts kept as strings a character of
which a removal took a part goes too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, memory_of, spread_join, whole_text
from .superwords import SuperWords, gram_hashes, powers

#: Contents and bytes from which on a bucket is dealt anew by deeper q-grams, and bytes that a task refines at a time.
MOST, MOST_BYTES, AT_ONCE = 8192, 3 << 20, 1 << 18
RUN = ["mh", "k1", "k2"]


def repeated_windows(data: np.ndarray, valid: np.ndarray, span: int) -> np.ndarray:
    """For each position whether valid is set and another valid position starts the same `span` bytes (9 at least)."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(2 * span + 16, np.uint8)])
    eight = np.zeros(n + span, np.uint64)
    for j in range(8):
        eight = eight << np.uint64(8) | wide[j : j + n + span]
    # initial buckets of q bytes are found by a hash and then compared; should two differ, they start at 8 bytes
    depth = max(8, min(64, (span - 1) // 8 * 8))
    keys = gram_hashes(wide[: n + depth - 1], depth, _powers(n + depth))
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    a, b = order[same], order[same + 1]
    if not all(np.array_equal(eight[a + k], eight[b + k]) for k in range(0, depth, 8)):
        depth, keys = 8, eight[:n]
        order = np.argsort(keys)
    del wide, eight, same, a, b
    active = np.arange(n, dtype=np.int32)
    bucket, made = np.full(n + span, 0xFFFFFFFF, np.uint32), 0
    while True:
        order = order.astype(np.int32)
        keys = keys[order]
        new = np.append(True, keys[1:] != keys[:-1])[: len(order)]
        del keys
        group = new.cumsum(dtype=np.int32) - np.int32(1)
        several = np.diff(np.append(np.flatnonzero(new), len(order)))[group] > 1
        if depth == span:
            out = np.zeros(n, bool)
            out[active[order[several]]] = True
            return out
        bucket[active[order]] = group.astype(np.uint32) + np.uint32(made)
        made += int(group[-1]) + 1 if len(group) else 0
        active = np.sort(active[order[several]])
        del order, group, new, several
        later = min(depth, span - depth)
        depth += later
        if depth == span:
            active = active[valid[active]]
        keys = bucket[active].astype(np.uint64) << np.uint64(32)
        keys |= bucket[active + later]
        order = np.argsort(keys)


_known_powers: list = [np.zeros(0, np.uint64)] * 2


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 2 * AT_ONCE:
        return powers(n)  # of a large bucket, not kept
    if len(_known_powers[0]) < n:
        _known_powers[:] = powers(max(n, AT_ONCE))
    return tuple(_known_powers)


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """Half-open intervals of neighbouring true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


#: Texts that a task has in memory as Python objects at a time.
FEW = 256


def _few(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (b.slice(k, FEW) for k in range(0, b.num_rows, FEW))


def _bytes(t: pa.Scalar) -> bytes:
    t = t.as_py()
    return t.encode() if isinstance(t, str) else t


def _least_grams(base: DataFrame, span: int, q: int) -> DataFrame:
    """(mh, own) of every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("suffix_dedup")
        cutter = SuperWords(span, q)
        for b in (x for y in batches for x in _few(y)):
            for r in cutter.runs(_bytes(t) for t in b.column(2)):
                yield pa.RecordBatch.from_arrays([pa.array(r.least), pa.array(r.own)], ["mh", "own"])

    return base.mapInArrow(run, "mh bigint, own boolean")


def _runs(base: DataFrame, span: int, q: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        memory_of("suffix_dedup")
        cutter = SuperWords(span, q)
        for b in (x for y in batches for x in _few(y)):
            for r in cutter.runs(_bytes(t) for t in b.column(2)):
                ends = r.start + r.windows + (span - 1)
                hashes = b"".join([xxh3_128_digest(r.parts[k][i:j]) for k, i, j in zip(r.part.tolist(), r.start.tolist(), ends.tolist(), strict=True)])
                k = np.frombuffer(hashes, "<i8").reshape(-1, 2)
                at = pa.array(r.text)
                cols = [b.column(0).take(at), b.column(1).take(at), *map(pa.array, (r.least, k[:, 0].copy(), k[:, 1].copy(), r.start + r.shift, r.windows.astype(np.int64), r.own))]
                yield pa.RecordBatch.from_arrays(cols, ["key", "rid", *RUN, "start", "n", "own"])

    return base.mapInArrow(run, "key binary, rid bigint, mh bigint, k1 bigint, k2 bigint, start bigint, n bigint, own boolean")


def _refined(contents: DataFrame, span: int) -> DataFrame:
    """(mh, k1, k2, spans): intervals of repeated windows of each content that occurs once; whole buckets at a time."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        valid, at, ends = np.zeros(len(data), bool), 0, []
        for r in rows:
            valid[at : at + r[4]] = True
            ends.append((at, at + r[4]))
            at += len(r[5])
        flags = repeated_windows(data, valid, span)
        got = [(*r[:3], s) for r, (a, b) in zip(rows, ends, strict=True) if r[3] == 1 and (s := [{"a": x, "b": y} for x, y in stretches(flags[a:b])])]
        cols = list(zip(*got, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], [*RUN, "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for r in (r for x in _few(b) for r in zip(*(c.to_pylist() for c in x.columns), strict=True)):
                if rows and r[:3] == rows[-1][:3]:
                    continue  # a row that repeats with its id
                if size > AT_ONCE and r[0] != rows[-1][0]:
                    yield work(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5])
        if rows:
            yield work(rows)

    dealt = contents.repartition("mh").sortWithinPartitions(*RUN)
    return dealt.mapInArrow(run, "mh bigint, k1 bigint, k2 bigint, spans array<struct<a:bigint,b:bigint>>")


def _counted(contents: DataFrame, span: int) -> DataFrame:
    """As _refined where the q-grams are as long as the span: each window is a bucket's member, known by a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in batches:
            for mh, k1, k2, _, n, content in (r for x in _few(b) for r in zip(*(c.to_pylist() for c in x.columns), strict=True)):
                w = np.frombuffer(b"".join([xxh3_128_digest(content[j : j + span]) for j in range(n)]), "<i8").reshape(-1, 2)
                cols = [pa.array(np.full(n, x)) for x in (mh, k1, k2)] + [pa.array(np.arange(n)), pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(cols, [*RUN, "at", "w1", "w2"])

    once = contents.dropDuplicates(RUN)
    windows = once.mapInArrow(run, "mh bigint, k1 bigint, k2 bigint, at bigint, w1 bigint, w2 bigint")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2")
    at = windows.join(twice, ["w1", "w2"]).groupBy(*RUN).agg(F.collect_list("at").alias("at"))
    return at.select(*RUN, F.transform("at", lambda x: F.struct(x.alias("a"), (x + 1).alias("b"))).alias("spans"))


def repeated_spans(docs: DataFrame, span: int = 400, q: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, marks): of every text (by the MD5 of its UTF-8) with bytes to remove, their intervals [lo, hi) flattened."""
    text = whole_text(text_col)
    marks = _intervals(docs.select(F.unhex(F.md5(text)).alias("key"), F.xxhash64(id_col).alias("rid"), text.alias("text")), span, q)
    each = marks.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("at"))
    return each.select("key", F.flatten(F.transform(F.array_sort("at"), lambda x: F.array(x["lo"], x["hi"]))).alias("marks"))


def _intervals(base: DataFrame, span: int, q: int) -> DataFrame:
    """(key, lo, hi): intervals of the bytes of texts (key, rid, text) that repeat; text may be binary."""
    runs = _runs(base, span, q)
    # cut twice rather than kept: first only to find the buckets with more than one run
    shared = cut(_least_grams(base, span, q).groupBy("mh").agg(F.count("*").alias("c"), F.max("own").alias("own")).where("c > 1 or own"))
    share = max(1000, (shared.agg(F.sum("c")).first()[0] or 0) // 1000)
    often = shared.where(F.col("c") > share)
    kept = cut(spread_join(runs, shared.select("mh"), ["mh"], often, ["key", "start"], "left_semi"))
    kinds = kept.groupBy(*RUN).agg(F.count("*").alias("copies"), F.min(F.struct("key", "rid", "start")).alias("at"), F.max("n").alias("n"), F.max("own").alias("own"))
    mixed = kinds.groupBy("mh").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + (span - 1)).alias("bytes"), F.max("own").alias("any_own")).where("kinds > 1 or any_own")
    many = ((F.col("kinds") > MOST) | (F.col("bytes") > MOST_BYTES)).alias("many")
    todo = cut(spread_join(kinds, mixed, ["mh"], often, ["k1"]).select(*RUN, "copies", "n", "at.*", many))

    def contents(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("key", "rid").agg(F.collect_list(F.struct(*RUN, "copies", "n", "start")).alias("runs"))
        piece = F.transform("runs", lambda r: F.struct(*[r[c].alias(c) for c in (*RUN, "copies", "n")], F.substring(F.col("text").cast("binary"), (r["start"] + 1).cast("int"), (r["n"] + (span - 1)).cast("int")).alias("content")))
        return base.join(wanted, ["key", "rid"]).select(F.inline(piece))

    whole = kinds.where("copies > 1").select(*RUN, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))).alias("spans"))
    spans = whole.unionByName(_refined(contents(todo.where("not many")), span))
    if not todo.where("many").isEmpty():
        large, deeper = contents(todo.where("many")), q + (span - q) // 2
        spans = spans.unionByName(_deeper(cut(large.dropDuplicates(RUN)), span, deeper) if deeper < span - 8 else _counted(large, span))
    hot = kinds.where(F.col("copies") > share)
    marks = spread_join(kept, spans, RUN, cut(hot.select(*RUN)), ["key", "start"]).select("key", "start", F.explode("spans").alias("s"))
    return marks.select("key", (F.col("start") + F.col("s.a")).alias("lo"), (F.col("start") + F.col("s.b") + (span - 1)).alias("hi"))


def _deeper(contents: DataFrame, span: int, q: int) -> DataFrame:
    """As _refined: the contents of large buckets, each once, as texts of their own with longer q-grams."""
    name = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in RUN])
    found = _intervals(contents.select(name.alias("key"), F.lit(0).cast("long").alias("rid"), F.col("content").alias("text")), span, q)
    spans = found.groupBy("key").agg(F.collect_set(F.struct(F.col("lo").alias("a"), (F.col("hi") - (span - 1)).alias("b"))).alias("spans"))
    once = contents.where("copies = 1").select(*RUN, name.alias("key"))
    return once.join(spans, "key").select(*RUN, "spans")


def joined_runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of intervals given as lo, hi, lo, hi, ... in ascending order of lo."""
    out: list[tuple[int, int]] = []
    for lo, hi in marks.reshape(-1, 2).tolist():
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def remove_repeats(docs: DataFrame, span: int = 400, q: int = 64, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text, in the struct column `repeats`.

    Each byte covered by a string of `span` bytes that also starts anywhere else in docs is removed."""
    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * keep_text

    @F.pandas_udf(fields)
    def cut_out(text: pd.Series, marks: pd.Series) -> pd.DataFrame:
        rows = []
        for t, m in zip(text, marks, strict=True):
            b = t.encode()
            gone = joined_runs(np.asarray(m)) if m is not None else []
            at, parts = 0, []
            for lo, hi in gone:
                parts.append(b[at:lo])
                at = hi
            left = b"".join([*parts, b[at:]]) if gone else b
            row = (len(b), len(b) - len(left), len(gone), hashlib.sha256(left).hexdigest())
            rows.append((*row, "".join(x.decode(errors="ignore") for x in (*parts, b[at:]))) if keep_text else row)
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    text = whole_text(text_col)
    marks = repeated_spans(docs, span, q, id_col, text_col).select(F.col("key").alias("__key"), F.col("marks").alias("__marks"))
    keyed = docs.withColumn("__key", F.unhex(F.md5(text)))
    return keyed.join(marks, "__key", "left").withColumn("repeats", cut_out(text, F.col("__marks"))).drop("__key", "__marks")


#: Bytes that a word with its separator has at least where passages are counted in words.
WORD = 8
_WORDS = re.compile(r"[^ \t\n\x0b\f\r]+")


def spread_words(text: Column) -> Column:
    """The words (between ASCII white space) of a text, each filled up to WORD bytes with its separator; no word is
    shortened. So n words have n * WORD bytes or more, and whatever lies between them counts as one separator."""
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+", -1), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.rpad(w, F.greatest(F.length(w), F.lit(WORD - 1)), "\x01"), F.lit(" "))), "")


def without_passages(text: str, marks: np.ndarray) -> str:
    """text without the words that lie wholly in the marked intervals of its spread words, and the spaces and tabs after."""
    words = list(_WORDS.finditer(text))
    ends = np.cumsum([0] + [len(m[0].encode()) + max(0, WORD - 1 - len(m[0])) + 1 for m in words])
    at, parts = 0, []
    for lo, hi in joined_runs(marks):
        first, stop = int(np.searchsorted(ends, lo)), int(np.searchsorted(ends, hi, side="right")) - 1
        if first < stop:
            parts.append(text[at : words[first].start()])
            at = words[stop - 1].end()
            while at < len(text) and text[at] in " \t":
                at += 1
    return "".join([*parts, text[at:]])


def remove_passages(docs: DataFrame, words: int = 50, q: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col without each passage of so many words, or of words * WORD bytes in fewer and longer ones, that
    also starts anywhere else in docs."""

    @F.pandas_udf("string")
    def cut_out(text: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series([t if m is None else without_passages(t, np.asarray(m)) for t, m in zip(text, marks, strict=True)], dtype=object)

    spread = docs.select(F.col(id_col).alias("id"), spread_words(whole_text(text_col)).alias("text"))
    marks = repeated_spans(spread, words * WORD, q, "id", "text").select(F.col("key").alias("__key"), F.col("marks").alias("__marks"))
    keyed = docs.withColumn("__key", F.unhex(F.md5(spread_words(whole_text(text_col)))))
    return keyed.join(marks, "__key", "left").withColumn(text_col, cut_out(whole_text(text_col), F.col("__marks"))).drop("__key", "__marks")
