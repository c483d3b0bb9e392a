"""SimHash near-duplicates by anchor-point covering.

Anchors. 64-bit fingerprints that differ in at most 3 bits differ in at most one bit in one of their 32-bit halves. The
anchors of a half are the words of the perfect Hamming code of length 31 (covering radius 1) times the free 32nd bit.
A half lies within 1 of exactly one anchor, its home; a half that differs from it in at most one bit lies within
covering radius plus threshold, 2, of that anchor. So each distinct fingerprint goes to its home and to every anchor
within 2 (17 a half at most), and whatever links meets at the home of either. All of this is column arithmetic.

Per anchor, members that have it as home are compared with all its members, and only a spanning forest of the links is
kept, so that dense groups give as many rows as members. An anchor with more than MOST members is dealt into blocks,
each pair of blocks being a group of its own; no task holds more than two blocks. Anchors without two members, or
without a home member, never leave the JVM. Exact copies share one fingerprint and are joined back at the end.

Defined results: null and empty texts have fingerprint zero and link like any other; rows repeated with one id share
its component; an empty table gives no rows; other columns are ignored; a null id is the smallest of no component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, memory_of, whole_text
from ..functions.components import connected_components

#: Members of an anchor from which on it is dealt into blocks of about this many.
MOST = 2048
#: Bits j of a 31-bit half for which bit k of j + 1 is set: the parity checks of the Hamming code.
CHECKS = [sum(1 << j for j in range(31) if (j + 1) >> k & 1) for k in range(5)]
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """Hashes of all shingles of a text, in order; see simhash_fingerprints. A text without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: A-Z only, and the ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - shingle + 1)
    last = [e - 1 for e in ends[min(shingle, len(words)) :]]
    return np.fromiter(map(partial(xxh64_intdigest, seed=42), (line[a:b] for a, b in zip(ends, last, strict=False))), np.uint64, n)


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned fingerprint of one text; see simhash_fingerprints."""
    h = shingle_hashes(text, shingle)
    n = len(h)
    if not n:
        return 0
    starts = np.arange(0, n, 255)
    bits = np.empty((8, 8), np.int64)  # [byte, bit in byte]
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, starts)  # eight counts of up to 255, one a byte
        bits[:, k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits.reshape(-1) * 2 > n, bitorder="little").view(np.uint64)[0])


def simhash_fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): A-Z lower-cased, words between ASCII white space, shingles of so many words (repeats count;
    fewer words are one shingle), XXH64 with seed 42; a bit is set if set in over half the hashes; no words: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("simhash")
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def anchors_of(fp: Column) -> Column:
    """Array of the anchors of a fingerprint: of each half its home, the home with the free bit turned, and the other
    code words within 2. An anchor is a long: half, free bit, code word."""
    out = []
    for half in range(2):
        v = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        u, free = v.bitwiseAND(F.lit(0x7FFFFFFF)), v.bitwiseAND(F.lit(0x80000000))
        syndrome = sum((F.bit_count(u.bitwiseAND(F.lit(c))) % 2 * (1 << k) for k, c in enumerate(CHECKS)), F.lit(0))
        name = F.struct(u.alias("u"), syndrome.cast("int").alias("s"), free.bitwiseOR(F.lit(half << 32)).alias("top"))
        out.append(name)

    def expand(x: Column) -> Column:
        bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i - 1)
        home = F.when(x["s"] == 0, x["u"]).otherwise(x["u"].bitwiseXOR(bit(F.greatest(x["s"], F.lit(1)))))
        pairs = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: i.bitwiseXOR(x["s"]) > i)
        near = F.transform(pairs, lambda i: x["u"].bitwiseXOR(bit(i)).bitwiseXOR(bit(i.bitwiseXOR(x["s"]))).bitwiseOR(x["top"]))
        own = home.bitwiseOR(x["top"])
        return F.concat(F.array(own, own.bitwiseXOR(F.lit(0x80000000))), near)

    return F.flatten(F.transform(F.array(*out), expand))


def home_anchors(fp: np.ndarray, half: int) -> np.ndarray:
    v = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
    u = v & np.uint64(0x7FFFFFFF)
    s = np.zeros(len(fp), np.uint64)
    for k, c in enumerate(CHECKS):
        s |= (np.bitwise_count(u & np.uint64(c)).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    turn = np.where(s > 0, np.uint64(1) << np.maximum(s, 1).astype(np.uint64) - np.uint64(1), np.uint64(0))
    return (v ^ turn) | np.uint64(half << 32)


def forest(members: np.ndarray, at: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smaller member) that connect what the links between home members and members connect.

    members: distinct unsigned fingerprints in ascending order; at: indices of those whose home this anchor is."""
    label = np.arange(len(members))
    near = [(k, np.bitwise_count(members[k : k + 1] ^ members) <= most_bits) for k in at]
    near = [(k, np.flatnonzero(x)) for k, x in near]
    near = [(k, x) for k, x in near if len(x) > 1]
    changed = bool(near)
    while changed:
        changed = False
        for _, x in near:
            own = label[x]
            low = own.min()
            if (own != low).any():
                label[x] = low
                changed = True
        label = label[label]
    moved = np.flatnonzero(label != np.arange(len(members)))
    return members[moved], members[label[moved]]


def fingerprint_links(fps: DataFrame, most_bits: int = 3) -> DataFrame:
    """(u, v): links that connect exactly the fingerprints that chains of at most most_bits (3 or fewer) differing bits
    connect; as many rows as members of groups at most a group. fps: distinct fp long."""
    if not 0 <= most_bits <= 3:
        raise ValueError("the anchors cover up to 3 bits")
    rep = fps.select("fp", F.posexplode(anchors_of(F.col("fp")))).select("fp", F.col("col").alias("anchor"))
    counts = rep.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MOST)
    blocks = F.ceil(F.col("n") / MOST).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    part = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda d: F.struct(F.least(d, "own").alias("i"), F.greatest(d, "own").alias("j")))
    )
    dealt = rep.join(counts.select("anchor", blocks.alias("blocks")), "anchor", "left").withColumn("own", own).select("anchor", "fp", F.explode(part).alias("p"))
    groups = dealt.groupBy("anchor", "p.i", "p.j").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("anchor", "fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            anchor = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            each = np.repeat(anchor, np.diff(ends, prepend=0))
            is_home = np.where(each >> np.uint64(32) == 0, home_anchors(flat, 0), home_anchors(flat, 1)) == each
            u, v, lo = [], [], 0
            for hi in ends:
                if is_home[lo:hi].any():
                    order = np.argsort(flat[lo:hi])
                    a, c = forest(flat[lo:hi][order], np.flatnonzero(is_home[lo:hi][order]), most_bits)
                    if len(a):
                        u.append(a)
                        v.append(c)
                lo = hi
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], ["u", "v"])

    return groups.mapInArrow(run, "u bigint, v bigint")


def simhash_components(docs: DataFrame, shingle: int = 3, most_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp long and component_id (the smallest doc_id reachable over links) of every row of docs."""
    rows = cut(simhash_fingerprints(docs, shingle, id_col, text_col))
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(fingerprint_links(fps.select("fp"), most_bits))
    keyed = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = keyed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(keyed.join(least, "root").select("fp", "component_id"), "fp")


def one_of_each(docs: DataFrame, components: Callable[[DataFrame], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component (components gives doc_id and component_id of rows with their id in __key): one
    with the smallest id, and of several with that id the one with the least text hash. A null id counts as the smallest."""
    keyed = docs.withColumn("__key", F.struct(F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("h")))
    found = cut(components(keyed).select(F.col("doc_id").alias("__key"), "component_id"))
    gone = found.where(F.col("__key") != F.col("component_id")).select("__key").distinct()
    kept = keyed.join(gone, "__key", "left_anti")
    twice = cut(found.groupBy("__key").count().where("count > 1").select("__key"))
    if not twice.isEmpty():
        once = kept.join(twice, "__key", "left_semi").dropDuplicates(["__key"])
        kept = kept.join(twice, "__key", "left_anti").unionByName(once)
    return kept.drop("__key")


def near_duplicate_documents(docs: DataFrame, shingle: int = 5, most_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component of fingerprints; see one_of_each."""
    return one_of_each(docs, lambda keyed: simhash_components(keyed, shingle, most_bits, "__key", text_col), id_col, text_col)
