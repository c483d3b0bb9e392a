"""Near copies: documents whose sets of shingles reach a Jaccard similarity, found by min-hash bands and verified.

Documents with one set are copies of each other and count once. Each set has BANDS independent fingerprints of ROWS least
hashes; two sets at the threshold of 0.8 share none of them with a probability of 3 in a million, more alike ones with
less. Sets that share a fingerprint are candidates, and links are only what the sets themselves verify.

A set is first compared with the one that is the least of most of its bands, so that a dense group is linked by as many
pairs as it has members. Only bands whose members are not yet in one component then compare their members, those of
different components, within tasks that hold the sets and return a spanning forest; equal bands once. Bands of more than
BLOCK shingles are dealt into blocks, each pair of blocks a group of its own.

Defined results: null and empty texts have the empty set and are copies of each other; a set is named by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, memory_of, whole_text
from ..functions.components import connected_components
from .simhash import one_of_each, shingle_hashes, simhash_components

BANDS, ROWS = 24, 4
#: Shingles of a band from which on it is dealt into blocks of about as many.
BLOCK = 300_000
_TURN = np.random.default_rng(20).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """BANDS fingerprints of a set of hashes."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[k : k + 4096, None] * _TURN[0] + _TURN[1]).min(axis=0))
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for x in least.reshape(BANDS, ROWS).T:
        key = (key ^ x) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def linked(sets: list[np.ndarray], root: np.ndarray, block: np.ndarray, share: float) -> list[tuple[int, int]]:
    """Pairs of indices that connect what the sets that reach the similarity connect, beyond what roots connect already;
    if there are two blocks, of pairs between them."""
    _, label = np.unique(root, return_inverse=True)
    size = np.array([len(x) for x in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    mark, out, two = np.zeros(len(code) + 1, bool), [], len(np.unique(block)) > 1
    for c in range(len(sets)):
        wanted = (label != label[c]) & (size >= share * size[c] - 1e-9) & (share * size <= size[c] + 1e-9)
        wanted[:c] = False
        if two:
            wanted &= block != block[c]
        at = np.flatnonzero(wanted)
        if not len(at):
            continue
        own = code[ends[c] - size[c] : ends[c]]
        mark[own] = True
        both = np.array([np.count_nonzero(mark[code[ends[k] - size[k] : ends[k]]]) for k in at])
        mark[own] = False
        for k in at[both >= share * (size[at] + size[c] - both) - 1e-9].tolist():
            if label[k] != label[c]:
                out.append((c, k))
                label[label == label[k]] = label[c]
    return out


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(key, node, n, bands) of each text; texts: key, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("near_copies")
        from xxhash import xxh3_64_intdigest

        for b in batches:
            node, n, bands = np.empty(b.num_rows, np.uint64), np.empty(b.num_rows, np.int64), np.empty((b.num_rows, BANDS), np.uint64)
            for k, t in enumerate(b.column(1)):
                x = np.unique(shingle_hashes(t.as_py(), shingle))
                node[k], n[k], bands[k] = xxh3_64_intdigest(x.tobytes()), len(x), bands_of(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node.view(np.int64)), pa.array(n), lists], ["key", "node", "n", "bands"])

    return texts.mapInArrow(run, f"key {texts.schema['key'].dataType.simpleString()}, node bigint, n bigint, bands array<bigint>")


def _shingles(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, words): the set of each text; texts: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("near_copies")
        for b in (x.slice(k, 256) for x in batches for k in range(0, x.num_rows, 256)):
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in b.column(1)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)))], ["node", "words"])

    return texts.mapInArrow(run, "node bigint, words array<bigint>")


def _compared(groups: DataFrame, share: float) -> DataFrame:
    """(u, v): links of each group's members (node, root, block, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(k, 1) for x in batches for k in range(x.num_rows)):
            members = b.column(0).flatten()
            node, root, block = (members.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root", "block"))
            lists = members.field("words")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            sets = np.split(lists.flatten().to_numpy(zero_copy_only=False), ends[:-1])
            found = np.array(linked(sets, root, block, share), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(node[found[:, k]]) for k in (0, 1)], ["u", "v"])

    return groups.mapInArrow(run, "u bigint, v bigint")


def near_copy_components(docs: DataFrame, share: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and component_id (the smallest doc_id reachable over links) of every row of docs."""
    texts = docs.select(F.col(id_col).alias("key"), whole_text(text_col).alias("text"))
    rows = cut(_sets(texts, shingle))
    nodes = rows.groupBy("node").agg(F.min("key").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("members")).where("members > 1").select("band", "least")
    met = cut(banded.join(least, "band"))

    # the text of one row for each set that is compared
    wanted = met.select("node").distinct().join(nodes.select("node", "first"), "node")
    one = texts.join(wanted, texts["key"].eqNullSafe(F.col("first"))).select("node", "text")
    words = cut(_shingles(one, shingle).dropDuplicates(["node"]))

    named = met.where("node <> least").groupBy("node", "least").agg(F.count("*").alias("c")).groupBy("node").agg(F.max_by("least", F.struct("c", "least")).alias("least"))
    with_words = named.join(words, "node").join(words.select(F.col("node").alias("least"), F.col("words").alias("others")), "least")
    both = F.size(F.array_intersect("words", "others"))
    links = cut(with_words.where(both >= F.lit(share) * (F.size("words") + F.size("others") - both) - F.lit(1e-9)).select(F.col("node").alias("u"), F.col("least").alias("v")))

    rooted = met.join(connected_components(links), "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("root"))
    at = F.xxhash64("node")
    open_ = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("n").alias("n"), F.count("*").alias("c"), F.sum(at.cast("decimal(38,0)")).alias("who")).where("lo <> hi")
    open_ = cut(open_.groupBy("who", "c").agg(F.min("band").alias("band"), F.max(F.ceil(F.col("n") / BLOCK).cast("int")).alias("blocks")).select("band", "blocks"))
    own = F.pmod(at, F.greatest("blocks", F.lit(1))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1), lambda d: F.struct(F.least(d, own).alias("i"), F.greatest(d, own).alias("j")))
    dealt = rooted.join(open_, "band").select("band", "node", "root", own.alias("block"), F.explode(parts).alias("p"))
    several = dealt.groupBy("band", "p").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band", "p")
    groups = dealt.join(several, ["band", "p"]).join(words, "node").groupBy("band", "p").agg(F.collect_list(F.struct("node", "root", "block", "words")).alias("members")).select("members")
    links = cut(links.unionByName(_compared(groups, share)))

    keyed = nodes.select("node", "first").join(connected_components(links), "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = keyed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(keyed.join(smallest, "root").select("node", "component_id"), "node").select(F.col("key").alias("doc_id"), "component_id")


def drop_near_copies(docs: DataFrame, share: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, as near_duplicate_documents."""
    return one_of_each(docs, lambda keyed: near_copy_components(keyed, share, shingle, "__key", text_col), id_col, text_col)


def linked_components(docs: DataFrame, share: float = 0.8, shingle: int = 5, most_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and component_id of every row of docs, over the links of SimHash fingerprints (of three-word shingles, found by
    anchors) and those of sets together: a chain may have links of both kinds."""
    by_bits = simhash_components(docs, most_bits=most_bits, id_col=id_col, text_col=text_col).select("doc_id", "component_id")
    by_sets = cut(near_copy_components(docs, share, shingle, id_col, text_col))
    links = by_bits.unionByName(by_sets).where("doc_id <> component_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    roots = connected_components(links).withColumnRenamed("node", "doc_id")
    return by_sets.select("doc_id").join(roots, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def drop_linked_copies(docs: DataFrame, share: float = 0.8, shingle: int = 5, most_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each of linked_components."""
    return one_of_each(docs, lambda keyed: linked_components(keyed, share, shingle, most_bits, "__key", text_col), id_col, text_col)
