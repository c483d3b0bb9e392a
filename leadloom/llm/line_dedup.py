"""Near-duplicate lines by an exact set-similarity join; of matching lines the later ones go.

A line's set is its distinct lower-cased words (between ASCII white space, as 47-bit hashes). A line goes if an earlier
line (by document id, then text hash, then place) has a Jaccard similarity of at least the threshold, so what goes
doesn't depend on the order of work. Lines with equal sets are found by a 128-bit hash of the set. For the others, sets
keep their words in order of rarity: counts over all lines rank the most frequent words, all other words come before
these in hash order. A set posts its prefix, the shortest that a match must share a word with, to the buckets of its
words. Within a bucket, postings of a word form runs of one size and place; the length and positional filters choose
the pairs of runs that are compared at all, and a parity sketch (a lower bound of the difference) chooses the pairs of
sets. Sketches have 64 to 512 bits by the size of the larger set, as a sketch tells nothing once the difference that is
allowed comes near half its bits. What passes is verified on the sets: the words of both lines go to one place, by the
earlier line and, if many name it, a salt.

Groups of n alike lines have n * n matches, of which one a line is needed. So a line first names only NAMES of those that
pass and are earlier, over all its words those whose sketches are the nearest. The nearest is verified, then the others
of lines for which it fails; lines for which all fail, and which had more, then name them all. What is earlier is told by a coarse order of the ids that postings carry; the exact order
decides after verification. What a word has beyond NAMES is found again from its postings, which are kept for that.

A word with more than MOST postings is dealt into blocks, each pair of blocks being a group of its own, so no task holds
more than two blocks; large buckets are dealt into parts by word. The second round opens, of each group, the sets that
had others in it; groups without such sets don't take part. The number of buckets follows the size of the texts.

Texts are split into words for their counts, for the hashes of lines (where the words of prefixes are counted, too), for
postings and, where they hold lines that have candidates, for verification. Postings are more bytes than texts, so only
those are kept for the second round whose word has a set with more than NAMES candidates. Counts, lines, postings and candidates travel packed by bucket. A task posts a repeated set once,
with the least order of its occurrences; again only if an earlier one follows after it has been packed.

Defined results: null text counts as empty; lines without words (blank ones) never match and stay; rows that repeat with
one id and one text are alike, line by line; a null id is the earliest; an empty table gives no rows; other columns
pass through. A text that loses lines is joined again by single line feeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, memory_of, whole_text

#: Words whose counts rank them; postings or counts, pairs, and texts that a task works on at a time.
RANKED, AT_ONCE, PAIRS, FEW = 50_000, 200_000, 100_000, 1024
#: Bytes of text of a bucket (there are LEAST_BUCKETS at least), and bytes that are split into words at a time.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS, SLAB = 2 << 20, 64, 1 << 18, 1 << 18
#: Texts, of those that verification or removal asks for, up to which their keys and places are broadcast.
BROADCAST = 500_000
#: Lines that are verified against one line in one place, and earlier candidates that a set names.
SALT, NAMES = 1024, 16
#: Postings of a word from which on they are dealt into blocks of about as many, and of a run that are compared at a time.
MOST, RUN = 32_768, 256
#: 64-bit lanes of the sketches by class, and the sizes from which on a set is of the next class.
LANES, CLASSES = (1, 2, 4, 8), (72, 160, 330)


def _posting(lanes: int) -> np.dtype:
    """A word is named by its bucket and 16 more bits (words that share them only make more candidates)."""
    return np.dtype([("word", "<u2"), ("size", "<u2"), ("place", "u1"), ("order", "<u2"), ("set", "<u8"), ("sketch", "<u8", (lanes,))])


POSTINGS = tuple(map(_posting, LANES))
POSTING = POSTINGS[0]
COUNT, POSTED = np.dtype([("word", "<u8"), ("n", "<u4")]), np.dtype([("word", "<u2"), ("n", "<u4")])
LINE = np.dtype([("k1", "<u8"), ("k2", "<u8"), ("rank", "<i8"), ("h", "<i8"), ("place", "<i4")])
#: What hashes are mixed by, and bytes of a word from which on it is hashed apart.
MIX, LONG = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), 64
#: Of eight bytes, the first so many.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
NULL_RANK = -(1 << 63)
_LOW48, _FREQUENT = np.uint64((1 << 48) - 1), np.uint64(1 << 47)


def _mixed(x: np.ndarray, by: int = MIX[0]) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def _hashes(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """47-bit hashes of the words part[a:b], of eight bytes at a time."""
    padded = np.append(part, np.zeros(8, np.uint8))
    eight = np.ndarray(len(part) + 1, "<u8", padded, strides=(1,))
    n = b - a
    h = _mixed(eight[a] & _FIRST[np.minimum(n, 8)] ^ n.astype(np.uint64) * np.uint64(MIX[1]))
    at, more = 8, np.flatnonzero(n > 8)
    while len(more) and at < LONG:
        h[more] = _mixed(h[more] ^ eight[a[more] + at] & _FIRST[np.minimum(n[more] - at, 8)])
        at += 8
        more = more[n[more] > at]
    if len(more):
        from xxhash import xxh3_64_intdigest

        h[more] ^= np.fromiter((xxh3_64_intdigest(part[i + LONG : j].tobytes()) for i, j in zip(a[more].tolist(), b[more].tolist(), strict=True)), np.uint64, len(more))
    return _mixed(h, MIX[1]) >> np.uint64(17)


class Words(NamedTuple):
    """Some neighbouring lines of texts: text and place of each line, how many words it has, and their 47-bit hashes."""

    text: np.ndarray
    place: np.ndarray
    n: np.ndarray
    word: np.ndarray


def words_of(texts: pa.Array) -> Iterator[Words]:
    """The words of all lines, about SLAB bytes at a time, a line always whole."""
    for k in range(0, len(texts), FEW):
        for x in _words_of_few(texts.slice(k, FEW)):
            yield x._replace(text=x.text + k)


def _words_of_few(texts: pa.Array) -> Iterator[Words]:
    low = pc.utf8_lower(texts).cast(pa.large_string())
    ends = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1]
    data = np.frombuffer(low.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    feeds = np.flatnonzero(data == 10)
    first, stop = np.sort(np.concatenate([ends[:-1], feeds + 1])), np.sort(np.concatenate([ends[1:], feeds]))
    per_text = np.diff(np.searchsorted(feeds, ends)) + 1
    text = np.repeat(np.arange(len(low)), per_text)
    place = np.arange(len(first)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at = 0
    while at < len(first):
        to = min(max(at + 1, int(np.searchsorted(stop, first[at] + SLAB, "right"))), at + 0xFFFF)
        lo = first[at]
        part = data[lo : stop[to - 1]]
        solid = np.zeros(len(part) + 2, bool)
        solid[1:-1] = (part - np.uint8(9) > 4) & (part != 32)  # neither of 9 to 13 nor a space
        edges = np.flatnonzero(solid[1:] != solid[:-1])  # where words begin and end, in turn
        joints = first[at:to] - lo  # where texts meet without white space
        joints = joints[(joints > 0) & (joints < len(part))]
        joints = joints[solid[joints] & solid[joints + 1]]
        if len(joints):
            edges = np.sort(np.concatenate([edges, joints, joints]))
        a, b = edges[::2], edges[1::2]
        word = _hashes(part, a, b)
        n = np.diff(np.searchsorted(a, np.append(first[at:to] - lo, len(part) + 1)))
        yield Words(text[at:to], place[at:to], n, word)
        at = to


class Ranks:
    """The order of words: those with a rank by it, after all others by hash. Ranked words stand in two tables by bits
    of their hash; the few that find both places taken have no rank. Tasks get the words and build the tables."""

    BITS = 18

    def __init__(self, words: np.ndarray):
        """words: hashes, the most frequent first."""
        self.words = words
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []

    def __getstate__(self) -> dict:
        return {"words": self.words, "tables": []}

    def _at(self, words: np.ndarray, k: int) -> np.ndarray:
        return (words >> np.uint64(k * self.BITS) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def _build(self) -> None:
        left, rank = self.words, np.uint64(len(self.words)) - np.arange(len(self.words), dtype=np.uint64)
        for k in range(2):
            word, place = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.uint64)
            at = self._at(left, k)
            _, kept = np.unique(at, return_index=True)  # the most frequent of those for one place
            word[at[kept]], place[at[kept]] = left[kept], rank[kept]
            self.tables.append((word, place))
            more = np.ones(len(left), bool)
            more[kept] = False
            left, rank = left[more], rank[more]

    def codes(self, words: np.ndarray) -> np.ndarray:
        """48 bits that name a word and order it."""
        if not self.tables:
            self._build()
        (word, place), (other, its_place) = self.tables
        at = self._at(words, 0)
        known = word[at] == words
        out = np.where(known, _FREQUENT | place[at], words)
        left = np.flatnonzero(~known)
        at = self._at(words[left], 1)
        known = np.flatnonzero(other[at] == words[left])
        out[left[known]] = _FREQUENT | its_place[at[known]]
        return out


class Lines(NamedTuple):
    """Lines with words: text, place in the text, sizes and ends of their sets, the sets' hashes, and the words, rarest
    first within each set."""

    text: np.ndarray
    place: np.ndarray
    size: np.ndarray
    end: np.ndarray
    key: np.ndarray
    words: np.ndarray


def lines_of(texts: pa.Array, ranks: Ranks) -> Iterator[Lines]:
    for x in words_of(texts):
        if not len(x.word):
            continue
        both = np.repeat(np.arange(len(x.n), dtype=np.uint64), x.n) << np.uint64(48) | ranks.codes(x.word)
        both.sort()
        both = both[np.append(True, both[1:] != both[:-1])]
        words, line = both & _LOW48, (both >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        end = np.append(first[1:], len(line))
        one = _mixed(_mixed(words), MIX[1])
        key = np.stack([np.add.reduceat(x, first) for x in (one, _mixed(one))])
        own = line[first]
        yield Lines(x.text[own], x.place[own], end - first, end, key, words)


def _packed(bucket: np.ndarray, rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """(bucket, its rows as bytes)."""
    order = np.argsort((bucket & 0xFFFF).astype(np.uint16), kind="stable")  # 16 bits at a time are sorted by radix
    if len(bucket) and bucket.max() > 0xFFFF:
        order = order[np.argsort((bucket >> 16)[order].astype(np.uint16), kind="stable")]
    bucket, rows = bucket[order], rows[order]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(rows)]), len(rows))
    ends = pa.array((cuts * rows.dtype.itemsize).astype(np.int32))
    raw = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, ends.buffers()[1], pa.py_buffer(rows.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), raw], names)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(key, values) of rows (key, value) that come sorted by key."""
    last, own = None, []
    for b in batches:
        for key, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if key != last and own:
                yield last, own
                own = []
            last = key
            own.append(raw.as_py())
    if own:
        yield last, own


def _added(counts: list[np.ndarray]) -> np.ndarray:
    """Sums of n by word."""
    x = np.concatenate(counts)
    x = x[np.argsort(x["word"])]
    first = np.flatnonzero(np.append(True, x["word"][1:] != x["word"][:-1])[: len(x)])
    out = x[first]
    if len(x):
        out["n"] = np.minimum(np.add.reduceat(x["n"].astype(np.int64), first), 0xFFFFFFFF)
    return out


def frequent_words(texts: DataFrame, buckets: int = 1024) -> Ranks:
    """The order of words by the counts of all words of all texts; the RANKED most frequent ones have ranks."""
    return counted_words(texts, buckets)[0]


def counted_words(texts: DataFrame, buckets: int) -> tuple[Ranks, int]:
    """As frequent_words, with the bytes that all texts have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("line_dedup")
        held: list[np.ndarray] = []
        size = n_bytes = 0

        def sent() -> pa.RecordBatch:
            x = _added(held)
            held.clear()
            return _packed((x["word"] % np.uint64(buckets)).astype(np.int64), x, ["bucket", "counts"])

        for b in batches:
            n_bytes += pc.sum(pc.binary_length(b.column(0))).as_py() or 0
            for w in words_of(b.column(0)):
                word = np.sort(w.word)
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
                x = np.empty(len(first), COUNT)
                x["word"], x["n"] = word[first], np.diff(np.append(first, len(word)))
                held.append(x)
                size += len(x)
                if size > 5 * AT_ONCE:
                    yield sent()
                    size = 0
        if held:
            yield sent()
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([str(n_bytes).encode()])], ["bucket", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, own in _groups(batches):
            if bucket < 0:
                yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([sum(map(int, own))])], ["word", "n"])
                continue
            held: list[np.ndarray] = []
            for raw in own:
                held.append(np.frombuffer(raw, COUNT))
            x = _added(held)
            x = x[np.lexsort((x["word"], -x["n"].astype(np.int64)))[:RANKED]]
            yield pa.RecordBatch.from_arrays([pa.array(x["word"].astype(np.int64)), pa.array(x["n"].astype(np.int64))], ["word", "n"])

    counts = texts.select("text").mapInArrow(count, "bucket int, counts binary").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, "word bigint, n bigint")
    n_bytes, *top = counts.orderBy(F.col("word") >= 0, F.desc("n"), "word").limit(RANKED + 1).collect() or [{"n": 0}]
    return Ranks(np.array([r["word"] for r in top], np.int64).astype(np.uint64)), n_bytes["n"]


def overlap_needed(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Least number of shared words with which sets of these sizes reach a Jaccard similarity."""
    return np.ceil(share / (1 + share) * (a + b) - 1e-9)


def _stretched(n: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, k): each index i n[i] times, with k from 0 on, at most about `most` of them at a time."""
    upto = np.cumsum(n)
    at = 0
    while at < len(n):
        done = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, done + most, "right")))
        i = np.repeat(np.arange(at, to), n[at:to])
        yield i, np.arange(len(i)) - (np.repeat(upto[at:to] - n[at:to], n[at:to]) - done)
        at = to


def _passing(p: np.ndarray, share: float, blocks: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, differ): indices of postings, sorted by word, size and place, that pass the filters, and how far sketches
    differ, size[a] <= size[b]; with more than one block, of different blocks only. Of postings of a class above the
    first, only pairs whose larger set is of that class, as the others meet in the class below."""
    low = (0, *CLASSES)[LANES.index(p["sketch"].shape[1])]
    key = p["word"].astype(np.int64) << 24 | p["size"].astype(np.int64) << 8 | p["place"]
    new = np.append(True, key[1:] != key[:-1])[: len(p)]
    first = np.flatnonzero(new)
    long = np.diff(np.append(first, len(p)))
    if len(long) and long.max() > RUN:  # in parts
        first = np.concatenate([np.arange(a, a + n, RUN) for a, n in zip(first.tolist(), long.tolist(), strict=True)])
    n = np.diff(np.append(first, len(p)))
    key = key[first]
    size, place = (key >> 8) & 0xFFFF, key & 0xFF
    widest = np.where(size == 0xFFFF, 0xFFFF, np.minimum(np.floor(size / share + 1e-9), 0xFFFF)).astype(np.int64)
    last = np.searchsorted(key, (key >> 24) << 24 | widest << 8 | 0xFF, "right")
    sketch, set_ = np.ascontiguousarray(p["sketch"]), np.ascontiguousarray(p["set"])
    block = set_ % np.uint64(blocks)
    for i, k in _stretched(last - np.arange(len(first)), PAIRS):
        j = i + k
        needed = overlap_needed(size[i], size[j], share)
        least = np.minimum(size[i] - place[i], size[j] - place[j])
        fine = (size[j] >= low) & ((least >= needed) | (place[i] == 0xFF) | (place[j] == 0xFF) | (size[j] == 0xFFFF))
        i, j = i[fine], j[fine]
        most = np.where(size[j] == 0xFFFF, 1 << 20, size[i] + size[j] - 2 * needed[fine]).astype(np.int64)
        for pair, k in _stretched(n[i] * n[j], PAIRS):
            across = n[j[pair]]
            a, b = first[i[pair]] + k // across, first[j[pair]] + k % across
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64) if sketch.shape[1] > 1 else np.bitwise_count(sketch[a, 0] ^ sketch[b, 0]).astype(np.int64)
            fine = (differ <= most[pair]) & ((i[pair] != j[pair]) | (a < b))
            a, b, differ = a[fine], b[fine], differ[fine]
            fine = set_[a] != set_[b]
            if blocks > 1:
                fine &= block[a] != block[b]
            yield a[fine], b[fine], differ[fine]


def _ordered(p: np.ndarray) -> np.ndarray:
    return p[np.argsort(p["word"].astype(np.int64) << 24 | p["size"].astype(np.int64) << 8 | p["place"])]


def open_pairs(p: np.ndarray, share: float, still: np.ndarray, blocks: int = 1) -> Iterator[np.ndarray]:
    """Some at a time, all pairs of sets that pass the filters, the later one among `still` (sorted set hashes)."""
    p = _ordered(p)
    wanted = still[np.minimum(np.searchsorted(still, p["set"]), len(still) - 1)] == p["set"]
    out, n = [], 0
    for a, b, _ in _passing(p, share, blocks):
        asked = wanted[a] & (p["order"][b] <= p["order"][a]) | wanted[b] & (p["order"][a] <= p["order"][b])
        out.append(np.stack([p["set"][a[asked]], p["set"][b[asked]]], axis=1))
        n += len(out[-1])
        if n > AT_ONCE:
            yield np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
            out, n = [], 0
    if n:
        yield np.unique(np.sort(np.concatenate(out), axis=1), axis=0)


EACH = np.dtype([("own", "<u8"), ("with", "<u8"), ("far", "<i8"), ("g", "<i8"), ("word", "<u2"), ("more", "?")])


def _first_of_each(key: np.ndarray, n: int) -> np.ndarray:
    """Indices of the first n rows of each key; rows come sorted by it."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
    return np.flatnonzero(place < n)


def nearest_earlier(p: np.ndarray, share: float, blocks: int = 1, names: int = NAMES) -> np.ndarray:
    """For each posting that some earlier ones pass the filters with, the nearest of these (far: by how much sketches
    differ, then by order), and whether there are more of them."""
    p = _ordered(p)
    order = p["order"].astype(np.int64)
    met = np.zeros(len(p), np.int64)
    best: list[np.ndarray] = []  # own index, far, other index
    held = 0

    def pruned() -> np.ndarray:
        x = np.concatenate(best, axis=1) if best else np.zeros((3, 0), np.int64)
        x = x[:, np.lexsort((x[2], x[1], x[0]))]
        return x[:, _first_of_each(x[0], names)]

    for a, b, differ in _passing(p, share, blocks):
        for one, other in ((a, b), (b, a)):
            earlier = order[other] <= order[one]
            one, other, far = one[earlier], other[earlier], differ[earlier]
            np.add.at(met, one, 1)
            best.append(np.stack([one, far << 16 | order[other], other]))
            held += len(one)
        if held > AT_ONCE:
            best = [pruned()]
            held = best[0].shape[1]
    own, far, other = pruned()
    rows = np.zeros(len(own), EACH)
    rows["own"], rows["far"], rows["with"], rows["word"], rows["more"] = p["set"][own], far, p["set"][other], p["word"][own], met[own] > names
    return rows


def nearest_of_sets(rows: np.ndarray, names: int = NAMES) -> tuple[np.ndarray, np.ndarray]:
    """(named, more): EACH rows of different candidates, the nearest of each set first, at most so many of a set, and for
    each of these rows whether its set has candidates beyond them."""
    rows = rows[np.lexsort((rows["far"], rows["with"], rows["own"]))]
    new = np.append(True, (rows["own"][1:] != rows["own"][:-1]) | (rows["with"][1:] != rows["with"][:-1]))[: len(rows)]
    first = np.flatnonzero(np.append(True, rows["own"][1:] != rows["own"][:-1])[: len(rows)])
    if not len(rows):
        return rows, np.zeros(0, bool)
    n = np.add.reduceat(new.astype(np.int64), first)
    more = np.repeat(np.maximum.reduceat(rows["more"], first) | (n > names), n)
    rows = rows[new]
    order = np.lexsort((rows["with"], rows["far"], rows["own"]))
    named = rows[order]
    kept = _first_of_each(named["own"], names)
    return named[kept], more[order][kept]


def matching_postings(p: np.ndarray, share: float, blocks: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, more): each set among postings that has earlier candidates with the nearest, and whether it has others."""
    rows, more = nearest_of_sets(nearest_earlier(p, share, blocks, 1), 1)
    return np.stack([rows["own"], rows["with"]], axis=1), more


def class_of(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(CLASSES, size, "right")


def _lanes(words: np.ndarray, first: np.ndarray, lanes: int) -> np.ndarray:
    """Parity sketches of the sets that start at first: bits by six bits of a word's mixed code, lanes by others."""
    mixed = _mixed(words, MIX[1])
    bit, lane = np.uint64(1) << (mixed >> np.uint64(58)), mixed >> np.uint64(48) & np.uint64(lanes - 1)
    if lanes == 1:
        return np.bitwise_xor.reduceat(bit, first)[:, None]
    return np.stack([np.bitwise_xor.reduceat(np.where(lane == np.uint64(k), bit, np.uint64(0)), first) for k in range(lanes)], axis=1)


def _usable(x: Lines, share: float) -> np.ndarray:
    """A set of n words matches a set other than itself only from n of four on, at a threshold of 0.8."""
    return np.flatnonzero(np.floor(x.size / share + 1e-9) > x.size)


def _of_class(x: Lines, use: np.ndarray, share: float) -> Iterator[tuple[int, np.ndarray]]:
    smallest, largest = class_of(x.size[use]), class_of(np.floor(x.size[use] / share + 1e-9))
    for c in range(len(LANES)):
        own = use[(smallest <= c) & (largest >= c)]
        if len(own):
            yield c, own


def _prefixes(x: Lines, own: np.ndarray, share: float, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(prefix lengths, places, buckets, 16 bits) of the words in the prefixes of some sets."""
    n = x.size[own]
    prefix = n - np.ceil(share * n - 1e-9).astype(np.int64) + 1
    ends = np.cumsum(prefix)
    place = np.arange(ends[-1]) - np.repeat(ends - prefix, prefix)
    word = _mixed(x.words[np.repeat(x.end[own] - n, prefix) + place])
    return prefix, place, (word % np.uint64(buckets)).astype(np.int64), (word >> np.uint64(48)).astype(np.uint16)


def _postings(texts: DataFrame, ranks: Ranks, share: float, buckets: int = LEAST_BUCKETS, how: Dealing | None = None) -> DataFrame:
    """(bucket, postings): the packed postings of texts (text, order from 0 to 1); bucket: of the words, then the class.
    how: they are dealt as by _dealt, in the same task."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("line_dedup")
        least: dict[int, int] = {}  # of each set's occurrences so far
        unpacked: set[int] = set()
        held: list[list] = [[] for _ in LANES]
        size = 0

        def fresh(key: int, order: int) -> bool:
            earlier = order < least.get(key, 1 << 16)
            if earlier:
                least[key] = order
            if not earlier or key in unpacked:
                return False
            unpacked.add(key)
            return True

        def packed() -> Iterator[pa.RecordBatch]:
            for own in held:
                if own:
                    p, bucket = (np.concatenate(x) for x in zip(*own, strict=True))
                    sets, at = np.unique(p["set"], return_inverse=True)
                    p["order"] = np.fromiter((least[k] for k in sets.tolist()), np.uint16, len(sets))[at]
                    yield _packed(bucket, p, ["bucket", "postings"])
                    own.clear()
            unpacked.clear()

        for b in batches:
            orders = (np.nan_to_num(b.column(1).to_numpy(zero_copy_only=False)) * 0xFFFE).astype(np.uint16)
            for x in lines_of(b.column(0), ranks):
                use = _usable(x, share)
                use = use[np.fromiter(map(fresh, x.key[0][use].tolist(), orders[x.text[use]].tolist()), bool, len(use))]
                for c, own in _of_class(x, use, share):
                    prefix, place, bucket, word = _prefixes(x, own, share, buckets)
                    bucket = bucket * len(LANES) + c
                    line = np.repeat(np.arange(len(own)), prefix)
                    n = x.size[own]
                    starts = np.cumsum(n) - n
                    words = x.words[np.arange(n.sum()) + np.repeat(x.end[own] - n - starts, n)]
                    p = np.empty(len(word), POSTINGS[c])
                    p["word"], p["set"], p["size"], p["place"] = word, x.key[0][own][line], np.minimum(n, 0xFFFF)[line], np.minimum(place, 0xFF)
                    p["sketch"] = _lanes(words, starts, LANES[c])[line]
                    held[c].append((p, bucket))
                    size += len(p)
                if size >= AT_ONCE:
                    yield from packed()
                    size = 0
        yield from packed()

    def post_and_deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (x for b in post(batches) for x in _deal(b, how))

    rows = texts.select("text", "order")
    return rows.mapInArrow(post, "bucket int, postings binary") if how is None else rows.mapInArrow(post_and_deal, "g bigint, postings binary")


def word_of(bucket: np.ndarray, word: np.ndarray) -> np.ndarray:
    return bucket << 16 | word


class Dealing(NamedTuple):
    """How postings are dealt: the parts of buckets that hold many words, and the blocks of words with many postings."""

    parts: dict[int, int]
    blocks: dict[int, dict[int, int]]


def dtype_of(bucket: int) -> np.dtype:
    return POSTINGS[bucket % len(LANES)]


def _counted(key: np.ndarray) -> pa.RecordBatch:
    """(bucket, counts): how often each word_of occurs, packed by bucket."""
    key, n = np.unique(key, return_counts=True)
    x = np.empty(len(key), POSTED)
    x["word"], x["n"] = key & 0xFFFF, n
    return _packed(key >> 16, x, ["bucket", "counts"])


def _many(counts: list[bytes], most: int) -> tuple[int, np.ndarray]:
    """How many postings a bucket has, and the words with more than half of `most`."""
    x = _added([np.frombuffer(raw, POSTED) for raw in counts])
    return int(x["n"].sum()), x[x["n"] > most // 2]


def dealing(postings: DataFrame) -> Dealing:
    """How to deal postings that are there; later_lines counts them along with the lines before they are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield _counted(word_of(bucket, np.frombuffer(raw.as_py(), dtype_of(bucket))["word"].astype(np.int64)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, own in _groups(batches):
            total, hot = _many(own, MOST)
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * (len(hot) + 1), pa.int64()), pa.array([-1, *hot["word"].tolist()]), pa.array([total, *hot["n"].tolist()])], ["bucket", "word", "n"])

    counts = postings.mapInArrow(count, "bucket int, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealing_by(counts.mapInArrow(add, "bucket bigint, word bigint, n bigint"))


def dealing_by(counts: DataFrame) -> Dealing:
    """counts: (bucket, word, n) of words with many postings, and with word -1 of buckets. What comes to the driver are
    buckets with more than MOST postings, and their words with more than half as many."""
    parts: dict[int, int] = {}
    blocks: dict[int, dict[int, int]] = {}
    for r in counts.where(F.col("n") > F.when(F.col("word") < 0, MOST).otherwise(MOST // 2)).collect():
        if r["word"] < 0:
            parts[r["bucket"]] = min(1 << 15, -(-r["n"] // AT_ONCE))
        else:
            blocks.setdefault(r["bucket"], {})[r["word"]] = min(4096, max(2, -(-r["n"] // MOST)))
    return Dealing(parts, blocks)


def _deal(b: pa.RecordBatch, how: Dealing) -> Iterator[pa.RecordBatch]:
    """(g, postings) of a batch (bucket, postings)."""

    def rows(g: list[int], raw: pa.Array | list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), raw if isinstance(raw, pa.Array) else pa.array(raw, pa.binary())], ["g", "postings"])

    buckets = b.column(0).to_pylist()
    plain = np.fromiter((how.parts.get(x, 1) == 1 and x not in how.blocks for x in buckets), bool, len(buckets))
    yield rows([group_of(x, 65536) for x, fine in zip(buckets, plain, strict=True) if fine], b.column(1) if plain.all() else b.column(1).take(pa.array(np.flatnonzero(plain))))
    for at in np.flatnonzero(~plain).tolist():
        bucket = buckets[at]
        parts, blocks = how.parts.get(bucket, 1), how.blocks.get(bucket, {})
        p = np.frombuffer(b.column(1)[at].as_py(), dtype_of(bucket))
        hot = np.isin(p["word"], np.fromiter(blocks, np.uint16, len(blocks)))
        usual = p[~hot]
        for k in range(parts):
            own = usual[usual["word"] % parts == k]
            if len(own):
                yield rows([group_of(bucket, 65536 + k)], [own.tobytes()])
        p = p[hot]
        for w in np.unique(p["word"]).tolist():
            own = p[p["word"] == w]
            n = blocks[w]
            block = own["set"] % np.uint64(n)
            for k in np.unique(block).tolist():
                one = own[block == k].tobytes()
                yield rows([group_of(bucket, w, min(k, d), max(k, d)) for d in range(n)], [one] * n)


def _dealt(postings: DataFrame, how: Dealing) -> DataFrame:
    """(g, postings): a group g holds a part of a bucket, or of a word with many postings two blocks (or one, with
    itself). g: bucket, word (or 65536 + part), block, block."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (x for b in batches for x in _deal(b, how))

    return postings.mapInArrow(deal, "g bigint, postings binary")


def group_of(bucket: int, word: int, i: int = 0, j: int = 0) -> int:
    return ((bucket << 17 | word) << 12 | i) << 12 | j


def bucket_of(g: int) -> int:
    return g >> 41


def blocks_of(g: int, how: Dealing) -> int:
    """The blocks of a group's word if it holds two of them, else 1."""
    i, j, word = g >> 12 & 0xFFF, g & 0xFFF, g >> 24 & 0x1FFFF
    return how.blocks[bucket_of(g)][word] if i != j else 1


def _matched(dealt: DataFrame, how: Dealing, share: float, buckets: int) -> DataFrame:
    """(bucket, g, rows): with a bucket, EACH rows of the sets that have earlier candidates; with a group g, its postings
    of the words under which some set has more of them than it names."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        many: list[tuple[int, bytes]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            packed = _packed((_mixed(rows["own"]) % np.uint64(buckets)).astype(np.int64), rows, ["bucket", "rows"])
            yield pa.RecordBatch.from_arrays([packed.column(0), pa.nulls(packed.num_rows, pa.int64()), packed.column(1)], ["bucket", "g", "rows"])
            if many:
                yield pa.RecordBatch.from_arrays([pa.nulls(len(many), pa.int32()), pa.array([g for g, _ in many], pa.int64()), pa.array([raw for _, raw in many], pa.binary())], ["bucket", "g", "rows"])
            held.clear()
            many.clear()

        for g, own in _groups(batches):
            p = np.frombuffer(b"".join(own), dtype_of(bucket_of(g)))
            rows = nearest_earlier(p, share, blocks_of(g, how))
            rows["g"] = g
            held.append(rows)
            dense = np.unique(rows["word"][rows["more"]])
            if len(dense):
                many.append((g, p[np.isin(p["word"], dense)].tobytes()))
            if sum(map(len, held)) + sum(len(raw) for _, raw in many) // EACH.itemsize > AT_ONCE:
                yield from sent()
        if held:
            yield from sent()

    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(match, "bucket int, g bigint, rows binary")


def _candidates(named: DataFrame) -> DataFrame:
    """(a, bs, more, rest, gs, ws): for each set that has earlier candidates the nearest over all groups, and if there are
    more, all that are known, and the groups and words that have others; named: (bucket, rows) as in _matched."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _groups(batches):
            x = np.frombuffer(b"".join(own), EACH)
            named, more = nearest_of_sets(x)
            if not len(named):
                continue
            first = _first_of_each(named["own"], 1)
            sets, several = named["own"][first], more[first]

            def lists(of: np.ndarray, values: np.ndarray) -> pa.ListArray:
                """values of the sets `of`, which come in their order."""
                n = np.bincount(np.searchsorted(sets, of), minlength=len(sets))
                return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(np.ascontiguousarray(values).view(np.int64)))

            x = x[several[np.searchsorted(sets, x["own"])]]
            x = x[np.lexsort((x["with"], x["own"]))]
            rest = x[np.append(True, (x["own"][1:] != x["own"][:-1]) | (x["with"][1:] != x["with"][:-1]))[: len(x)]]
            x = x[x["more"]]
            x = x[np.lexsort((x["word"], x["g"], x["own"]))]
            x = x[np.append(True, (x["own"][1:] != x["own"][:-1]) | (x["g"][1:] != x["g"][:-1]) | (x["word"][1:] != x["word"][:-1]))[: len(x)]]
            g = np.ascontiguousarray(x["g"])
            cols = [lists(named["own"], named["with"]), pa.array(several), lists(rest["own"], rest["with"]), lists(x["own"], g), lists(x["own"], x["word"].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(sets).view(np.int64)), *cols], ["a", "bs", "more", "rest", "gs", "ws"])

    return named.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "a bigint, bs array<bigint>, more boolean, rest array<bigint>, gs array<bigint>, ws array<bigint>")


def _all_candidates(many: DataFrame, how: Dealing, share: float, open_: DataFrame) -> DataFrame:
    """(a, b): all pairs that pass the filters of the sets in open_ (g, a, w: a word) with earlier ones under the word; many:
    (g, postings), as in _matched."""
    stills = cut(open_.groupBy("g").agg(F.collect_set("a").alias("still"), F.collect_set("w").alias("words")))
    if stills.count() <= BROADCAST:
        many = many.join(F.broadcast(stills.select("g")), "g", "left_semi")
    none = F.lit(None).cast("array<bigint>")
    rows = many.withColumn("still", none).withColumn("words", none).unionByName(stills.withColumn("postings", F.lit(None).cast("binary")))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[bytes] = []
        last, still, words = -1, None, None

        def pairs() -> Iterator[pa.RecordBatch]:
            if own:
                p = np.frombuffer(b"".join(own), dtype_of(bucket_of(last)))
                for found in open_pairs(p[np.isin(p["word"], words)], share, still, blocks_of(last, how)):
                    a, b = np.ascontiguousarray(found.T).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for b in batches:
            for g, raw, list_, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3), strict=True):
                if g != last:
                    yield from pairs()
                    own.clear()
                    last, still = g, None
                if list_.is_valid:  # before the group's postings
                    still, words = np.sort(np.array(list_.as_py(), np.int64).view(np.uint64)), np.array(asked.as_py(), np.uint16)
                elif still is not None:
                    own.append(raw.as_py())
        yield from pairs()

    return rows.select("g", "postings", "still", "words").repartition("g").sortWithinPartitions("g", F.col("postings").isNotNull()).mapInArrow(match, "a bigint, b bigint")


#: What is added to the buckets of counts where they travel with lines.
COUNTS = 1 << 24


def _equal_lines(texts: DataFrame, ranks: Ranks, share: float, buckets: int) -> DataFrame:
    """(k1, k2, rank, h, place, again): every set's earliest line, and again those of its other lines. Rows with place -1
    are counts of postings for dealing_by: k1, k2 and rank are bucket, word and n."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of("line_dedup")
        seen: set[int] = set()
        held: list[np.ndarray] = []
        lines: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            rows = np.concatenate(lines)
            lines.clear()
            return _packed((_mixed(rows["k1"]) % np.uint64(buckets)).astype(np.int64), rows, ["bucket", "rows"])

        def counts() -> pa.RecordBatch:
            x = _counted(np.concatenate(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pc.add(x.column(0), pa.scalar(COUNTS, pa.int32())), x.column(1)], ["bucket", "rows"])

        for b in batches:
            rank, h = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for x in lines_of(b.column(0), ranks):
                rows = np.empty(len(x.size), LINE)
                rows["k1"], rows["k2"], rows["rank"], rows["h"], rows["place"] = x.key[0], x.key[1], rank[x.text], h[x.text], x.place
                lines.append(rows)
                use = _usable(x, share)
                keys = x.key[0][use].tolist()
                use = use[np.fromiter((k not in seen for k in keys), bool, len(keys))]
                seen.update(keys)
                for c, own in _of_class(x, use, share):
                    _, _, bucket, word = _prefixes(x, own, share, buckets)
                    held.append(word_of(bucket * len(LANES) + c, word))
            if sum(map(len, lines)) > AT_ONCE:
                yield packed()
            if sum(map(len, held)) > 2 * AT_ONCE:
                yield counts()
        if lines:
            yield packed()
        if held:
            yield counts()

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "rank", "h", "place", "again"]
        for bucket, own in _groups(batches):
            if bucket >= COUNTS:
                total, hot = _many(own, MOST)
                n = len(hot) + 1
                cols = [[bucket - COUNTS] * n, [-1, *hot["word"].tolist()], [total, *hot["n"].tolist()], [0] * n]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array([-1] * n, pa.int32()), pa.array([False] * n)], names)
                continue
            x = np.frombuffer(b"".join(own), LINE)
            x = x[np.lexsort((x["place"], x["h"], x["rank"], x["k2"], x["k1"]))]
            new = np.append(True, (x["k1"][1:] != x["k1"][:-1]) | (x["k2"][1:] != x["k2"][:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
            same = np.all([x[c] == x[c][start] for c in ("rank", "h", "place")], axis=0)  # a row that repeats
            kept = new | ~same
            cols = [np.ascontiguousarray(x[c][kept]).view(np.int64) for c in ("k1", "k2", "rank", "h")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.ascontiguousarray(x["place"][kept])), pa.array(~new[kept])], names)

    packed = texts.select("text", "rank", "h").mapInArrow(pack, "bucket int, rows binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, "k1 bigint, k2 bigint, rank bigint, h bigint, place int, again boolean")


def verified(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, ranks: Ranks, share: float) -> DataFrame:
    """(own, rank, h, place): of each of the pairs (a, b) of sets that match, the later one's hash and earliest line.

    firsts: (k1, k2, rank, h, place) of all sets; texts: (rank, h, text)."""
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT).cast("int").alias("salts"))
    dealt = pairs.join(salts, "b").select(F.col("a").alias("k1"), "b", F.pmod(F.xxhash64("a"), "salts").cast("int").alias("salt"), F.lit(1).alias("asks"))
    named = salts.select(F.col("b").alias("k1"), "b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("asks"))
    wanted = dealt.unionByName(named).join(firsts, "k1").groupBy(F.col("rank").alias("own_rank"), F.col("h").alias("own_h")).agg(F.collect_list(F.struct("place", "b", "salt", "asks")).alias("x"))
    wanted = cut(wanted.select("own_rank", "own_h", F.col("x.place").alias("places"), F.col("x.b").alias("bs"), F.transform("x", lambda x: x["salt"] * 2 + x["asks"]).alias("salts")))
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    there = texts.join(wanted, (F.col("rank") == F.col("own_rank")) & (F.col("h") == F.col("own_h"))).select("text", "rank", "h", "places", "bs", "salts")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = np.repeat(np.arange(b.num_rows), b.column(3).value_lengths().to_numpy(zero_copy_only=False))
            place, named, salt = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (3, 4, 5))
            # the lines that are asked for, by text and place; some more than once
            at = text << 32 | place
            order = np.argsort(at, kind="stable")
            at = at[order]
            rank, h = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for x in lines_of(b.column(0), ranks):
                line = x.text << 32 | x.place
                lo, hi = np.searchsorted(at, line), np.searchsorted(at, line, "right")
                own = np.flatnonzero(hi > lo)
                own = np.repeat(own, (hi - lo)[own])
                if not len(own):
                    continue
                n = x.size[own]
                starts = np.cumsum(n) - n
                raw = x.words[np.arange(n.sum()) + np.repeat(x.end[own] - n - starts, n)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, n.sum()).astype(np.int32)), pa.array(raw.view(np.int64)))
                rows = order[lo[own[0]] : hi[own[-1]]]
                cols = [pa.array(named[rows]), pa.array((salt[rows] // 2).astype(np.int32)), pa.array((salt[rows] % 2).astype(np.int32)), pa.array(x.key[0][own].view(np.int64)), pa.array(rank[x.text[own]]), pa.array(h[x.text[own]]), pa.array(x.place[own].astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(cols, ["b", "salt", "asks", "own", "rank", "h", "place", "words"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, named, seen = None, {}, set()
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(7)), strict=True))
            lists = b.column(7)
            ends = lists.offsets.to_numpy(zero_copy_only=False)
            words = lists.values.to_numpy(zero_copy_only=False)
            out = []
            for k, (*group, asks, own, rank, h, place) in enumerate(keys):
                if group != last:
                    last, named, seen = group, {}, set()
                at, line = (rank, h, place), words[ends[k] : ends[k + 1]]
                if not asks:
                    named[at] = (own, line.copy())
                elif at not in seen:  # of a row that repeats, once
                    seen.add(at)
                    for other, (key, other_line) in named.items():
                        both = np.count_nonzero(other_line[np.minimum(np.searchsorted(other_line, line), len(other_line) - 1)] == line)
                        if both >= share * (len(line) + len(other_line) - both) - 1e-9:
                            out.append(max((at, own), (other, key)))
            cols = list(zip(*((own, *at) for at, own in out), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.int32())], ["own", "rank", "h", "place"])

    moved = there.mapInArrow(words, "b bigint, salt int, asks int, own bigint, rank bigint, h bigint, place int, words array<bigint>")
    return moved.repartition("b", "salt").sortWithinPartitions("b", "salt", "asks").mapInArrow(compare, "own bigint, rank bigint, h bigint, place int").distinct()


def with_ranks(docs: DataFrame, id_col: str) -> DataFrame:
    """docs with __rank, a long that orders ids: whole numbers by themselves, other ids by their place once sorted."""
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return docs.withColumn("__rank", F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_RANK)))
    ids = docs.select(F.col(id_col).alias("__own")).distinct().orderBy(F.asc_nulls_first("__own"))
    ranked = cut(ids.withColumn("__rank", F.monotonically_increasing_id()))
    return docs.join(ranked, F.col(id_col).eqNullSafe(F.col("__own"))).drop("__own")


def later_lines(texts: DataFrame, share: float = 0.8) -> DataFrame:
    """(rank, h, places): of each of texts (rank, h, text) the places of its lines that match an earlier line."""
    low, high, n = texts.agg(F.min(F.when(F.col("rank") > NULL_RANK, F.col("rank"))), F.max("rank"), F.count("*")).first()
    low, high = low or 0, high or 0
    order = F.greatest((F.col("rank").cast("double") - F.lit(float(low))) / F.lit(float(max(1, high - low))), F.lit(0.0))
    ranks, n_bytes = counted_words(texts, min(MOST_BUCKETS, max(1024, n // 256)))
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, n_bytes // BUCKET_BYTES))
    rows = cut(_equal_lines(texts, ranks, share, buckets))
    lines, firsts = rows.where("place >= 0"), rows.where("place >= 0 and not again").drop("again")
    how = dealing_by(rows.where("place < 0").select(F.col("k1").alias("bucket"), F.col("k2").alias("word"), F.col("rank").alias("n")))

    posting = texts.select("text", order.alias("order"))
    matched = cut(_matched(_postings(posting, ranks, share, buckets, how), how, share, buckets))
    each = cut(_candidates(matched.where("bucket is not null").select("bucket", "rows")))
    later = cut(verified(each.select("a", F.col("bs")[0].alias("b")), firsts, texts, ranks, share))

    def still(rows: DataFrame) -> DataFrame:
        return rows.join(later.select(F.col("own").alias("a")).distinct(), "a", "left_anti")

    others = cut(still(each.where("size(bs) > 1")).select("a", F.explode(F.slice("bs", 2, NAMES)).alias("b")))
    if not others.isEmpty():
        later = later.unionByName(cut(verified(others, firsts, texts, ranks, share)))
    open_ = cut(still(each.where("more")).select("a", "rest", "gs", "ws"))
    if not open_.isEmpty():
        asked = open_.select("a", F.explode(F.arrays_zip("gs", "ws")).alias("x")).select("a", F.col("x.gs").alias("g"), F.col("x.ws").alias("w"))
        many = matched.where("g is not null").select("g", F.col("rows").alias("postings"))
        pairs = _all_candidates(many, how, share, asked).unionByName(open_.select("a", F.explode("rest").alias("b")))
        tried = each.where("more").select("a", F.explode("bs").alias("b"))
        later = later.unionByName(verified(cut(pairs.distinct().join(tried, ["a", "b"], "left_anti")), firsts, texts, ranks, share))
    copies = lines.where("again").select("rank", "h", "place")
    return copies.unionByName(later.drop("own")).groupBy("rank", "h").agg(F.collect_set("place").alias("places"))


def dedup_lines(docs: DataFrame, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col as what is left of it, and `lines`: n_lines int and n_removed int."""
    text = whole_text(text_col)
    keyed = with_ranks(docs, id_col).withColumn("__h", F.xxhash64(text))
    gone = later_lines(keyed.select(F.col("__rank").alias("rank"), F.col("__h").alias("h"), text.alias("text")), share)
    gone = cut(gone.select(F.col("rank").alias("__at"), F.col("h").alias("__of"), F.col("places").alias("__places")))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST else gone
    marked = keyed.join(gone, (F.col("__rank") == F.col("__at")) & (F.col("__h") == F.col("__of")), "left")
    lines = F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, k: ~F.array_contains("__places", k)), "\n")
    counted = marked.withColumn("lines", F.struct(F.size(lines).alias("n_lines"), F.coalesce(F.size("__places"), F.lit(0)).alias("n_removed")))
    return counted.withColumn(text_col, F.when(F.col("__places").isNull(), text).otherwise(left)).drop("__rank", "__h", "__at", "__of", "__places")
