"""Byte-pair encoding and decoding of a corpus by a table of distinct words.

Texts are split in Spark tasks into words (common.spaced_chunks: their ids, one after the other, are the text's). Tasks
gather texts into blocks of bounded size; a block has a table of its distinct words and, for each text, the places of
its words in that table. The words of all blocks are dealt by a hash of the word into buckets, so each distinct word of
the corpus is encoded once, by the tokenizers library; the ids go back to the blocks that asked, where they join the
texts by position. Decoding joins ids with the vocabulary's pieces (a fixed table, as large as the vocabulary) once for
each distinct word of a block, and the pieces go by position as well.

Splitting happens twice, once for the words and once for the places: that costs less than keeping either. A block is
named by a hash of what it holds, so a block that came out otherwise the second time would find no table, and the job
would fail rather than answer wrongly; rows that don't come from files in one order (those behind a shuffle, say) are
kept first if asked for. The number of buckets follows the bytes of text, so that a bucket's words fit a worker. What is shuffled: each block's distinct words and their ids, packed by bucket,
and the places, about two bytes a word of the texts; all of it compressed. A word occurs once a block, however frequent
it is.

Defined results: null text counts as empty (no ids, empty decoded text); repeated rows are encoded again; an empty table
gives no rows; other columns are ignored. Special strings in a text get their ids, as by the library's default.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, public_vocabulary, spaced_chunks, tokenizer, whole_text
from .token_counts import byte_symbols

#: A block ends before it would pass so many characters; words are dealt into so many buckets at least and at most, one
#: for each GB of text between.
BLOCK_CHARS, BUCKETS, MOST_BUCKETS = 24 << 20, 1024, 1 << 16
#: Texts whose places travel in one row, and the compression level.
TOGETHER, LEVEL = 64, 3


def piece_table(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file."""
    spec = json.load(open(path, encoding="utf-8"))
    byte_of = {s: k for k, s in enumerate(byte_symbols())}
    ids = spec["model"]["vocab"]
    out = [b""] * (max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for piece, k in ids.items():
        out[k] = bytes(byte_of[c] for c in piece)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


_pieces: dict[str, list[bytes]] = {}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, int], list, list[np.ndarray]]]:
    """(name, words with their places, ids of texts, places of each text's words) of each block."""
    from xxhash import xxh3_64

    words: dict[str, int] = {}
    docs: list = []
    places: list[np.ndarray] = []
    chars, name = 0, xxh3_64()
    for b in batches:
        for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = t.as_py()
            if docs and chars + len(text) > BLOCK_CHARS:
                yield name.intdigest() - (1 << 63), words, docs, places
                words, docs, places, chars, name = {}, [], [], 0, xxh3_64()
            place = words.setdefault
            places.append(np.array([place(c, len(words)) for c in spaced_chunks(text)], np.uint32))
            docs.append(d)
            chars += len(text)
            name.update(f"{d!r} {len(text)} ")
            name.update(text)
    if docs:
        yield name.intdigest() - (1 << 63), words, docs, places


def _packed(places: np.ndarray) -> bytes:
    """Low and high bytes apart: the high ones are mostly zero, as frequent words come early."""
    return zstandard.compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), LEVEL)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the elements of ranges given by start and size, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encode_decode(docs: DataFrame, vocabulary_path: str | None = None, digests: bool = True, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, n_tokens and, of every text, ids_sha256 and decoded_sha256, or else ids array<int> and decoded string.

    keep: docs are checkpointed first, as their rows may come in another order when they are read again."""
    path = vocabulary_path or public_vocabulary("byte_bpe_50k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = cut(rows) if keep else rows
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, min(MOST_BUCKETS, n_bytes >> 30))

    def split_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for name, words, _, _ in _blocks(batches):
            raw = [w.encode() for w in words]
            bucket = np.fromiter((xxh3_64_intdigest(w) % buckets for w in raw), np.int32, len(raw))
            order = np.argsort(bucket, kind="stable")
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)[: len(order)]), len(order))
            out: list[list] = [[], [], [], []]
            for a, z in zip(cuts, cuts[1:], strict=False):
                part = order[a:z]
                own = [raw[k] for k in part]
                for col, x in zip(out, (int(bucket[part[0]]), _packed(part), _packed(np.fromiter(map(len, own), "<u4", len(own))), zstandard.compress(b"".join(own), LEVEL)), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(np.full(len(out[0]), name)), *(pa.array(c, pa.binary()) for c in out[1:])], ["bucket", "block", "place", "size", "words"])

    def split_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        for name, _, ids, places in _blocks(chain([first], batches)):
            out: list[list] = [[], [], []]
            for k in range(0, len(ids), TOGETHER):
                part = places[k : k + TOGETHER]
                for col, x in zip(out, (ids[k : k + TOGETHER], [len(p) for p in part], _packed(np.concatenate(part))), strict=True):
                    col.append(x)
            kinds = (pa.list_(first.schema.field(0).type), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out[0]), name)), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], ["block", "doc_ids", "sizes", "places"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket; a bucket's words are known until the next begins."""
        tok, bucket, known = tokenizer(path), -1, {}
        for b in batches:
            sizes, ids = [], []
            for own, raw_size, raw in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if own != bucket:
                    bucket, known = own, {}
                raw, ends = zstandard.decompress(raw), np.cumsum(_unpacked(raw_size)).tolist()
                words = [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]
                new = [w for w in words if w not in known]
                if new:
                    for w, e in zip(new, tok.encode_batch_fast([w.decode() for w in new], add_special_tokens=False), strict=True):
                        known[w] = array(kept, e.ids).tobytes()
                found = [known[w] for w in words]
                sizes.append(_packed(np.fromiter(map(len, found), "<u4", len(found)) // width))
                ids.append(zstandard.compress(b"".join(found), LEVEL))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], ["block", "place", "size", "ids"])

    def assemble(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:
        if path not in _pieces:
            _pieces[path] = piece_table(path)
        pieces = _pieces[path]
        place, size = (np.concatenate([np.zeros(0, np.int64), *map(_unpacked, table.column(c).to_pylist())]) for c in ("place", "size"))
        flat = np.frombuffer(b"".join(map(zstandard.decompress, table.column("ids").to_pylist())), f"<u{width}").astype(np.int64)
        n = int(place.max()) + 1 if len(place) else 0
        at, of = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        at[place], of[place] = np.cumsum(size) - size, size
        joined = [b"".join([pieces[k] for k in flat[a : a + m].tolist()]) for a, m in zip(at.tolist(), of.tolist(), strict=True)]
        out: list[list] = [[], [], []]
        parts = (p for raw, n in zip(texts.column("places").to_pylist(), texts.column("sizes").to_pylist(), strict=True) for p in np.split(_unpacked(raw), np.cumsum(n)[:-1]))
        for p in parts:
            if len(p) and (p.max() >= n or of[p].min() < 0):
                raise RuntimeError("a block's word table doesn't fit its texts: the input changed between two readings")
            ids = flat[_ragged(at[p], of[p])].astype("<u4")
            decoded = b"".join([joined[k] for k in p.tolist()]).decode("utf-8", "replace")
            out[0].append(len(ids))
            out[1].append(hashlib.sha256(ids.tobytes()).hexdigest() if digests else ids.astype(np.int32))
            out[2].append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
        ids = [d for some in texts.column("doc_ids").to_pylist() for d in some]
        cols = [pa.array(ids, texts.schema.field("doc_ids").type.value_type), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string() if digests else pa.list_(pa.int32())), pa.array(out[2], pa.string())]
        return pa.Table.from_arrays(cols, ["doc_id", "n_tokens", *names])

    # ids travel in two bytes where the vocabulary allows
    kept, width = ("H", 2) if len(piece_table(path)) <= 1 << 16 else ("I", 4)
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    words = rows.mapInArrow(split_words, "bucket int, block bigint, place binary, size binary, words binary").repartition("bucket").sortWithinPartitions("bucket")
    coded = words.mapInArrow(encode, "block bigint, place binary, size binary, ids binary")
    placed = rows.mapInArrow(split_places, f"block bigint, doc_ids array<{kind}>, sizes array<int>, places binary")
    result = f"doc_id {kind}, n_tokens bigint, {names[0]} {'string' if digests else 'array<int>'}, {names[1]} string"
    return placed.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(assemble, result)
