"""Best-fit packing of tokenized documents into sequences of a fixed length.

Bounded-space online best fit: OPEN_BINS bins are open; a bit set keyed by free space finds the fullest bin that still
takes a piece; when too many are open, the fullest closes first. Spark deals pieces over partitions by a hash, and each
partition reads its pieces in the order of another, ROUND at a time, the longest of a round first, so that small pieces
fill what long ones leave. Partitions pack on their own and share nothing, in memory that doesn't grow with them. The
waste is about one sequence a partition, so partitions should hold many sequences, which adaptive execution sees to by
joining small ones.

Defined results: null text counts as empty; an empty text is the end token alone; repeated rows are packed again;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ChunkIds, memory_of, public_vocabulary, whole_text, word_chunks
from .token_counts import byte_symbols

#: Open bins of a partition, and pieces that it puts into the order of their length at a time.
OPEN_BINS, ROUND = 512, 1024
#: Chunks, plain words and runs of signs that a worker remembers; of chunks it has the old ones beside the new.
CHUNKS, WORDS, SIGNS = 500_000, 300_000, 10_000

#: Letters of chunks that the vocabulary's pre-tokenizer cuts into a run of letters and perhaps a full stop or comma.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: The same with one run of other signs at the end.
_SIGNED = re.compile(f"({_PLAIN.pattern})([!-&(-/:-@\\[-`{{-~]{{1,8}})")


class WordIds(ChunkIds):
    """ChunkIds for vocabularies of lower-case words: a plain word goes to the library's merges alone, past its
    normalizer and pre-tokenizer, which would leave it as it is, and is learned once for all its ways of writing."""

    def __init__(self, path: str):
        super().__init__(path)
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.packed = [array("I", [k]).tobytes() for k in range(self.tok.get_vocab_size(with_added_tokens=True))]
        self.ends = {"": b""} | {c: array("I", self.tok.encode(c, add_special_tokens=False).ids).tobytes() for c in ".,"}
        self.letters = {k: "".join(byte_symbols()[b] for b in chr(k).encode()) for k in range(0xC0, 0x100)}

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        known, old, words, merge, rest = self.known, self.old, self.words, self.tok.model.tokenize, set()
        letters, ends, packed = self.letters, self.ends, self.packed
        for c in chunks:
            if (ids := old.get(c)) is not None:
                known[c] = ids
                continue
            if len(c) > 40:
                rest.add(c)
                continue
            word, end = (c[:-1], c[-1]) if c[-1] in ".," else (c, "")
            plain = word.isascii()
            if not (word.isalpha() if plain else _PLAIN.fullmatch(word)):
                if not (signed := _SIGNED.fullmatch(c)):
                    rest.add(c)
                    continue
                word, end = signed.groups()
                plain = word.isascii()
                if end not in ends:
                    if len(ends) >= SIGNS:
                        rest.add(c)
                        continue
                    ends[end] = array("I", self.tok.encode(end, add_special_tokens=False).ids).tobytes()
            word = word.lower()
            ids = words.get(word)
            if ids is None:
                ids = words[word] = b"".join([packed[t.id] for t in merge(word if plain else word.translate(letters))])
            known[c] = ids + ends[end]
        return self.encode(rest) if rest else {}

    def of(self, chunks: list[str]) -> bytes:
        # a full memory becomes the old one; what is met again moves from there to the new one, and the rest goes with it
        if len(self.words) > WORDS:
            self.words.clear()
        if len(self.known) > CHUNKS:
            self.old, self.known = self.known, {"": b""}
        missing = set(chunks).difference(self.known)
        far = self.learn(missing) if missing else {}
        known = self.known
        if far:
            return b"".join([known[c] if c in known else far[c] for c in chunks])
        return b"".join(map(known.__getitem__, chunks))


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian uint32 bytes).

    Each document's ids are followed by end_id; a document of more than `length` ids is cut into pieces of that
    length, the last of which may be shorter. For tokenizers that drop white space."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    end, step = np.uint32(end_id).tobytes(), 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of("packing")
        if tokenizer_path not in memory:
            memory[tokenizer_path] = WordIds(tokenizer_path)
        ids = memory[tokenizer_path]
        for b in batches:
            doc, piece, start, size, crc, raw = [], [], [], [], [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = ids.of(word_chunks(t.as_py())) + end
                for k, at in enumerate(range(0, len(own), step)):
                    part = own[at : at + step]
                    doc.append(d)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        raw.append(part)
            cols = [pa.array(doc, b.schema.field(0).type), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)


class BestFit:
    """Open bins by free space: bit f of `free` is set while a bin with f places left is open."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.most, self.free, self.count, self.made = length, open_bins, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of this size."""
        fits = self.free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = self._take(left)
        else:
            left, own = self.length, self.made
            self.made += 1
        rest = left - size
        if rest:
            self.by_free[rest].append(own)
            self.free |= 1 << rest
            self.count += 1
            if self.count > self.most:
                self._take((self.free & -self.free).bit_length() - 1)
        return own, self.length - left

    def _take(self, left: int) -> int:
        bins = self.by_free[left]
        own = bins.pop()
        if not bins:
            self.free ^= 1 << left
        self.count -= 1
        return own


def best_fit_pack(pieces: DataFrame, length: int = 2048, open_bins: int = OPEN_BINS, size_col: str = "length") -> DataFrame:
    """Adds sequence_id and offset to rows whose size_col lies between 1 and length; ids of different partitions differ.

    The columns doc_id, piece and, if there, ids_crc32 order pieces, so that a task that runs again packs alike."""
    at = pieces.columns.index(size_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(length, open_bins), TaskContext.get().partitionId() << 36
        for b in (x.slice(k, ROUND) for x in batches for k in range(0, x.num_rows, ROUND)):
            sizes = b.column(at).to_numpy(zero_copy_only=False)
            own, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for k in np.argsort(-sizes, kind="stable").tolist():
                own[k], offset[k] = bins.place(int(sizes[k]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own + base), pa.array(offset)], [*b.schema.names, "sequence_id", "offset"])

    keys = ["doc_id", "piece", *(c for c in ("ids_crc32",) if c in pieces.columns)]
    dealt = pieces.repartition(F.xxhash64(*keys)).sortWithinPartitions(F.xxhash64(F.lit(1), *keys), *keys)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, length: int = 2048, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenizes, cuts and packs documents; a sequence is the pieces of one sequence_id in the order of offset."""
    path = tokenizer_path or public_vocabulary("word_bpe_49k.json")
    return best_fit_pack(token_pieces(docs, path, length, with_ids=with_ids, id_col=id_col, text_col=text_col), length)
