"""What several operators of this subpackage share: checkpoints, tokenizer files, token chunks."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid
from array import array
from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.components import cut as cut
from ..functions.components import ready_to_checkpoint as ready_to_checkpoint

#: Most chunks a worker remembers, and the longest that it remembers.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48

_ODD = re.compile(r"[\x00\x1c-\x1f]|<\|")
_RUN = re.compile(r"(\s{2,}|\s\Z)")
_tokenizers: dict = {}
_memories: dict[str, dict] = {}


def memory_of(operator: str) -> dict:
    """What a worker remembers from one task of an operator to the next. Spark reuses workers over the stages of a pipeline, so
    the first task of another operator lets go of what the last one remembered, and gives what is free back to the system."""
    others = [k for k in _memories if k != operator]
    if others:
        for other in others:
            del _memories[other]
        _tokenizers.clear()
        _chunk_ids.clear()
        give_back()
    return _memories.setdefault(operator, {})


def give_back() -> None:
    """Returns a worker's free memory to the system; its allocators would keep most of it for the worker's life."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, by: list[str], how: str = "inner", salts: int = 64) -> DataFrame:
    """left join right, where the keys in `hot` (a table of bounded size) are spread over many tasks: left's rows by a hash
    of the columns `by`, while right's, of which there are few for each key, are repeated."""
    few = F.broadcast(hot.select(*keys).distinct().withColumn("__hot", F.lit(True)))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")).otherwise(0)
    every = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    a = left.join(few, keys, "left").withColumn("__salt", salt).drop("__hot")
    b = right.join(few, keys, "left").withColumn("__salt", F.explode(every)).drop("__hot")
    return a.join(b, [*keys, "__salt"], how).drop("__salt")


@contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of df as a table in the shared checkpoint folder, which is deleted when the block ends: for what is needed
    several times before a result, but not by the result itself."""
    spark = df.sparkSession
    ready_to_checkpoint(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tokenizer(path: str):
    """The tokenizers library's object for a file, once a worker, without truncation and padding."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _tokenizers[path] = t
    return _tokenizers[path]


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def spaced_chunks(text: str) -> list[str]:
    """Cuts a text where a byte-level pre-tokenizer always cuts: before a space that a non-space follows, round a
    single line feed, and inside longer white space before its last character. Their tokens, one chunk after the
    other, are the text's. A text with control characters on which libraries differ about white space, or with
    what may begin a special string, stays whole."""
    if _ODD.search(text):
        return [text]
    parts = _RUN.split(text)
    out: list[str] = []
    lead = ""
    for k in range(0, len(parts), 2):
        seg = lead + parts[k]
        if seg:
            out += seg.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
        if k + 1 < len(parts):
            run = parts[k + 1]
            if k + 2 == len(parts) - 1 and not parts[k + 2]:
                out.append(run)
                lead = ""
                break
            if len(run) > 1:
                out.append(run[:-1])
            lead = run[-1]
    return out


def word_chunks(text: str) -> list[str]:
    """Cuts at spaces and line feeds, for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


class ChunkIds:
    """Token ids of chunks as little-endian unsigned 32-bit bytes, remembered up to a bound."""

    def __init__(self, path: str):
        self.tok, self.known = tokenizer(path), {"": b""}

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of the long chunks among these; the others are in self.known afterwards."""
        known = self.known
        if len(known) > 2 * CACHE_ENTRIES:
            known.clear()
            known[""] = b""
        return self.encode([c for c in chunks if c not in known])

    def encode(self, chunks: Collection[str]) -> dict[str, bytes]:
        """As learn, for chunks that aren't in self.known, of which nothing is forgotten."""
        found = self.tok.encode_batch_fast(list(chunks), add_special_tokens=False) if chunks else []
        far = {}
        for c, e in zip(chunks, found, strict=True):
            (self.known if len(c) <= CACHE_CHARS else far)[c] = array("I", e.ids).tobytes()
        return far

    def of(self, chunks: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, chunks))
        except KeyError:
            far = self.learn(set(chunks))
            known = self.known
            return b"".join([known[c] if c in known else far[c] for c in chunks])


_chunk_ids: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """One memory a worker and tokenizer; Spark reuses workers over tasks."""
    if path not in _chunk_ids:
        _chunk_ids[path] = ChunkIds(path)
    return _chunk_ids[path]
