"""A Python data source that reads the records of large JSON files by byte ranges, whatever the layout.

A JSON file has no place from which reading may safely begin: a brace may be text. So files are read in two passes, each
with a task for every range of bytes. The first pass finds what a range does to a reader that enters it, once for a
reader who is inside a string and once for one who isn't: how many open brackets it closes, which it leaves open and
whether it ends inside a string. These effects compose, so the driver knows from a row or two a range (not from its
records) with which brackets open each range begins. In the second pass a range yields the records that begin in it, and
reads on past its end until its last record is closed. The result is the same for every cut.

Layouts: objects one after another (lines, or one alone); an array of objects; an object that holds such an array under a
key. A record is an object of the outermost array; other elements are skipped. Which layout and key a file has is told
from its first HEAD bytes, or by the caller.

Paths are listed by Spark and opened by the file systems of pyarrow in the tasks. Compressed files can't be cut and aren't
read. Bytes that aren't UTF-8 become replacement characters; an empty file has no records; a last record that is never
closed is left out, as is whatever follows a closing bracket too many.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE, HEAD, KEY, BATCH = 32 << 20, 1 << 20, 4096, 4096

_TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+(?:"|\\?\Z)|[\[\]{}]', re.S)
_CLOSED = re.compile(rb'"(?:[^"\\]++|\\.)*+"\Z', re.S)
_REST = re.compile(rb'(?:[^"\\]++|\\.)*+("|\\?\Z)', re.S)
_KEY_BEFORE = re.compile(rb'("(?:[^"\\]|\\.)*+")\s*:\s*\Z', re.S)
_QUOTE, _OPEN, _BRACE, _BRACKET = ord('"'), b"[{", ord("{"), ord("[")


def opened(path: str):
    """A file for reading at any place."""
    from pyarrow.fs import FileSystem

    system, name = FileSystem.from_uri(re.sub("^file:/+", "file:///", path)) if "://" in path or path.startswith("file:/") else FileSystem.from_uri(f"file://{path}")
    return system.open_input_file(name)


def _escaped(f, at: int) -> bool:
    """Whether the byte at `at` follows an odd run of backslashes."""
    run = 0
    while at:
        part = f.read_at(min(at, KEY), at - min(at, KEY))
        own = len(part) - len(part.rstrip(b"\\"))
        run, at = run + own, at - len(part)
        if own < len(part):
            break
    return run % 2 == 1


def _first_free(data: bytes, quoted: bool, escaped: bool) -> int | None:
    """Where a reader is outside strings for the first time; None: never."""
    if not quoted:
        return 0
    m = _REST.match(data, 1 if escaped and data else 0)
    return m.end() if m[1] == b'"' else None


def effect(data: bytes, base: int, quoted: bool, escaped: bool) -> tuple[bool, int, list[tuple[int, int]]]:
    """Ends inside a string; brackets of before that it closes; (bracket, place) that it leaves open."""
    at = _first_free(data, quoted, escaped)
    if at is None:
        return True, 0, []
    closes, leaves, last = 0, [], None
    for m in _TOKEN.finditer(data, at):
        c = data[m.start()]
        if c == _QUOTE:
            last = m
        elif c in _OPEN:
            leaves.append((c, base + m.start()))
        elif leaves:
            leaves.pop()
        else:
            closes += 1
    ends = last is not None and last.end() == len(data) and not _CLOSED.match(last[0])
    return ends, closes, leaves


@dataclass
class Span(InputPartition):
    file: str
    start: int
    stop: int
    quoted: bool = False
    stack: tuple = ()
    layout: str = ""
    key: str = ""


@dataclass
class Task(InputPartition):
    spans: tuple


def key_before(f, at: int) -> str | None:
    """The key whose value begins at `at`."""
    m = _KEY_BEFORE.search(f.read_at(min(at, KEY), at - min(at, KEY)))
    return json.loads(m[1].decode("utf-8", "replace"), strict=False) if m else None


def _end(data: bytes, at: int) -> int | None:
    depth = 0
    for m in _TOKEN.finditer(data, at):
        c = data[m.start()]
        if c != _QUOTE:
            depth += 1 if c in _OPEN else -1
            if not depth:
                return m.end()
    return None


def records_of(f, span: Span) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of the records that begin in a range."""
    size = span.stop - span.start
    data = f.read_at(size, span.start)
    at = _first_free(data, span.quoted, span.quoted and _escaped(f, span.start))
    if at is None:
        return
    stack, keys = [tuple(x) for x in span.stack], {}

    def here() -> bool:
        if span.layout == "objects":
            return not stack
        if span.layout == "array":
            return len(stack) == 1 and stack[0][0] == _BRACKET
        if len(stack) != 2 or stack[0][0] != _BRACE or stack[1][0] != _BRACKET:
            return False
        place = stack[1][1]
        if place not in keys:
            keys[place] = key_before(f, place)
        return keys[place] == span.key

    while (m := _TOKEN.search(data, at)) and m.start() < size:
        c, at = data[m.start()], m.end()
        if c == _BRACE and here():
            start, more = m.start(), KEY
            while (stop := _end(data, start)) is None:
                part = f.read_at(more, span.start + len(data))
                if not part:
                    return
                data, more = data + part, more * 2
            yield span.start + start, data[start:stop]
            at = stop
        elif c in _OPEN:
            stack.append((c, span.start + m.start()))
        elif c != _QUOTE and stack:
            stack.pop()


class JsonRanges(DataSource):
    """Options: mode (effects or records), spans, the ranges as JSON, and together, how many of them a task reads."""

    @classmethod
    def name(cls) -> str:
        return "json_ranges"

    def schema(self) -> str:
        if self.options["mode"] == "effects":
            return "file string, start bigint, entered_quoted boolean, ends_quoted boolean, closes int, leaves array<struct<bracket:int,place:bigint>>"
        return "file string, place bigint, record string"

    def reader(self, schema) -> DataSourceReader:
        return JsonRangesReader(self.options["mode"], json.loads(self.options["spans"]), int(self.options["together"]))


class JsonRangesReader(DataSourceReader):
    def __init__(self, mode: str, spans: list[dict], together: int):
        self.mode, self.spans, self.together = mode, spans, together

    def partitions(self) -> list[InputPartition]:
        return [Task(tuple(Span(**x) for x in self.spans[k : k + self.together])) for k in range(0, len(self.spans), self.together)]

    def read(self, task: Task) -> Iterator:
        for span in task.spans:
            yield from self._read(span)

    def _read(self, span: Span) -> Iterator:
        with opened(span.file) as f:
            if self.mode == "effects":
                data, escaped = f.read_at(span.stop - span.start, span.start), _escaped(f, span.start)
                for quoted in (False, True):
                    yield (span.file, span.start, quoted, *effect(data, span.start, quoted, escaped))
                return
            some: list[tuple[int, str]] = []
            for place, record in records_of(f, span):
                some.append((place, record.decode("utf-8", "replace")))
                if len(some) == BATCH:
                    yield self._batch(span.file, some)
                    some = []
            if some:
                yield self._batch(span.file, some)

    @staticmethod
    def _batch(file: str, some: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file] * len(some)), pa.array([p for p, _ in some], pa.int64()), pa.array([r for _, r in some])], ["file", "place", "record"])


def layout_of(head: bytes, whole: bool, keys: tuple[str, ...] | None) -> tuple[str, str]:
    """(layout, key) from the first bytes of a file; keys: names that the array may have, best first; None: any name, the
    first array of objects."""
    text = head.removeprefix(b"\xef\xbb\xbf").lstrip()
    if not text.startswith(b"{"):
        return ("array", "") if text.startswith(b"[") else ("objects", "")
    depth, found, closed = 0, [], False
    for m in _TOKEN.finditer(head):
        c = head[m.start()]
        if c == _QUOTE:
            continue
        if c == _BRACKET and depth == 1:
            m2 = _KEY_BEFORE.search(head, max(0, m.start() - KEY), m.start())
            key, first = json.loads(m2[1].decode("utf-8", "replace"), strict=False) if m2 else "", head[m.end() : m.end() + KEY].lstrip()[:1]
            if first == b"{" or keys is not None and key in keys:
                found.append(key)
        depth += 1 if c in _OPEN else -1
        if not depth:
            if head[m.end() : m.end() + KEY].lstrip().startswith(b"{"):  # one of several
                return "objects", ""
            closed = True
            break
    some = [k for k in (keys or found) if k in found]
    if some:
        return "wrapped", some[0]
    if closed or whole:
        return "objects", ""
    raise ValueError(f"the first {len(head)} bytes don't tell under which key the records are: give it")


def json_records(spark: SparkSession, path: str, keys: tuple[str, ...] | None = None, wrapper: str | None = None, range_bytes: int = RANGE) -> DataFrame:
    """(file, place, record): every record as text, with the byte at which it begins. wrapper: the key of the array, if
    it is known; keys: see layout_of."""
    spark.dataSource.register(JsonRanges)
    files = [(r["path"], r["length"]) for r in spark.read.format("binaryFile").load(path).select("path", "length").collect() if r["length"]]
    kinds = {}
    for file, size in files:
        if wrapper is None:
            with opened(file) as f:
                kinds[file] = layout_of(f.read_at(min(HEAD, size), 0), size <= HEAD, keys)
        else:
            kinds[file] = ("wrapped", wrapper)
    spans = [{"file": file, "start": at, "stop": min(at + range_bytes, size), "layout": kinds[file][0], "key": kinds[file][1]} for file, size in files for at in range(0, size, range_bytes)]
    # short ranges share a task: up to RANGE bytes, as long as there are three tasks a core
    together = max(1, min(RANGE // range_bytes, len(spans) // (3 * spark.sparkContext.defaultParallelism)))
    load = lambda mode: spark.read.format("json_ranges").option("mode", mode).option("spans", json.dumps(spans)).option("together", str(together)).load()
    if not spans:
        return spark.createDataFrame([], "file string, place bigint, record string")
    if len(spans) > len(files):  # whole files begin outside of everything
        known = {(r["file"], r["start"], r["entered_quoted"]): r for r in load("effects").collect()}
        file, quoted, stack = None, False, []
        for x in spans:
            if x["file"] != file:
                file, quoted, stack = x["file"], False, []
            x |= {"quoted": quoted, "stack": [list(b) for b in stack]}
            r = known[file, x["start"], quoted]
            stack = stack[: max(0, len(stack) - r["closes"])] + [(b["bracket"], b["place"]) for b in r["leaves"]]
            quoted = r["ends_quoted"]
    return load("records").select("file", "place", F.col("record"))
