"""Records of JSON files by byte ranges: the same at every cut as by reading the file whole."""

import io
import json
import random

import pytest

from leadloom.sources import json_ranges as j
from leadloom.sources import readers

ODD = [
    {"a": "}{][", "b": ["x", {"c": "\\"}], "k": {"d": {"e": [[], {}]}}},
    {"a": '"', "b": '\\"{', "c": "\\\\"},
    {"é": "ü ", "data": [{"inner": 1}], "n": None},
    {},
    {"long": "y\\" * 40, "more": [{"z": "]"}] * 3},
]


class Bytes:
    """Of a file, what the functions need."""

    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return io.BytesIO(self.data[at:]).read(n)


def by_ranges(data, cut, layout, key=""):
    """What the two passes give, in this process."""
    f, quoted, stack, out = Bytes(data), False, [], []
    for at in range(0, len(data), cut):
        stop = min(at + cut, len(data))
        out += [json.loads(r) for _, r in j.records_of(f, j.Span("", at, stop, quoted, tuple(stack), layout, key))]
        quoted, closes, leaves = j.effect(data[at:stop], at, quoted, j._escaped(f, at))
        stack = stack[: max(0, len(stack) - closes)] + leaves
    return out


@pytest.mark.parametrize("ascii_only", [True, False])
@pytest.mark.parametrize("layout", ["array", "wrapped", "objects", "spaced"])
def test_every_cut(layout, ascii_only):
    text = lambda x, **k: json.dumps(x, ensure_ascii=ascii_only, **k)
    data = {
        "array": text([*ODD, "no {", 3, [{"not": "one"}], None]), "wrapped": text({"meta": {"data": [{"no": 1}]}, 'da"ta': [1], "data": ODD, "other": [{"no": 2}]}),
        "objects": "\n".join(map(text, ODD)), "spaced": text({"x": ["["], "data": ODD}, indent=3),
    }[layout].encode()
    kind = {"spaced": "wrapped"}.get(layout, layout)
    for cut in [*range(1, 60), len(data) - 1, len(data), len(data) + 5]:
        assert by_ranges(data, cut, kind, "data" if kind == "wrapped" else "") == ODD


def test_random_files_at_random_cuts():
    rng = random.Random(3)

    def value(depth):
        kind = rng.randint(0, 5 if depth else 2)
        if kind < 3:
            return "".join(rng.choice('ab"\\{}[]:, é') for _ in range(rng.randint(0, 12)))
        return [value(depth - 1) for _ in range(rng.randint(0, 4))] if kind < 4 else {value(0): value(depth - 1) for _ in range(rng.randint(0, 4))}

    for _ in range(60):
        items = [{"v": value(3)} for _ in range(rng.randint(0, 12))]
        for _ in range(5):
            assert by_ranges(json.dumps(items).encode(), rng.randint(1, 40), "array") == items
            assert by_ranges(json.dumps({"m": value(2), "rows": items}).encode(), rng.randint(1, 40), "wrapped", "rows") == items


def test_layouts():
    told = lambda x, keys=None: j.layout_of(json.dumps(x).encode(), True, keys)
    assert told([{}]) == ("array", "") and told({"a": 1}) == ("objects", "") and told({"m": [1], "p": [{}]}) == ("wrapped", "p")
    assert told({"items": [{}], "data": []}, ("data", "items")) == ("wrapped", "data") and told({"rows": [{}]}, ("data",)) == ("objects", "")
    assert j.layout_of(b"\xef\xbb\xbf [", True, None) == ("array", "") and j.layout_of(b'{"a":1}\n{"a":[{}]}', False, None) == ("objects", "")
    assert j.layout_of(b'{"k":[{"n":1}]}\n {"k":[]}', True, None) == ("objects", "")
    with pytest.raises(ValueError):
        j.layout_of(b'{"meta": "' + b"x" * 50, False, None)


def test_in_spark(spark, tmp_path):
    companies = [{"businessId": {"value": f"{k:07d}-1"} if k % 2 else f"{k:07d}-1", "names": [{"name": "A {\\" + "x" * (k % 90), "type": "1"}]} for k in range(400)]
    want = {f"{k:07d}-1" for k in range(400)}
    files = {"array": json.dumps(companies), "wrapped": json.dumps({"total": {"n": [1]}, "results": companies}), "lines": "\n".join(map(json.dumps, companies)), "one": json.dumps(companies[0])}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "empty.json").write_text("")
    for name in files:
        for cut in (700, 1 << 20):
            got = readers.read_register_json(spark, str(tmp_path / f"{name}.json"), range_bytes=cut)
            assert {r["businessId"] for r in got.collect()} == (want if name != "one" else {"0000000-1"})
            assert got.count() == (400 if name != "one" else 1)
    split = j.json_records(spark, str(tmp_path / "array.json"), range_bytes=3000)
    assert split.rdd.getNumPartitions() > 10 and split.select("place").distinct().count() == 400
    assert readers.read_register_json(spark, str(tmp_path / "*.json"), range_bytes=5000).count() == 1201
    assert readers.read_register_json(spark, str(tmp_path / "empty.json")).count() == 0
    persons = readers.read_register_persons(spark, str(tmp_path / "wrapped.json"), wrapper="results", range_bytes=900)
    assert persons.columns == ["record"] and persons.count() == 400
