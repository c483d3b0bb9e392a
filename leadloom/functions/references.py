"""Character references of HTML as a column expression: names with and without semicolon, decimal and hexadecimal numbers."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A reference as browsers see it: a number, or a name of at most 32 characters.
REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"


#: Between the entries of a table, between an entry's halves, and the same within a half.
_ENTRY, _HALF, _IN_ENTRY, _IN_HALF = "\x01", "\x02", "\x03", "\x04"
#: The beginnings of frequent names; tables are read from the front.
_FIRST = ("am", "nb", "lt", "gt", "qu", "ap", "au", "ou", "ar", "Au", "Ou", "Ar", "ea", "eg", "ag", "co", "nd", "md", "he", "rs", "ls", "rd", "ld", "bu", "mi", "re")


def _by_start() -> dict[str, str]:
    """Names and their texts by the first two letters, so that a lookup reads few of them."""
    out: dict[str, list[str]] = {x: [] for x in _FIRST}
    for name, text in html5.items():
        out.setdefault(name[:2], []).append(f"{name}{_IN_HALF}{text}")
    return {k: _IN_ENTRY.join(v) for k, v in out.items()}


def _as_windows() -> dict[str, str]:
    """Numbers that browsers read by another table: controls of the C1 block as Windows-1252, and zero."""
    out = {"0": "�", "13": "\r"}
    for k in range(0x80, 0xA0):
        try:
            out[str(k)] = bytes([k]).decode("cp1252")
        except UnicodeDecodeError:
            out[str(k)] = chr(k)
    return out


def _constant(table: dict[str, str]) -> Column:
    """A map that the optimizer makes once a query."""
    return F.str_to_map(F.lit(_ENTRY.join(f"{k}{_HALF}{v}" for k, v in table.items())), F.lit(_ENTRY), F.lit(_HALF))


#: Names that count without a semicolon, even with letters after them.
_BARE = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"


def _named(body: Column) -> Column:
    names = _constant(_by_start())
    near = lambda name: F.try_element_at(names, F.substring(name, 1, 2))
    of = lambda name: F.try_element_at(F.str_to_map(near(name), F.lit(_IN_ENTRY), F.lit(_IN_HALF)), name)
    bare = F.regexp_extract(body, _BARE, 0)
    return F.coalesce(of(body), F.when(bare != "", F.concat(of(bare), F.substring(body, F.length(bare) + 1, F.length(body)))), F.concat(F.lit("&"), body))


def character(n: Column) -> Column:
    """The character of a code point; n: an int."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _numbered(body: Column) -> Column:
    return let(_code_point(body), _meant)


def _code_point(body: Column) -> Column:
    digits = lambda pattern: F.regexp_extract(body, f"^#{pattern}", 1)
    dec, six = digits("0*([0-9]+)"), digits("[xX]0*([0-9a-fA-F]+)")
    beyond = F.lit(0x110000)
    return F.when(dec != "", F.when(F.length(dec) > 7, beyond).otherwise(dec.try_cast("int"))).otherwise(F.when(F.length(six) > 6, beyond).otherwise(F.conv(six, 16, 10).try_cast("int")))


def _meant(n: Column) -> Column:
    windows = F.try_element_at(_constant(_as_windows()), n.cast("string"))
    no_text = n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return F.when(windows.isNotNull(), windows).when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("�")).when(no_text, F.lit("")).otherwise(character(n))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that stands in it many times and is computed once; without it the plan has as many copies."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **values: Column) -> DataFrame:
    """df with columns that are computed once a row. A generator makes them, so that neither a filter nor a projection
    over them brings their expressions along, as often as it reads them. They replace columns of their names."""
    return df.select(*[f"`{c}`" for c in df.columns if c not in values], F.inline(F.array(F.struct(*[c.alias(name) for name, c in values.items()]))))


def unescape(c: Column) -> Column:
    """The text with its character references replaced by what they stand for, each once."""
    text = lambda x: F.when(F.startswith(x, F.lit("&#")), _numbered(F.substring(x, 2, 40))).otherwise(_named(F.substring(x, 2, 40)))
    found = lambda t: F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)), text)
    whole = lambda t: F.array_join(F.zip_with(F.split(t, REFERENCE, -1), found(t), lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")
    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), whole(t)).otherwise(t))
