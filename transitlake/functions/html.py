"""HTML as column expressions: tokens, elements by tag depth, texts with entities decoded.

A page becomes an array of tokens (opening tag, closing tag, text). The extent of an element follows from the running
depth of its tag name, so nested tables, rows and blocks end where they really end; unclosed ones end with their page.
Texts are decoded when they are read (`&uuml;`, `&nbsp;`, `&#8364;`, `&#x20AC;`). Comments, declarations, scripts and styles are no
tokens. Built-in array functions are used, page by page, without any shuffle; `table_cells`, the same for the cells
of all rows at once, walks a page's tokens once in a task's Arrow batches, as array functions look at every token many times.
"""
from __future__ import annotations

import html.entities
import json
import re
import sys
import zlib
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # the tasks get this module's functions, not its name

_TOKEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<"
_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
# Elements without content: they have no closing tag (fixed by the HTML standard).
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _entity_texts() -> dict[str, str]:
    """Entity (without & and ;) -> text: the named ones, and the numbers 128-159, which pages use in the sense of the
    Windows code page."""
    named = {name[:-1]: text for name, text in html.entities.html5.items() if name.endswith(";")}
    return named | {f"#{n}": bytes([n]).decode("cp1252", "replace") for n in range(128, 160)}


_DRAWERS = 512


def _drawers() -> str:
    """The entities dealt out by a checksum of their name: a look-up reads a handful of entries, not thousands."""
    out: list[dict[str, str]] = [{} for _ in range(_DRAWERS)]
    for name, text in _entity_texts().items():
        out[zlib.crc32(name.encode()) % _DRAWERS][name] = text
    return json.dumps(out)


def _char(code: Column) -> Column:
    """The character of a code point; U+FFFD for numbers that are none."""
    sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def unescape(text: Column) -> Column:
    """Entities and character references decoded; what is none stays as it is."""
    drawers = F.from_json(F.lit(_drawers()), "array<map<string,string>>")               # a constant of the plan

    def piece(p: Column) -> Column:
        name = F.regexp_replace(p, "^&|;$", "")
        drawer = F.get(drawers, (F.crc32(F.encode(name, "UTF-8")) % _DRAWERS).cast("int"))
        number = F.when(F.startswith(name, F.lit("#")), F.coalesce(
            F.nullif(F.regexp_extract(name, "^#([0-9]{1,9})$", 1), F.lit("")).cast("bigint"),
            F.conv(F.nullif(F.regexp_extract(name, "^#[xX]([0-9a-fA-F]{1,7})$", 1), F.lit("")), 16, 10).cast("bigint")))
        return F.when(~F.startswith(p, F.lit("&")), p).otherwise(F.coalesce(
            F.try_element_at(drawer, name), _let(number, lambda n: F.when(n.isNotNull(), _char(n))), p))

    pieces = F.regexp_extract_all(text, F.lit(r"&#?[A-Za-z0-9]+;?|[^&]+|&"), 0)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space at either end, non-breaking spaces included."""
    return F.trim(text, F.lit(_SPACE))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(page: Column) -> Column:
    """Array of struct(kind, name, text): kind `open`, `close`, `void` or `text`; names in lower case; texts as they stand."""
    def token(t: Column) -> Column:
        tag = F.when(F.startswith(t, F.lit("<")) & (t != "<"), F.lower(F.regexp_extract(t, "^</?([A-Za-z][A-Za-z0-9:-]*)", 1)))

        def known(name: Column) -> Column:
            kind = (F.when(name.isNull(), "text").when(name.isin("", "script", "style"), "none")
                     .when(name.isin(*VOID) | F.endswith(t, F.lit("/>")), "void")
                     .when(F.startswith(t, F.lit("</")), "close").otherwise("open"))
            return F.struct(kind.alias("kind"), name.alias("name"), F.when(name.isNull(), t).alias("text"))
        return _let(tag, known)

    all_of = F.transform(F.regexp_extract_all(page, F.lit(_TOKEN), 0), token)
    return F.filter(all_of, lambda t: t["kind"] != "none")


def marks(of: Column) -> Column:
    """Array of struct(at, kind, name): the tags among the tokens, with their places."""
    placed = F.transform(of, lambda t, i: F.struct(i.alias("at"), t["kind"].alias("kind"), t["name"].alias("name")))
    return F.filter(placed, lambda m: m["kind"] != "text")


def elements(tags: Column, end: Column, *names: str) -> Column:
    """Array of struct(start, stop, name): where the elements with one of these names open and where they end (the place of
    their closing tag, or `end`, the number of tokens), in the order in which they open. `tags` is a column of `marks`.

    The extent of an element is found by the depth of its own name."""
    def one(name: str) -> Column:
        mine = F.filter(tags, lambda m: (m["name"] == name) & (m["kind"] != "void"))
        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<struct<at:int,open:boolean,depth:int>>").alias("seen"))

        def step(state: Column, m: Column) -> Column:
            opens = m["kind"] == "open"
            # a closing tag without an open one changes nothing
            depth = F.when(opens, state["depth"] + 1).otherwise(F.greatest(state["depth"] - 1, F.lit(0)))
            now = F.struct(m["at"].alias("at"), opens.alias("open"), depth.alias("depth"))
            return F.struct(depth.alias("depth"), F.concat(state["seen"], F.array(now)).alias("seen"))

        seen = F.aggregate(mine, start, step, lambda s: s["seen"])

        def extent(all_seen: Column) -> Column:
            opened = F.filter(all_seen, lambda m: m["open"])
            return F.transform(opened, lambda m: F.struct(
                m["at"].alias("start"),
                F.coalesce(F.array_min(F.transform(F.filter(all_seen, lambda x: (x["at"] > m["at"]) & (x["depth"] < m["depth"])),
                                                   lambda x: x["at"])), end).alias("stop"),
                F.lit(name).alias("name")))
        return _let(seen, extent)

    found = [one(n) for n in names]
    return found[0] if len(found) == 1 else F.array_sort(F.concat(*found))


def text_between(of: Column, start: Column, stop: Column, stripped: bool = True) -> Column:
    """The text of the tokens between two places, piece by piece without outer white space if `stripped`."""
    inside = F.filter(F.slice(of, start + 2, F.greatest(stop - start - 1, F.lit(0))), lambda t: t["kind"] == "text")
    read = lambda t: unescape(t["text"])
    return F.array_join(F.transform(inside, lambda t: strip(read(t)) if stripped else read(t)), "")


def page_text(page: Column) -> Column:
    """All text of a page, tags left out and entities decoded."""
    texts = F.filter(tokens(page), lambda t: t["kind"] == "text")
    return F.array_join(F.transform(texts, lambda t: unescape(t["text"])), "")


_CELL_TAG = re.compile(r"</?(table|tr|td)(?![a-z0-9:-])", re.I | re.A)
_PIECES = re.compile(r"&#?[A-Za-z0-9]+;?")
_ENTITIES = _entity_texts()


def _entity(found: re.Match) -> str:
    """What `unescape` makes of a piece."""
    name = found.group()[1:].removesuffix(";")
    if name in _ENTITIES:
        return _ENTITIES[name]
    if number := re.fullmatch("#([0-9]{1,9})|#[xX]([0-9a-fA-F]{1,7})", name):
        code = int(number[1]) if number[1] else int(number[2], 16)
        return chr(code) if 1 <= code <= 0xD7FF or 0xE000 <= code <= 0x10FFFF else "\ufffd"
    return found.group()


def _text(token: str) -> str:
    return (_PIECES.sub(_entity, token) if "&" in token else token).strip(_SPACE)


def _cells_of(all_of: list[str], cells: int) -> list[tuple[int, list[str]]]:
    """Place among the rows of tables, and the texts of the first cells, of each row that has as many; from a page's tokens."""
    found: dict[str, list[list[int]]] = {"table": [], "tr": [], "td": []}          # [start, stop] in the order of the starts
    opened: dict[str, list[list[int]]] = {"table": [], "tr": [], "td": []}
    for at, token in enumerate(all_of):
        if token[0] == "<" and (tag := _CELL_TAG.match(token)) and not token.endswith("/>"):
            name = tag[1].lower()
            if token[1] != "/":
                element = [at, len(all_of)]
                found[name].append(element)
                opened[name].append(element)
            elif opened[name]:
                opened[name].pop()[1] = at
    tables, furthest = [t[0] for t in found["table"]], list(accumulate((t[1] for t in found["table"]), max))
    starts, out, pos = [c[0] for c in found["td"]], [], -1
    for start, stop in found["tr"]:
        before = bisect_right(tables, start)
        if not before or furthest[before - 1] <= start:
            continue
        pos += 1
        first = bisect_right(starts, start)
        inside = found["td"][first:first + cells]
        if len(inside) == cells and inside[-1][0] < stop:
            out.append((pos, ["".join([_text(t) for t in all_of[a + 1:b] if t[0] != "<" or t == "<"]) for a, b in inside]))
    return out


def table_cells(page: Column, cells: int) -> Column:
    """Array of struct(row_pos, texts): for each row of a table that has at least so many cells, the texts of the first ones
    (`text_between`). A row's cells are all cells below it; `row_pos` counts all rows of tables."""
    kind = T.ArrayType(T.StructType([T.StructField("row_pos", T.IntegerType()), T.StructField("texts", T.ArrayType(T.StringType()))]))

    def read(pages: pa.Array) -> pa.Array:
        ends, nulls, places, texts = [0], [], [], []
        for page in pages.to_pylist():
            for pos, found in _cells_of(page, cells) if page is not None else ():
                places.append(pos)
                texts.extend(found)
            ends.append(len(places))
            nulls.append(page is None)
        each = pa.ListArray.from_arrays(pa.array(range(0, len(texts) + 1, cells), pa.int32()), pa.array(texts, pa.string()))
        rows = pa.StructArray.from_arrays([pa.array(places, pa.int32()), each], ["row_pos", "texts"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=pa.array(nulls, pa.bool_()))

    return F.arrow_udf(read, kind)(F.regexp_extract_all(page, F.lit(_TOKEN), 0))
