"""Rows of an XML document: one for each start of the row element, with attributes, first-level children and text."""

from __future__ import annotations

import codecs
from collections.abc import Iterable
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan import args
from rawscan.errors import RawScanError
from rawscan.shipping import ship
from rawscan.sources.text import in_order, pieces_of, resolved, separator
from rawscan.storage import pinned


def _escaped(text: str, attribute: bool = False) -> str:
    out = text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return out.replace('"', "&quot;") if attribute else out


class Row:
    """What is known of a row when it ends."""

    __slots__ = ("attributes", "children", "nested", "raw", "repeated", "text")

    def __init__(self, attributes):
        self.attributes, self.children = attributes, {}
        self.text, self.nested, self.repeated, self.raw = [], False, False, []


def rows_of(content: Iterable[str], row_element: str, capture: bool):
    """Row after row of a document, given part by part. capture: keep the rows' XML, for the column of invalid rows."""
    done: list[Row] = []
    state = {"row": None, "depth": 0, "child": None}
    parser = expat.ParserCreate("utf-8")
    parser.ordered_attributes, parser.buffer_text = True, True

    def start(name, pairs):
        row = state["row"]
        attributes = dict(zip(pairs[::2], pairs[1::2], strict=True))
        if row is None:
            if name != row_element:
                return
            row = state["row"] = Row(attributes)
            state["depth"] = 0
        else:
            state["depth"] += 1
            if state["depth"] == 1:
                row.repeated |= name in row.children
                state["child"] = row.children[name] = []
            else:
                row.nested = True
        if capture:
            row.raw.append(f"<{name}" + "".join(f' {k}="{_escaped(v, True)}"' for k, v in attributes.items()) + ">")

    def end(name):
        row = state["row"]
        if row is None:
            return
        if capture:
            row.raw.append(f"</{name}>")
        if state["depth"] == 0:
            done.append(row)
            state["row"] = None
        elif state["depth"] == 1:
            state["child"] = None
        state["depth"] -= 1

    def text(data):
        row = state["row"]
        if row is None:
            return
        (row.text if state["child"] is None else state["child"]).append(data)
        if capture:
            row.raw.append(_escaped(data))

    def doctype(*_):
        raise RawScanError("Documents with a DTD are not read")

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    parser.StartDoctypeDeclHandler = doctype
    try:
        for part in content:
            parser.Parse(part.encode("utf-8", "replace"), False)
            yield from done
            done.clear()
        parser.Parse(b"", True)
    except expat.ExpatError as e:
        raise RawScanError(f"The document is not well-formed XML: {e}") from e
    yield from done


def outline(content: Iterable[str], row_element: str) -> tuple[list[str], list[str], bool]:
    """Attributes and children in first-seen order, and whether any row has text of its own."""
    attributes, children, text, seen = {}, {}, False, False
    for row in rows_of(content, row_element, False):
        seen = True
        attributes |= dict.fromkeys(row.attributes)
        children |= dict.fromkeys(row.children)
        text = text or bool("".join(row.text).strip())
    if not seen:
        raise RawScanError(f"ROW_ELEMENT {row_element} was not found")
    return list(attributes), list(children), text


def distinct_names(names: list[str]) -> list[str]:
    """Each name, with _1, _2 and so on where it has been taken."""
    taken, out = set(), []
    for name in names:
        free, n = name, 0
        while free in taken:
            n += 1
            free = f"{name}_{n}"
        taken.add(free)
        out.append(free)
    return out


def xml_load(
    spark: SparkSession,
    path: str,
    encoding: str = "UTF-8",
    row_element: str = "row",
    include_text: str | bool = "false",
    empty_as_null: str | bool = "false",
    invalid_row_column: str = "_errors",
) -> DataFrame:
    """One row for each row element at any depth outside other rows. All columns are text.

    A row is invalid when a child holds elements, a child's name repeats, or it has text of its own without a column for
    it; then the column of invalid rows holds its XML and the others are null, or, without that column, the query fails.
    The object is one stream that one task reads, once for the columns and once for the rows, and holds a batch of it
    and a row at a time; a document that is not well-formed, or has a DTD, fails.
    """
    target, element = args.require_path(path), args.row_element(row_element)
    with_text, null_empty = args.optional_boolean("INCLUDE_TEXT", include_text, False), args.optional_boolean("EMPTY_AS_NULL", empty_as_null, False)
    errors = args.require_string("INVALID_ROW_COLUMN", invalid_row_column).strip()
    charset = args.charset(encoding)
    pin = pinned(spark, target)
    ship(spark)
    charset, _ = resolved(spark, pin, charset)
    cut, size = separator(">", charset), pin.size
    if cut is None:
        raise RawScanError(f"XML can't be read in {charset}")
    scan = in_order(spark, pin, cut)

    def texts(batches):
        decoder, feed, held = codecs.getincrementaldecoder(charset)("replace"), ">".encode(charset), []
        marked = True
        for raw, ended in pieces_of(batches, feed, size):
            held.append(decoder.decode(raw + feed if ended else raw))
            if len(held) == 1024:
                yield "".join(held).removeprefix("\ufeff" if marked else "")
                held, marked = [], False
        yield ("".join(held) + decoder.decode(b"", True)).removeprefix("\ufeff" if marked else "")

    def outlined(batches):
        a, c, t = outline(texts(batches), element)
        yield pa.RecordBatch.from_arrays([pa.array([a], pa.list_(pa.string())), pa.array([c], pa.list_(pa.string())), pa.array([t])], ["a", "c", "t"])

    found = scan.mapInArrow(outlined, "a array<string>, c array<string>, t boolean").first()
    if found is None:
        raise RawScanError("The document is not well-formed XML: it is empty")
    attributes, children = list(found.a), list(found.c)
    text_column = found.t and with_text
    names = distinct_names([*[f"@{a}" for a in attributes], *children, *(["text"] if text_column else [])])
    if errors:
        if errors in names:
            raise RawScanError(f"INVALID_ROW_COLUMN {errors} is also the name of a column")
        names.append(errors)

    def cells(row: Row) -> list[str | None]:
        own = "".join(row.text).strip()
        if row.nested or row.repeated or (own and not text_column):
            if not errors:
                raise RawScanError(f"Unsupported row structure in {element}")
            return [*[None] * (len(names) - 1), "".join(row.raw)]
        tidy = lambda v: None if v is None or (null_empty and v == "") else v
        out = [tidy(row.attributes.get(a)) for a in attributes]
        out += [tidy("".join(row.children[c]).strip() if c in row.children else None) for c in children]
        return [*out, *([own or None] if text_column else []), *([None] if errors else [])]

    def parsed(batches):
        part = []
        for row in rows_of(texts(batches), element, bool(errors)):
            part.append(cells(row))
            if len(part) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.list_(pa.string()))], ["f"])
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.list_(pa.string()))], ["f"])

    return scan.mapInArrow(parsed, "f array<string>").select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])
