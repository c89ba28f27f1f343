"""The records of files, read from every byte range by itself."""

from __future__ import annotations

import csv
import io
import json
import re
import sys
from collections.abc import Iterable, Iterator
from typing import Any
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa

from rowmill.sources import marks
from rowmill.sources.store import Bytes

# Cell texts of delimited files that mean "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
RECORDS = "source_path string, __block bigint, names array<string>, cells array<string>, text string, whole boolean, failed boolean"
ROWS = 2048
_NULLS = frozenset(NA_TOKENS)


def delimited_cells(text: str, sep: str, width: int) -> Iterator[list[str | None]]:
    """Cells of each record, ``width`` of them: short records get nulls, those with too many
    cells are dropped, blank lines skipped."""
    csv.field_size_limit(sys.maxsize)
    for cells in csv.reader(io.StringIO(text, newline=""), delimiter=sep):
        if not cells or (len(cells) == 1 and not cells[0].strip()):
            continue
        if len(cells) <= width:
            yield [None if c in _NULLS else c for c in cells] + [None] * (width - len(cells))


#: Elements whose children have no attributes, children or references, and need no parser.
_LEAF = r"<([A-Za-z_][A-Za-z0-9_.-]*+)>([^<&\]\r\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]*+)</\{}>[ \t\n]*+"
_FLAT = re.compile(rf"<([A-Za-z_][A-Za-z0-9_.-]*+)>[ \t\n]*+((?:{_LEAF.format(3)})*+)</\1>")
_LEAVES = re.compile(_LEAF.format(1))
#: What may be a name with a prefix; a tree would have its namespace instead.
_PREFIX = re.compile(r"</?[^\s<>]*:|\s[^\s<>=\"']*:[^\s<>=\"']*\s*=")
_JSON = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode


class _Element:
    def __init__(self, attributes: dict[str, str]):
        self.items: dict[str, Any] = dict(attributes)
        self.text: list[str] = []

    def put(self, name: str, value: Any) -> None:
        _put(self.items, name, value)

    def value(self) -> Any:
        return _value(self.items, "".join(self.text))


def _put(items: dict[str, Any], name: str, value: Any) -> None:
    if name not in items:
        items[name] = value
    elif isinstance(items[name], list):
        items[name].append(value)
    else:
        items[name] = [items[name], value]


def _value(items: dict[str, Any], text: str) -> Any:
    """A leaf is its text; other elements have attributes and children, and text as _text."""
    text = text.strip()
    if not items:
        return text or None
    return items | ({"_text": text} if text else {})


def _tree_value(node: ElementTree.Element) -> Any:
    items: dict[str, Any] = dict(node.attrib)
    text = node.text or ""
    for child in node:
        leaf = not len(child) and not child.attrib
        _put(items, child.tag, (child.text or "").strip() or None if leaf else _tree_value(child))
        text += child.tail or ""
    return _value(items, text)


def _parsed_value(xml: str) -> Any:
    """The value of an element, its names as they are written."""
    if "xmlns" not in xml and (":" not in xml or not _PREFIX.search(xml)):
        try:
            return _tree_value(ElementTree.fromstring(xml))
        except ElementTree.ParseError:
            pass  # the parser below says why
    stack = [_Element({})]
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def begin(_: str, attributes: dict[str, str]) -> None:
        stack.append(_Element(attributes))

    def end(name: str) -> None:
        done = stack.pop()
        if len(stack) > 1:
            stack[-1].put(name, done.value())
        else:
            stack[0] = done

    parser.StartElementHandler, parser.EndElementHandler = begin, end
    parser.CharacterDataHandler = lambda text: stack[-1].text.append(text)
    parser.Parse(xml, True)
    return stack[0].value()


def element_items(xml: str) -> dict[str, str]:
    """Attributes and children of an element as texts, nested and repeated ones as JSON."""
    if flat := _FLAT.fullmatch(xml):
        leaves = _LEAVES.findall(flat[2])
        found = dict(leaves)
        if len(found) == len(leaves):
            return {k: v for k, t in found.items() if (v := t.strip())}
    items = _parsed_value(xml)
    items = {"_text": items} if isinstance(items, str) else items or {}
    return {
        k: v if isinstance(v, str) else _JSON(_without_nulls(v))
        for k, v in items.items()
        if v is not None
    }


def _without_nulls(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: _without_nulls(v) for k, v in value.items() if v is not None}
    return [_without_nulls(v) for v in value] if isinstance(value, list) else value


def _of_range(source: Bytes, row: dict[str, Any]) -> Iterator[tuple]:
    """(names, cells, text, part of a whole, failed) of the records that begin in a range."""
    start, end, kind, encoding, state = row["at"], row["end"], row["kind"], row["encoding"], json.loads(row["state"])
    if kind == "delimited":
        sep = "\t" if row["format"] == "tsv" else ","
        text = marks.delimited_text(source, start, end, state["inside"], sep.encode(), row["body"]).decode(encoding)
        for cells in delimited_cells(text, sep, row["width"]):
            yield None, cells, None, False, False
    elif kind == "lines":
        text = marks.delimited_text(source, start, end, False, None, row["body"]).decode(encoding)
        for line in re.split("\r\n?|\n", text):
            if line.strip():
                yield None, None, line, False, False
    elif kind == "array":
        for element in marks.array_elements(source, start, end, state["inside"], state["depth"]):
            yield None, None, element.decode(encoding), True, False
    elif kind == "xml":
        for element in marks.xml_elements(source, start, end, state["state"], state["open"], row["row_tag"]):
            try:
                items = element_items(element.decode(encoding))
            except expat.ExpatError:
                yield None, None, None, True, True
            else:
                yield list(items), list(items.values()), None, True, False


def read_ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the ranges of (path, at, end, kind, format, encoding, state, width, body, row_tag)."""
    columns = ["names", "cells", "text", "whole", "failed"]
    kinds = [pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.bool_()]
    for batch in batches:
        for row in batch.to_pylist():
            with Bytes(row["path"]) as source:
                held: list[tuple] = []
                size = 0

                def flushed() -> pa.RecordBatch:
                    values = [pa.array([r[i] for r in held], kinds[i]) for i in range(5)]
                    place = [pa.array([row["path"]] * len(held)), pa.array([row["at"]] * len(held), pa.int64())]
                    return pa.RecordBatch.from_arrays([*place, *values], ["source_path", "__block", *columns])

                for record in _of_range(source, row):
                    held.append(record)
                    size += len(record[2] or "") + sum(len(c) for c in record[1] or () if c)
                    if len(held) >= ROWS or size >= 8 << 20:
                        yield flushed()
                        held, size = [], 0
                if held:
                    yield flushed()
