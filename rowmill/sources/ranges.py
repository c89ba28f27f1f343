"""The byte ranges of all files of a folder, each looked at once by itself.

A data source with one input partition for some ranges: a task holds one range at a time,
however large its file. For each range it returns a digest, whether it is valid UTF-8 and
its state for each way it may be entered in. ``folded`` walks over the ranges of each file
in order, holding the state so far, and makes one row a file of them.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rowmill.sources import marks
from rowmill.sources.store import Bytes, files_below

RANGE_BYTES = 16 << 20
#: Bytes, and files, that one input partition takes.
PARTITION_BYTES = 128 << 20
PARTITION_FILES = 256
HEAD = 1 << 16

# Formats by extension and by first bytes.
EXTENSIONS = {
    "csv": "csv",
    "tsv": "tsv",
    "xlsx": "xlsx",
    "xls": "xls",
    "json": "json",
    "jsonl": "jsonl",
    "ndjson": "jsonl",
    "xml": "xml",
    "pdf": "pdf",
    "txt": "txt",
}
MAGIC = {
    b"PK\x03\x04": "xlsx",
    b"%PDF": "pdf",
    b"<?xml": "xml",
    b"<?XML": "xml",
    b"[": "json",
    b"{": "json",
}
SUMMARY = (
    "path string, size bigint, modified_at timestamp, at bigint, end bigint, format string, kind string, "
    "digest binary, utf8 boolean, head binary, body bigint, states string"
)
FILES = (
    "file_id string, filename string, path string, source_path string, file_type string, size_bytes bigint, "
    "modified_at timestamp, format string, encoding string, json_lines boolean, header string, columns array<string>, "
    "quoted_newlines boolean, kind string, body bigint, row_tag string, problem string, ranges array<struct<at: bigint, end: bigint, state: string>>"
)


def extension(path: str) -> str:
    name = path.rpartition("/")[2]
    found = re.search(r"[^.]\.([^.]+)$", name)
    return found[1].lower() if found else ""


def first_line(head: bytes) -> str:
    return head.partition(b"\n")[0].decode("latin-1")


def detect_format(path: str, head: bytes) -> str:
    """By extension, else by first bytes, else by a tab or comma in the first line, else txt."""
    if (ext := extension(path)) in EXTENSIONS:
        return EXTENSIONS[ext]
    for magic, fmt in MAGIC.items():
        if head.startswith(magic):
            return fmt
    line = first_line(head)
    return "tsv" if "\t" in line else "csv" if "," in line else "txt"


def kind_of(fmt: str, head: bytes) -> str | None:
    """How the records of a file are told apart. A JSON file whose first line starts with a
    brace has one object a line."""
    if fmt in ("csv", "tsv"):
        return "delimited"
    if fmt in ("json", "jsonl"):
        return "lines" if first_line(head).removeprefix("ï»¿").strip().startswith("{") else "array"
    return "xml" if fmt == "xml" else None


def separator(fmt: str) -> bytes:
    return b"\t" if fmt == "tsv" else b","


def header_names(line: str, sep: str = ",") -> list[str]:
    """Column names of a header line; repeats get a running suffix, blanks a position."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for at, cell in enumerate(next(csv.reader(io.StringIO(line.lstrip("﻿")), delimiter=sep), [])):
        name = cell or f"Unnamed: {at}"
        count = seen.get(name, 0)
        while count and f"{name}.{count}" in seen:
            count += 1
        seen[name] = count + 1
        if count:
            name = f"{name}.{count}"
            seen.setdefault(name, 1)
        names.append(name)
    return names


def valid_utf8(source: Bytes, start: int, end: int, data: bytes) -> bool:
    """Whether the characters that begin in a range are UTF-8; the last may end beyond it."""
    skip = 0
    while start and skip < 3 and skip < len(data) and data[skip] & 0xC0 == 0x80:
        skip += 1
    if skip == len(data):
        return True
    beyond = source.read(end, end + 3)
    more = 0
    while more < len(beyond) and beyond[more] & 0xC0 == 0x80:
        more += 1
    try:
        (data[skip:] + beyond[:more]).decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def header_record(source: Bytes, sep: bytes) -> tuple[bytes, int]:
    """The first record of a delimited file that is not blank, and where the next begins; -1
    where it is longer than a range, which no header is."""
    size = HEAD
    while True:
        data = source.read(0, size)
        at = len(marks.BOM) if data.startswith(marks.BOM) else 0
        body = data[at:]
        spans, _ = marks.quoted_spans(body, 0, False, sep)
        begin = 0
        while (end := marks.first_break(body, begin, spans)) >= 0 and not body[begin:end].strip():
            begin = end
        if 0 <= end < len(body) or size >= source.size:
            end = len(body) if end < 0 else end
            return body[begin:end].rstrip(b"\r\n"), at + end
        if size >= RANGE_BYTES:
            return b"", -1
        size *= 4


def states_of(source: Bytes, start: int, end: int, kind: str | None, fmt: str) -> dict[str, Any]:
    """What a range says for each state that it may be entered in; the first has one only."""
    first = start == 0
    if kind == "xml":
        return {s: marks.xml_state(source, start, end, s) for s in ("text", *(() if first else marks.ASIDE))}
    if kind not in ("delimited", "array"):
        return {}
    a, b = (source.settle(x, marks.HOLD[kind]) for x in (start, end))
    lead = 1 if a and kind == "delimited" else 0
    data = source.read(a - lead, b)
    ways = (False,) if first else (False, True)
    if kind == "delimited":
        data = data.removeprefix(marks.BOM) if first else data
        return {str(w): marks.delimited_state(data, lead, w, separator(fmt)) for w in ways}
    edges = (data.removeprefix(marks.BOM) if first else data).strip().decode("latin-1")
    return {str(w): marks.array_state(data, w) for w in ways} | {"edges": [edges[:1], edges[-1:]]}


@dataclass
class Some(InputPartition):
    """A few ranges: (path, size, modified_at, start, end)."""

    ranges: list[tuple]

    def __init__(self, ranges: list[tuple]):
        super().__init__(len(ranges))
        self.ranges = ranges


class RangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.step = int(options.get("rangebytes", RANGE_BYTES))
        self.format = options.get("fileformat") or None

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        held: list[tuple] = []
        size = 0
        for path, length, modified in files_below(self.folder):
            for start in range(0, max(length, 1), self.step):
                end = min(start + self.step, length)
                held.append((path, length, modified, start, end))
                size += end - start
                if size >= PARTITION_BYTES or size >= 2 * self.step or len(held) >= PARTITION_FILES:
                    out.append(Some(held))
                    held, size = [], 0
        return [*out, Some(held)] if held or not out else out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for path, size, modified, start, end in partition.ranges:
            with Bytes(path) as source:
                data = source.read(start, end)
                head = source.read(0, HEAD)
                fmt = self.format or detect_format(path, head)
                kind = kind_of(fmt, head)
                line, body = None, len(marks.BOM) if head.startswith(marks.BOM) else 0
                if kind == "delimited" and not start:
                    line, body = header_record(source, separator(fmt))
                yield (
                    path, size, modified, start, end, fmt, kind, hashlib.sha256(data).digest(),
                    valid_utf8(source, start, end, data), line, body, json.dumps(states_of(source, start, end, kind, fmt)),
                )


class Ranges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rowmill_ranges"

    def schema(self) -> str:
        return SUMMARY

    def reader(self, schema) -> RangeReader:
        return RangeReader(dict(self.options))


class Fold:
    """The ranges of one file, in order."""

    def __init__(self, row: dict[str, Any]):
        self.row = row
        self.digests: list[bytes] = []
        self.utf8, self.breaks, self.problem = True, False, None
        self.ranges: list[dict] = []
        self.inside, self.depth, self.ended = False, 0, False
        self.aside, self.open, self.names, self.roots = "text", [], Counter(), 0
        self.edges = ["", ""]

    def add(self, row: dict[str, Any]) -> None:
        states = json.loads(row["states"])
        self.digests.append(row["digest"])
        self.utf8 &= row["utf8"]
        state = getattr(self, f"_{row['kind']}", lambda _: None)(states)
        self.ranges.append({"at": row["at"], "end": row["end"], "state": json.dumps(state)})

    def _delimited(self, states: dict) -> dict:
        entered, found = {"inside": self.inside}, states[str(self.inside)]
        self.breaks |= found["breaks"]
        self.inside = found["inside"]
        return entered

    def _array(self, states: dict) -> dict:
        entered, found = {"inside": self.inside, "depth": self.depth}, states[str(self.inside)]
        low = self.depth + found["low"] if found["marks"] else 1
        over = found["low"] != found["change"] or found["lows"] > 1
        if low < 0 or (low == 0 and over) or (self.ended and found["marks"]):
            self.problem = "Cannot be parsed as a JSON array"
        self.ended |= low <= 0
        self.depth += found["change"]
        self.inside = found["inside"]
        begin, end = states["edges"]
        self.edges = [self.edges[0] or begin, end or self.edges[1]]
        return entered

    def _xml(self, states: dict) -> dict:
        entered, found = {"state": self.aside, "open": list(self.open)}, states[self.aside]
        depth = len(self.open)
        bad = found["bad"]
        for at, name, n in found["counts"]:
            self.roots += n if depth + at == 0 else 0
            bad |= depth + at < 0
            if depth + at == 1:
                self.names[name] += n
        for name in found["closes"]:
            bad |= not self.open or self.open.pop() != name
        self.open += found["opens"]
        self.aside = found["state"]
        if bad:
            self.problem = "Cannot be parsed as XML"
        return entered

    def file(self) -> dict[str, Any]:
        row, kind = self.row, self.row["kind"]
        whole = {
            "delimited": True,
            "array": self.depth == 0 and self.ended and not self.inside and self.edges == ["[", "]"],
            "xml": self.aside == "text" and not self.open and self.roots == 1,
        }
        if row["body"] < 0:
            self.problem = "No header line was found"
        elif not whole.get(kind, True):
            self.problem = "Cannot be parsed as " + ("XML" if kind == "xml" else "a JSON array")
        encoding = "UTF-8" if self.utf8 else "ISO-8859-1"
        line = row["head"].decode(encoding) if row["head"] else None
        one = len(self.digests) == 1
        file_id = self.digests[0] if one else hashlib.sha256(b"".join(self.digests)).digest()
        best = min(self.names, key=lambda n: (-self.names[n], n), default="row")
        return {
            "file_id": file_id.hex(),
            "filename": row["path"].rpartition("/")[2],
            "path": row["path"],
            "source_path": row["path"],
            "file_type": extension(row["path"]) or "unknown",
            "size_bytes": row["size"],
            "modified_at": row["modified_at"],
            "format": row["format"],
            "encoding": encoding,
            "json_lines": kind == "lines" if kind in ("lines", "array") else None,
            "header": line,
            "columns": header_names(line, separator(row["format"]).decode()) if line else None,
            "quoted_newlines": self.breaks,
            "kind": kind,
            "body": row["body"],
            "row_tag": best if kind == "xml" else None,
            "problem": self.problem,
            "ranges": self.ranges,
        }


def folded(summaries: DataFrame) -> DataFrame:
    """One row a file: identity, format, encoding, layout, and the state that each of its
    ranges begins in. Ranges arrive in order and one state is held at a time."""
    schema = summaries.sparkSession.createDataFrame([], FILES).schema

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        now: Fold | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now.row["path"] != row["path"]:
                    if now is not None:
                        done.append(now.file())
                    now = Fold(row)
                now.add(row)
            yield pa.RecordBatch.from_pylist(done, arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.file()], arrow)

    return summaries.repartition("path").sortWithinPartitions("path", "at").mapInArrow(walk, schema)


def ranges(spark: SparkSession, folder: str, format: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """What each byte range of each file says, with one input partition for some ranges."""
    spark.dataSource.register(Ranges)
    read = spark.read.format("rowmill_ranges").option("rangeBytes", range_bytes)
    return (read.option("fileFormat", format) if format else read).load(folder)
