"""Writers by format name, each a distributed write of one folder."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.operators.report import totals, with_status
from rowmill.records import Fields, column
from rowmill.sinks.frames import csv_frame, record_frame


def write_csv(df: DataFrame, path: str, **options: Any) -> None:
    csv_frame(df, **options).write.option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).mode("overwrite").csv(path)


def write_json_lines(df: DataFrame, path: str, **options: Any) -> None:
    record_frame(df, **options).write.option("ignoreNullFields", False).mode("overwrite").json(path)


def _framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one JSON array per task: brackets around, commas between, streamed."""
    held = None
    for batch in batches:
        if batch.empty:
            continue
        texts = batch["value"].reset_index(drop=True)
        before = pd.Series(["["] if held is None else [held + ","])
        yield pd.DataFrame({"value": pd.concat([before, texts.iloc[:-1] + ","], ignore_index=True)})
        held = texts.iloc[-1]
    if held is not None:
        yield pd.DataFrame({"value": [held, "]"]})


def write_json_array(df: DataFrame, path: str, pretty: bool = True, **options: Any) -> None:
    """Every output file is one JSON array; files are written in parallel, unbounded."""
    frame = record_frame(df, **options)
    text = F.to_json(
        F.struct(*[column(c) for c in frame.columns]),
        {"ignoreNullFields": "false", "pretty": str(pretty).lower()},
    )
    frame.select(text.alias("value")).mapInPandas(_framed, "value string").write.mode(
        "overwrite"
    ).text(path)


def write_xml(
    df: DataFrame,
    path: str,
    root_element: str = "data",
    row_element: str = "row",
    status: str | None = None,
    **options: Any,
) -> None:
    """Rows as elements; the root carries the number of exported rows and their status."""
    frame = record_frame(df, status=status, **options)
    named = frame.toDF(*[c.replace(" ", "_") for c in frame.columns])
    count = with_status(df, status).count()
    named.write.option("rootTag", f'{root_element} count="{count}" status="{status or "mixed"}"').option(
        "rowTag", row_element
    ).option("nullValue", "").mode("overwrite").xml(path)


WRITERS = {"csv": write_csv, "jsonl": write_json_lines, "json": write_json_array, "xml": write_xml}


def export_rows(df: DataFrame, format: str, path: str, **options: Any) -> None:
    """Write rows in a format by name."""
    if format not in WRITERS:
        raise ValueError(f"Unsupported export format: {format}")
    WRITERS[format](df, path, **options)


def output_path(
    base: str, format: str, date: str | None = None, status: str | None = None, by_format: bool = True
) -> str:
    """Folder of an export: base, then format, date and status where asked for."""
    return "/".join(p for p in (base.rstrip("/"), format if by_format else None, date, status) if p)


def export_split(df: DataFrame, format: str, base: str, **options: Any) -> dict[str, Any]:
    """Valid and flagged rows to ``_valid`` and ``_flagged`` folders, with a result record."""
    counts = totals(df).first()
    if counts.total_rows == 0:
        return {"status": "NO_DATA"}
    result: dict[str, Any] = {"status": "SUCCESS", **counts.asDict()}
    for status in ("valid", "flagged"):
        path = f"{base.rstrip('/')}_{status}"
        result[f"{status}_export"] = path if result[f"{status}_rows"] else None
        if result[f"{status}_rows"]:
            export_rows(df, format, path, status=status, **options)
    return result


def export_all(df: DataFrame, path: str, format: str = "csv") -> DataFrame:
    """All files in one write, a folder per source and status; returns counts per source."""
    if format not in ("csv", "jsonl"):
        raise ValueError(f"Unsupported export format: {format}")
    data = sorted(Fields.flat(df).types)
    wide = df.select("source_name", "status", *[column(n) for n in data])
    writer = wide.write.partitionBy("source_name", "status").mode("overwrite")
    if format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.option("ignoreNullFields", False).json(path)
    return totals(df, ["source_name"])
