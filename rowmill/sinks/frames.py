"""The rows of an export: status, fields and optional metadata columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.operators.report import error_string, with_status
from rowmill.records import Fields, column


def csv_frame(
    df: DataFrame,
    status: str | None = None,
    fields: list[str] | None = None,
    include_metadata: bool = False,
    include_errors: bool = False,
    include_raw: bool = False,
    include_normalized: bool = False,
) -> DataFrame:
    """Given fields, or all in sorted order, then the metadata columns asked for.

    A field the rows do not have becomes an empty column; all columns are text-ready.
    """
    known = Fields.flat(df).types
    out = []
    for name in fields or sorted(known):
        out.append(column(name) if name in known else F.lit(None).cast("string").alias(name))
    if include_metadata:
        out += [
            F.col("row_id").alias("_row_id"),
            F.col("line_number").alias("_line_number"),
            F.col("status").alias("_status"),
        ]
    if include_errors:
        out.append(error_string().alias("_errors"))
    for wanted, name in ((include_raw, "raw"), (include_normalized, "normalized")):
        if wanted:
            text = F.to_json(F.col(name), {"ignoreNullFields": "false"})
            out.append(text.alias(f"_{name}_data"))
    return with_status(df, status).select(*out)


def record_frame(
    df: DataFrame,
    status: str | None = None,
    fields: list[str] | None = None,
    include_metadata: bool = False,
    include_errors: bool = True,
) -> DataFrame:
    """Rows for JSON and XML: fields the rows do not have are left out."""
    known = Fields.flat(df).types
    kept = [n for n in fields if n in known] if fields else list(known)
    return csv_frame(df, status, kept, include_metadata, include_metadata and include_errors)
