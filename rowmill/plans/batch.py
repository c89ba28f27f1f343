"""The whole job: discover, read, normalise, map, validate, record, export, report."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.ledger import BATCHES, Ledger, skip_processed
from rowmill.operators.mapping import MappingRule, canonical_map, map_fields
from rowmill.operators.normalize import normalise_map
from rowmill.operators.report import totals
from rowmill.operators.validate import validate
from rowmill.records import Fields
from rowmill.session import cut_lineage
from rowmill.sinks.review import write_batch_report
from rowmill.sinks.writers import export_all
from rowmill.sources.intake import read_files
from rowmill.sources.listing import list_files, one_per_content


def new_batch_id() -> str:
    return f"batch_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def refine(
    rows: DataFrame,
    mapping: list[MappingRule],
    rules: dict[str, list[dict[str, Any]]],
    normalise: Callable[[DataFrame], DataFrame] = normalise_map,
    typing: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Ragged rows to normalised, mapped and validated rows. One pass, no shuffle.

    ``normalise`` makes ``normalized`` of ``raw``; ``typing``, where given, works on the
    mapped canonical columns, such as ``schema.normalise_by_schema``.
    """
    mapped = map_fields(
        normalise(rows),
        mapping,
        Fields.ragged("normalized", "raw_kinds" if "raw_kinds" in rows.columns else None),
        keep=[c for c in ("row_id", "file_id", "line_number", "source_name", "raw", "raw_kinds", "normalized") if c in (*rows.columns, "normalized")],
    )
    if typing is not None:
        mapped = typing(mapped)
    return validate(mapped, rules).withColumn("created_at", F.current_timestamp())


def refine_stored(
    ledger: Ledger, files: str | DataFrame, mapping: list[MappingRule], rules: dict[str, list[dict[str, Any]]], **how: Any
) -> DataFrame:
    """The stored rows of a file, or of all in a DataFrame of (file_id), normalised, mapped and
    validated anew from their raw values."""
    rows = ledger.rows_by_file(files) if isinstance(files, str) else ledger.rows().join(files.select("file_id"), "file_id", "left_semi")
    kept = rows.select("row_id", "file_id", "line_number", "source_name", "raw", "raw_kinds", "status")
    return refine(kept, mapping, rules, **how)


def _batch_record(ledger: Ledger, batch_id: str, started: datetime, status: str, counts: dict[str, int], problems: list[str]) -> None:
    now = datetime.now(timezone.utc)
    record = (
        batch_id, started, None if status == "running" else now,
        *(counts.get(c) for c in ("total_rows", "valid_rows", "flagged_rows")), status, problems, now,
    )
    ledger.append("batches", ledger.spark.createDataFrame([record], BATCHES))


def run_batch(
    spark: SparkSession,
    input_dir: str,
    ledger: Ledger,
    output_dir: str,
    mapping: list[MappingRule],
    rules: dict[str, list[dict[str, Any]]],
    force: bool = False,
    batch_id: str | None = None,
    normalise: Callable[[DataFrame], DataFrame] = normalise_map,
    typing: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, Any]:
    """Process what is new in a folder; a rerun over the same content does nothing.

    Rows are written first and read back for export and report. A file is recorded as
    successful only after its rows are stored, so a broken run leaves no trace that a
    later run would trust. A file that cannot be read is recorded as failed with the
    reason and the others go on. The batch is recorded when it starts and when it ends,
    by an error too.
    """
    batch_id = batch_id or new_batch_id()
    started = datetime.now(timezone.utc)
    listing = cut_lineage(skip_processed(list_files(spark, input_dir), ledger.read("files"), force))
    if listing.isEmpty():
        return {"batch_id": batch_id, "status": "success", "files": 0, "total_rows": 0}
    _batch_record(ledger, batch_id, started, "running", {}, [])
    try:
        counts, files, problems = _process(spark, listing, ledger, output_dir, mapping, rules, batch_id, normalise, typing)
    except Exception as problem:
        _batch_record(ledger, batch_id, started, "failed", {}, [str(problem)[:2000]])
        raise
    status = "partial_success" if problems else "success"
    _batch_record(ledger, batch_id, started, status, counts, problems)
    return {"batch_id": batch_id, "status": status, "files": files, **counts, "errors": problems}


def _process(spark, listing, ledger, output_dir, mapping, rules, batch_id, normalise, typing) -> tuple[dict, int, list[str]]:
    taken = read_files(spark, listing)
    refined = refine(taken.rows, mapping, rules, normalise, typing)
    names = list(dict.fromkeys(r.canonical_field for r in mapping))
    stored = refined.withColumn("canonical", canonical_map(refined, names)).select(
        "row_id", "file_id", "line_number", "source_name", "raw", "raw_kinds", "normalized", "canonical",
        "mapping_confidence", "status", "validation_errors", "created_at",
    )
    ledger.append("rows", stored.withColumn("batch_id", F.lit(batch_id)), "batch_id")

    rows = ledger.batch_rows(batch_id)
    per_file = totals(rows, ["file_id"])
    named = one_per_content(listing).join(per_file, "file_id", "left").join(
        taken.problems.groupBy("file_id").agg(F.min("error_message").alias("error_message")), "file_id", "left"
    )
    # lines were there, but none of them was an object
    nothing = (F.col("format").isin("json", "jsonl")) & F.col("json_lines") & F.col("total_rows").isNull() & (F.col("size_bytes") > 0)
    known = cut_lineage(named.withColumn("error_message", F.coalesce("error_message", F.when(nothing, "No line could be read"))))
    ledger.append(
        "files",
        known.select(
            "file_id", "filename", "path", "file_type", "size_bytes",
            F.lit(batch_id).alias("batch_id"),
            F.when(F.col("error_message").isNull(), "success").otherwise("failed").alias("status"),
            "error_message",
            *[
                F.coalesce(F.col(c), F.lit(0)).alias(n)
                for c, n in (("total_rows", "row_count"), ("valid_rows",) * 2, ("flagged_rows",) * 2)
            ],
            F.current_timestamp().alias("recorded_at"),
        ),
    )
    flat = rows.select(
        "source_name", "status", *[F.try_element_at("canonical", F.lit(n)).alias(n) for n in names]
    )
    export_all(flat, f"{output_dir}/{batch_id}/export", "csv")
    write_batch_report(rows, output_dir, batch_id)
    sums = known.agg(
        F.count("*").alias("files"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_rows", "valid_rows", "flagged_rows")],
        F.collect_set("error_message").alias("problems"),  # a few different reasons
    ).first()
    counts = {c: sums[c] for c in ("total_rows", "valid_rows", "flagged_rows")}
    percentage = round(100.0 * counts["valid_rows"] / counts["total_rows"], 2) if counts["total_rows"] else 0.0
    return {**counts, "valid_percentage": percentage}, sums["files"], sorted(sums["problems"])
