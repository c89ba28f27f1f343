"""Files for reviewers: error lists, review pages, validation and batch reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.operators import report

#: Listings of all flagged rows repeat the same words and names, and pack to a fraction.
PACKED = "gzip"


def write_error_list(df: DataFrame, path: str) -> None:
    """CSV with one line per error: row_id, line_number, field, rule, message."""
    report.error_rows(df).write.option("header", True).option("compression", PACKED).mode("overwrite").csv(path)


def review_frame(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Errors with canonical data of all flagged rows, or of the first ``limit`` of them
    (rows, not errors) by file and line, where a caller asks for a page."""
    flagged = df.where(report.is_status("flagged"))
    if limit is not None:
        flagged = flagged.orderBy("file_id", "line_number", "row_id").limit(limit)
    return report.error_rows(flagged, with_canonical=True).select(
        "row_id",
        "line_number",
        F.col("field").alias("error_field"),
        F.col("rule").alias("error_rule"),
        F.col("message").alias("error_message"),
        "canonical_data",
    )


def write_review_csv(df: DataFrame, path: str, limit: int | None = None) -> None:
    review_frame(df, limit).write.option("header", True).option("escape", '"').option("compression", PACKED).mode(
        "overwrite"
    ).csv(path)


def write_validation_json(df: DataFrame, path: str, batch_id: str, file_name: str | None = None) -> None:
    """Summary and flagged details as JSON lines under ``summary`` and ``flagged_details``."""
    options = {"ignoreNullFields": "false"}
    report.summary_record(df, batch_id, file_name).write.options(**options).mode("overwrite").json(
        f"{path}/summary"
    )
    report.flagged_details(df).write.options(**options, compression=PACKED).mode("overwrite").json(f"{path}/flagged_details")


def write_batch_report(df: DataFrame, output: str, batch_id: str) -> dict[str, str]:
    """Report, flagged sample and manifest of a batch under ``output/<batch_id>``."""
    base = f"{output.rstrip('/')}/{batch_id}"
    paths = {
        "report": f"{base}/report",
        "sample": f"{base}/sample_flagged_rows",
        "manifest": f"{base}/manifest",
    }
    options = {"ignoreNullFields": "false"}
    record = report.summary_record(df, batch_id)
    record.write.options(**options).mode("overwrite").json(paths["report"])
    report.flagged_sample(df).write.options(**options).mode("overwrite").json(paths["sample"])
    written = df.sparkSession.read.schema(record.schema).json(paths["report"])
    written.select(
        "batch_id",
        "generated_at",
        F.lit(paths["report"]).alias("report"),
        F.lit(paths["sample"]).alias("sample_flagged_rows"),
        F.col("summary").alias("statistics"),
    ).write.options(**options).mode("overwrite").json(paths["manifest"])
    return paths
