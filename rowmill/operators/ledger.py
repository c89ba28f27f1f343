"""State tables as append-only Parquet: files, rows, batches, decisions.

A record is never updated in place; the latest one per key counts. Rows are
partitioned by batch, and only rows of batches recorded as successful are current.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators.joins import spread_lookup
from rowmill.records import NO_ERRORS

FILES = (
    "file_id string, filename string, path string, file_type string, size_bytes bigint, "
    "batch_id string, status string, error_message string, row_count bigint, valid_rows bigint, "
    "flagged_rows bigint, recorded_at timestamp"
)
ROWS = (
    "row_id string, file_id string, line_number bigint, source_name string, "
    "raw map<string,string>, raw_kinds map<string,string>, normalized map<string,string>, canonical map<string,string>, "
    f"mapping_confidence map<string,double>, status string, validation_errors {NO_ERRORS}, "
    "created_at timestamp, batch_id string"
)
BATCHES = (
    "batch_id string, started_at timestamp, completed_at timestamp, total_rows bigint, "
    "valid_rows bigint, flagged_rows bigint, status string, errors array<string>, recorded_at timestamp"
)
DECISIONS = (
    "row_id string, decision string, reviewer_id string, comment string, decided_at timestamp"
)
SCHEMAS = {"files": FILES, "rows": ROWS, "batches": BATCHES, "decisions": DECISIONS}


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """The newest record per key, by partial aggregation: hot keys need no sort."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest)).alias("__latest")
    return df.groupBy(*keys).agg(best).select(*keys, "__latest.*").select(*df.columns)


def skip_processed(listing: DataFrame, ledger_files: DataFrame, force: bool = False) -> DataFrame:
    """Files whose content has no successful record; all of them with ``force``."""
    if force:
        return listing
    done = ledger_files.where("status = 'success'").select("file_id").distinct()
    return listing.join(done, "file_id", "left_anti")


def effective_status(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows with the latest reviewer decision, which replaces the status where there is one."""
    last = latest_per_key(decisions, ["row_id"], ["decided_at", "reviewer_id", "decision"]).select(
        "row_id", "decision", F.col("reviewer_id").alias("approved_by"), F.col("decided_at").alias("approved_at")
    )
    return rows.join(last, "row_id", "left").withColumn(
        "effective_status", F.coalesce("decision", "status")
    )


def orphan_keys(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys of rows without a parent, with row counts. Counted before the join."""
    counted = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.join(parents.select(key).distinct(), key, "left_anti")


def rows_of_files(rows: DataFrame, files: DataFrame, salts: int = 16) -> DataFrame:
    """Rows of the given files; one file may hold most of the rows."""
    return spread_lookup(rows, files.select("file_id").distinct(), ["file_id"], "left_semi", salts)


def current_rows(rows: DataFrame, files: DataFrame, salts: int = 16) -> DataFrame:
    """Rows as of the latest successful batch of their file."""
    last = latest_per_key(
        files.where("status = 'success'").select("file_id", "batch_id", "recorded_at"),
        ["file_id"],
        ["recorded_at", "batch_id"],
    ).select("file_id", "batch_id")
    return spread_lookup(rows, last, ["file_id", "batch_id"], "left_semi", salts)


@dataclass(frozen=True)
class Ledger:
    """The four tables under one root folder."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        """All records of a table; empty before the first append."""
        try:
            return self.spark.read.schema(SCHEMAS[table]).parquet(self.path(table))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[table])

    def append(self, table: str, df: DataFrame, partition: str | None = None) -> None:
        writer = df.write.mode("append")
        (writer.partitionBy(partition) if partition else writer).parquet(self.path(table))

    def files(self) -> DataFrame:
        return latest_per_key(self.read("files"), ["file_id"], ["recorded_at", "batch_id"])

    def files_by_status(self, status: str) -> DataFrame:
        return self.files().where(F.col("status") == status)

    def file_exists(self, file_id: str) -> bool:
        return not self.read("files").where(F.col("file_id") == file_id).isEmpty()

    def rows(self) -> DataFrame:
        return current_rows(self.read("rows"), self.read("files"))

    def rows_by_file(self, file_id: str) -> DataFrame:
        return self.rows().where(F.col("file_id") == file_id).orderBy("line_number")

    def row(self, row_id: str) -> DataFrame:
        return self.rows().where(F.col("row_id") == row_id)

    def batch_rows(self, batch_id: str) -> DataFrame:
        """Rows of a batch: one partition folder."""
        return self.read("rows").where(F.col("batch_id") == batch_id)

    def batch(self, batch_id: str) -> DataFrame:
        found = self.read("batches").where(F.col("batch_id") == batch_id)
        return latest_per_key(found, ["batch_id"], ["recorded_at"])

    def decide(self, row_ids: DataFrame | list[str], decision: str, reviewer: str, comment: str = "") -> None:
        """Record one decision, ``approved`` or ``rejected``, for many rows."""
        if decision not in ("approved", "rejected"):
            raise ValueError(f"unknown decision: {decision}")
        if isinstance(row_ids, list):
            row_ids = self.spark.createDataFrame([(r,) for r in row_ids], "row_id string")
        self.append(
            "decisions",
            row_ids.select(
                "row_id",
                F.lit(decision).alias("decision"),
                F.lit(reviewer).alias("reviewer_id"),
                F.lit(comment).alias("comment"),
                F.current_timestamp().alias("decided_at"),
            ),
        )

    def approve_rows(self, row_ids: DataFrame | list[str], reviewer: str, comment: str = "") -> None:
        self.decide(row_ids, "approved", reviewer, comment)

    def reject_rows(self, row_ids: DataFrame | list[str], reviewer: str, comment: str = "") -> None:
        self.decide(row_ids, "rejected", reviewer, comment)

    def reviewed_rows(self) -> DataFrame:
        return effective_status(self.rows(), self.read("decisions"))
