"""Intake: all files of a listing as rows with a stable identity."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.session import cut_lineage
from rowmill.sources.listing import one_per_content
from rowmill.sources.ranges import PARTITION_BYTES
from rowmill.sources.records import RECORDS, read_ranges
from rowmill.sources.scan import json_kinds, last_of_each_key, number_rows, parse_json_line, place_rows, stored

SUPPORTED = ("csv", "tsv", "json", "jsonl", "xml")
ROWS = (
    "row_id string, file_id string, line_number bigint, source_name string, "
    "raw map<string,string>, raw_kinds map<string,string>, status string"
)


class Intake(NamedTuple):
    """Rows, and ``file_id, error_message`` of the files that could not be read."""

    rows: DataFrame
    problems: DataFrame


def unsupported_files(files: DataFrame) -> DataFrame:
    """Files no scan exists for, with the reason."""
    return files.where(~F.col("format").isin(*SUPPORTED)).withColumn(
        "error_message", F.concat(F.lit("Unsupported format: "), F.col("format"))
    )


def records(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``source_path, __block, names, cells, object, kinds, failed`` of all records of the files, in
    one scan for every format, header and encoding.

    Byte ranges are dealt over tasks, in order within each, so that a second run deals them
    alike. A line that is no JSON object is left out; an element of a JSON array that is no
    JSON, or of an XML document that is not well-formed, is marked as failed.
    """
    size = files.agg(F.sum("size_bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))
    dealt = (
        files.select("path", "kind", "format", "encoding", "row_tag", "body", F.size("columns").alias("width"), F.inline("ranges"))
        .repartition(tasks, "path", "at")
        .sortWithinPartitions("path", "at")
    )
    found = dealt.mapInArrow(read_ranges, RECORDS)
    parsed = found.withColumn("object", parse_json_line(F.col("text"))).where("failed OR text IS NULL OR whole OR object IS NOT NULL")
    no_json = F.col("text").isNotNull() & F.col("object").isNull() & F.try_parse_json("text").isNull()
    judged = parsed.withColumn("failed", F.col("failed") | no_json).where("failed OR text IS NULL OR object IS NOT NULL")
    return judged.select(
        "source_path", "__block", "names", "cells", last_of_each_key(F.col("object")).alias("object"),
        json_kinds(F.col("text")).alias("kinds"), "failed",
    )


def read_files(spark: SparkSession, files: DataFrame) -> Intake:
    """Rows of all supported files of a listing, whatever their number of layouts, in the same
    few jobs; the names of a file's columns come by the join that numbers its rows. Records are
    parsed once and stored.

    ``raw`` has the values as texts, ``raw_kinds`` what JSON had those as that are no texts.

    Of a file with a failed record no row is returned; it is named with the reason, like
    those that the listing found broken and those of no supported format.
    """
    listed = cut_lineage(one_per_content(files))
    usable = listed.where(F.col("kind").isNotNull() & F.col("problem").isNull()).where("kind <> 'delimited' OR columns IS NOT NULL")
    scan = stored(records(spark, usable))
    places = place_rows(scan, usable.select("source_path", "file_id", F.col("filename").alias("source_name"), "columns", "kind"))
    by_name = F.map_from_arrays(F.coalesce("names", "columns"), F.col("cells"))
    rows = number_rows(scan, places).select(
        F.concat_ws("_", "file_id", F.col("line_number").cast("string")).alias("row_id"),
        "file_id",
        "line_number",
        "source_name",
        F.coalesce("object", by_name).alias("raw"),
        F.col("kinds").alias("raw_kinds"),
        F.lit("pending").alias("status"),
    )
    reason = F.concat(F.lit("Cannot be parsed as "), F.when(F.col("kind") == "xml", "XML").otherwise("a JSON array"))
    problems = (
        unsupported_files(listed).select("file_id", "error_message")
        .union(listed.where("problem IS NOT NULL").select("file_id", "problem"))
        .union(places.where("failed").select("file_id", reason).distinct())
    )
    return Intake(rows, problems)


def read_rows(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of all files that can be read."""
    return read_files(spark, files).rows
