"""File discovery: identity, format, encoding and layout of every file in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.sources.ranges import RANGE_BYTES, folded, ranges


def list_files(spark: SparkSession, folder: str, format: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per file: path, name, size, time, content id, format, encoding, layout.

    Files are read once, in byte ranges of ``range_bytes`` that may be in different tasks; no
    task holds more than one. The content id is the SHA-256 of the bytes for a file of one
    range, else the SHA-256 of the ranges' digests in order. ``problem`` says why a JSON
    array or an XML document cannot be parsed. ``ranges`` has the state that each range
    begins in, for reading rows from it by itself. ``format`` is taken for all files
    whatever their names.
    """
    return folded(ranges(spark, folder, format, range_bytes))


def one_per_content(files: DataFrame) -> DataFrame:
    """The same bytes under several names are one file: the one of the least path."""
    first = F.min_by(F.struct(*[c for c in files.columns if c != "file_id"]), "path")
    return files.groupBy("file_id").agg(first.alias("f")).select("file_id", "f.*").select(*files.columns)
