"""Scans of one layout by Spark's own readers, JSON objects as maps, and dense row numbers.

Every scan yields ``source_path, __block`` and values; ``number_rows`` turns that into rows
with a line number without sorting or shuffling the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.records import column
from rowmill.session import scratch_path
from rowmill.sources.ranges import header_names
from rowmill.sources.records import NA_TOKENS

OVERFLOW = "__overflow"


def scan_delimited(
    spark: SparkSession,
    paths: list[str],
    header: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Rows of delimited files that share a header line; all values are texts.

    Rows with too many cells are dropped, short rows get nulls. Only files with line
    breaks inside quotes need ``multi_line``; the others are read in splits.
    """
    names = header_names(header, sep)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, OVERFLOW]])
    read = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )
    cells: list[Column] = []
    for n in names:
        c = column(n)
        cells += [F.lit(n), F.when(~c.isin(*NA_TOKENS), c)]
    return read.where(column(OVERFLOW).isNull()).select(*_place(), F.create_map(*cells).alias("raw"))


def _place() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("__block"),
    ]


def last_of_each_key(m: Column) -> Column:
    """A map with repeated keys reduced to the last value of each."""
    keys, values = F.map_keys(m), F.map_values(m)
    names = F.array_distinct(keys)
    last = F.transform(
        names,
        lambda k: F.element_at(
            values, (F.size(keys) - F.array_position(F.reverse(keys), k) + 1).cast("int")
        ),
    )
    return F.when(F.size(names) == F.size(keys), m).otherwise(F.map_from_arrays(names, last))


def parse_json_line(line: Column) -> Column:
    """``map<string,string>`` of one JSON object; null for anything else.

    Wrapped in brackets so that a second value on the line makes it invalid.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")),
        "array<map<string,string>>",
        {"allowSingleQuotes": "false"},
    )
    return F.when(F.size(parsed) == 1, F.get(parsed, 0))


def json_kinds(text: Column) -> Column:
    """Which values of a JSON object are no texts: name to number, boolean, object or array.
    Texts and nulls have no entry; an object of texts alone is not looked at again."""
    kind = F.transform_values(F.from_json(text, "map<string,variant>"), lambda _, v: F.schema_of_variant(v))
    named = F.transform_values(
        kind,
        lambda _, k: F.when(k == "BOOLEAN", "boolean").when(F.startswith(k, F.lit("OBJECT")), "object")
        .when(F.startswith(k, F.lit("ARRAY")), "array").when(~k.isin("STRING", "VOID"), "number"),
    )
    other = text.rlike(r""":\s*[^"\s]""")
    return F.when(other, F.map_filter(last_of_each_key(named), lambda _, k: k.isNotNull()))


def scan_json_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One object per line; blank, broken and other lines are skipped. Read in splits."""
    lines = spark.read.text(paths).select(*_place(), parse_json_line(F.col("value")).alias("raw"))
    return lines.where("raw IS NOT NULL").withColumn("raw", last_of_each_key(F.col("raw")))


def place_rows(scan: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """What ``number_rows`` needs of each file block: ``source_path, __block, __shift``, whether
    a record of the file ``failed``, and the columns of ``files`` for its path.

    A first pass counts the rows of each block. The running counts are written to the shared
    folder, so their size is known: Spark broadcasts them when small and joins on
    (file, block) otherwise.
    """
    spark = scan.sparkSession
    failed = F.coalesce(F.max("failed"), F.lit(False)) if "failed" in scan.columns else F.lit(False)
    blocks = _marked(scan).groupBy("source_path", "__block").agg(
        F.min("__at").alias("first"), F.count("*").alias("n"), failed.alias("failed")
    )
    whole = Window.partitionBy("source_path")
    earlier = whole.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "source_path",
        "__block",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("__shift"),
        F.max("failed").over(whole).alias("failed"),
    )
    if files is not None:
        offsets = offsets.join(files, "source_path")
    path = scratch_path(spark, "blocks")
    offsets.write.parquet(path)
    return spark.read.schema(offsets.schema).parquet(path)


def _marked(scan: DataFrame) -> DataFrame:
    return scan if "__at" in scan.columns else scan.withColumn("__at", F.monotonically_increasing_id())


def stored(scan: DataFrame) -> DataFrame:
    """The scan written to the shared folder with its order, so that counting and numbering
    its rows do not parse them twice."""
    marked = _marked(scan)
    path = scratch_path(scan.sparkSession, "records")
    marked.write.parquet(path)
    return scan.sparkSession.read.schema(marked.schema).parquet(path)


def number_rows(scan: DataFrame, places: DataFrame) -> DataFrame:
    """Add a dense ``line_number`` from 1 per file, in file order, by the counts of
    ``place_rows``. Rows are neither sorted nor collected; those of a file in which a record
    failed are left out."""
    return (
        _marked(scan).drop("failed")
        .join(places.where(~F.col("failed")).drop("failed"), ["source_path", "__block"])
        .withColumn("line_number", F.col("__at") + F.col("__shift"))
        .drop("__at", "__shift", "__block")
    )
