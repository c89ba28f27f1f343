"""What the operators share on the Spark side: tables, written steps, bounded filters."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.session import scratch_path

FILTER_BITS = 26
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes within, and frames made and collected within, have Spark remove their shuffle files when they end, not when the driver's
    collector comes to them: so a chain of steps takes the disk of its largest one, not of all.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a step as Parquet in the shared folder and read it again.

    Cuts the lineage: what is read afterwards survives the loss of executors, is not
    computed twice, and row ids made before it stay as they are. The step's shuffles go with it.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_filter(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap over the top bits of 64-bit hashes, for use inside tasks.

    Its size is fixed (2**bits bits, 8 MB by default) however many hashes there are: more
    of them let more rows pass, and no result depends on it, since whatever passes is
    matched exactly afterwards.
    """
    spot = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    with shuffles_freed(hashes.sparkSession):
        rows = (
            hashes.where(F.col(column).isNotNull())
            .select(F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit"))
            .groupBy("bucket")
            .agg(F.bitmap_construct_agg("bit").alias("map"))
            .collect()
        )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["map"], np.uint8)
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    spot = hashes >> np.uint64(64 - bits)
    return (bitmap[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def components(links: DataFrame) -> DataFrame:
    """Connected components of (a, b) links between long ids: one (id, component) row for
    each linked id, the component being its smallest id.

    Each round moves every id to the least label around it and then to that label's own
    label, so chains shorten quickly. Rounds are written to the shared folder; only one
    count a round comes to the driver.
    """
    both = written(
        links.select("a", "b").where("a <> b").union(links.selectExpr("b AS a", "a AS b").where("a <> b")).distinct(),
        "links",
    )
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        around = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(around, "id").select("id", "label", F.least("label", "near").alias("next"))
        up = lower.select(F.col("id").alias("next"), F.col("next").alias("top"))
        moved = written(
            lower.join(up, "next").select("id", "label", F.least("next", "top").alias("after")),
            "labels",
        )
        labels = moved.select("id", F.col("after").alias("label"))
        if moved.where("label <> after").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
