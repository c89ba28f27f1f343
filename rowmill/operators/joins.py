"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


def spread_lookup(
    rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join rows to a side that has at most one row per key.

    The side is repeated once per salt and the rows are dealt over the salts, so a
    hot key is split over ``salts`` tasks. No hint is given: where the side is small
    by measured size Spark broadcasts it, beyond that the salted shuffle is used.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    dealt = rows.withColumn(
        SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _hashable(rows)]), F.lit(salts)).cast("int")
    )
    repeated = side.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated, [*on, SALT], how).drop(SALT)


def lookup(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join rows to a side of many keys that has at most one row per key.

    The side is not repeated, so its measured size is what a broadcast takes of the driver;
    beyond that size both are shuffled, and Spark splits the tasks of hot keys
    (``spark.sql.adaptive.skewJoin``, on by default).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    return rows.join(side, on, how)


def _hashable(df: DataFrame) -> list[str]:
    """Columns to deal rows by; maps cannot be hashed."""
    flat = [n for n, t in df.dtypes if not t.startswith(("map", "array", "struct", "variant"))]
    return flat or df.columns
