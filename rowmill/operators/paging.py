"""Pages of an ordered listing, however deep, without sorting the whole in one place."""

from __future__ import annotations

from itertools import accumulate
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.session import scratch_path


class Pages:
    """Rows of a listing, stored in ranges of its order, with the number of rows of each.

    Made by one shuffle, in ``ranges`` tasks (``spark.sql.shuffle.partitions`` by default);
    the counts are one row a range. A page reads and sorts only the ranges that it touches,
    so its cost does not grow with its offset. The order must be total, as by an id at its
    end, for pages to be the same each time; nulls come first.
    """

    def __init__(self, df: DataFrame, order: list[str], ranges: int | None = None) -> None:
        self._spark, self._order = df.sparkSession, order
        self._part = f"range_{uuid4().hex}"
        self._columns = df.columns
        self._path = scratch_path(self._spark, "pages")
        n = ranges or int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        # finding the ranges is a pass of its own, over stored rows and not over what makes them
        once = scratch_path(self._spark, "listing")
        df.write.parquet(once)
        stored = self._spark.read.schema(df.schema).parquet(once)
        dealt = stored.repartitionByRange(n, *order).withColumn(self._part, F.spark_partition_id())
        dealt.write.partitionBy(self._part).parquet(self._path)
        self._schema = dealt.schema
        counts = self._stored().groupBy(self._part).count().orderBy(self._part).collect()
        self._ranges = [r[0] for r in counts]
        self._ends = list(accumulate(r[1] for r in counts))

    def _stored(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(self._path)

    @property
    def total(self) -> int:
        return self._ends[-1] if self._ends else 0

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """Up to ``limit`` rows from place ``offset`` on, in order; none beyond the end."""
        starts = [0, *self._ends[:-1]]
        touched = [(r, a) for r, a, b in zip(self._ranges, starts, self._ends) if a < offset + limit and b > offset]
        skipped = offset - touched[0][1] if touched else 0
        rows = self._stored().where(F.col(self._part).isin([r for r, _ in touched]))
        return rows.orderBy(*self._order).offset(skipped).limit(limit).select(*self._columns)
