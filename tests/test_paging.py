"""Pages from stored ranges against a plain sorted list."""

import pytest
from pyspark.sql import functions as F

from rowmill.operators.paging import Pages


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_pages_of_any_depth(spark, ranges):
    df = spark.range(2000).repartition(7).select(
        F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("file_id"), (F.col("id") * 7 % 11).alias("line"), "id"
    )
    want = sorted(rows_of(df), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    pages = Pages(df, ["file_id", "line", "id"], ranges)
    assert pages.total == 2000
    for limit, offset in [(10, 0), (100, 950), (700, 1100), (5, 1998), (3, 2000), (3, 9999), (0, 5), (2000, 0)]:
        assert rows_of(pages.page(limit, offset)) == want[offset : offset + limit], (limit, offset)


def test_only_the_ranges_of_a_page_are_read(spark):
    pages = Pages(spark.range(10000).select("id"), ["id"], 20)
    page = pages.page(10, 5000)
    assert rows_of(page) == [(i,) for i in range(5000, 5010)]
    plan = page._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert pages._part in filters


def test_repeated_rows_and_empty_listings(spark):
    pages = Pages(spark.createDataFrame([(1,)] * 9 + [(None,)], "v int"), ["v"], 4)
    assert rows_of(pages.page(3)) == [(None,), (1,), (1,)] and rows_of(pages.page(5, 8)) == [(1,), (1,)]
    empty = Pages(spark.createDataFrame([], "v int, `range` string"), ["v"], 4)
    assert empty.total == 0 and rows_of(empty.page(5)) == [] and empty.page(5).columns == ["v", "range"]


def test_input_is_computed_once(spark):
    """Finding the ranges of the order must not make the rows a second time."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(500, numPartitions=4).mapInPandas(count, "id long")
    assert Pages(rows, ["id"], ranges=3).total == 500
    assert seen.value == 500
