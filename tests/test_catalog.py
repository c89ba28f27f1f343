"""Every registered query is named once, and most state their result in SQL."""

import __spark_entry__ as entry


def test_catalog():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert len(sql) >= 100


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total_rows == row.valid_rows + row.flagged_rows > 0
