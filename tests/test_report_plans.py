"""Plans of reports: what is sorted."""

import contextlib
import io

from pyspark.sql import functions as F

from rowmill.operators import report
from rowmill.operators.validate import validate

RULES = {"field_validation_rules": [{"field": "a", "rule_type": "required"}]}


def _validated(spark):
    rows = [(f"r{i}", f"f{i % 3}", i, None if i % 2 else "x", str(i)) for i in range(60)]
    return validate(spark.createDataFrame(rows, "row_id string, file_id string, line_number int, a string, b string"), RULES)


def test_flagged_sample_is_no_global_sort(spark):
    data = F.col("canonical_data")
    cells = [F.try_element_at(data, F.lit(n)).alias(n) for n in ("a", "b")]
    sample = report.flagged_sample(_validated(spark), 4).select("row_id", "line_number", *cells, F.size("errors").alias("n"))
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        sample.explain()
    assert "TakeOrderedAndProject" in plan.getvalue() and "rangepartitioning" not in plan.getvalue()
    assert [tuple(r) for r in sample.collect()] == [(f"r{i}", i, None, str(i), 1) for i in (3, 9, 15, 21)]


def test_flagged_sample_reads_what_can_be_first(spark, tmp_path):
    """The bound is a filter at the scan, and rows without a file or line still come first."""
    rows = [(f"r{i}", None if i in (501, 502) else f"f{i % 5}", None if i in (100, 101) else i, None if i % 2 else "x") for i in range(2000)]
    spark.createDataFrame(rows, "row_id string, file_id string, line_number int, a string").write.parquet(f"{tmp_path}/rows")
    checked = validate(spark.read.parquet(f"{tmp_path}/rows"), RULES)
    order = lambda r: tuple((c is not None, c) for c in (r[1], r[2], r[0]))
    flagged = [(r[0], r[2]) for r in sorted((r for r in rows if r[3] is None), key=order)]
    for n in (1, 4, 150):
        sample = report.flagged_sample(checked, n, spread=4)
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "LessThan(file_id" in plan.split("PushedFilters")[1]
        assert [(r.row_id, r.line_number) for r in sample.collect()] == flagged[:n]
    assert len(report.flagged_sample(checked, 1500, spread=4).collect()) == 1000
