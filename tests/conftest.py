import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rowmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 4, "tests")


@pytest.fixture()
def apply(spark):
    """Values of a column function over a list of texts, in order."""

    def run(values, function, dtype="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {dtype}")
        from pyspark.sql import functions as F

        return [r.o for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
