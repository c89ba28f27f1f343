"""Written steps: what they leave on the executors' disks."""

import time

from pyspark.sql import functions as F

from rowmill.llm.frames import bit_filter, written

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(KEY)
    rows = spark.range(10000).select((F.col("id") % 100).alias("k"), F.xxhash64("id").alias("h"))
    assert len(written(rows.repartition(5, "k").groupBy("k").count(), "step").collect()) == 100
    kept = written(rows.repartition(5, "h"), "step")
    assert bit_filter(kept, "h").any()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(KEY) == setting
