"""Session helpers: settings and the shared folder for cut lineage and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rowmill") -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")  # small tables join as large ones do
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings for wide record expressions, where the user set none.

    The JVM never compiles methods over 8000 bytes of bytecode; Spark is told to split
    such stages instead of running them interpreted.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent on a local master (a test on one machine) a
    temporary folder is made and used for the rest of the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = getattr(context, "_rowmill_dir", None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="rowmill-")
        context._rowmill_dir = fallback
        context.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path in the shared folder."""
    return f"{shared_dir(spark)}/rowmill-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
