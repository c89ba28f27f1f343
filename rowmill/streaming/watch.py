"""Watching a folder: new files run through the same transforms as a batch."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def watch_folder(
    spark: SparkSession,
    path: str,
    schema: Any,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    format: str = "parquet",
    options: dict[str, Any] | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Process files as they appear; ``once`` takes what is there and stops.

    Each micro-batch goes to its own folder, overwritten on a retry, so that a batch
    repeated after a failure leaves no double rows. The checkpoint makes a second run
    over the same files do nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{output}/micro_batch={number}")

    stream = spark.readStream.format(format).schema(schema).options(**(options or {})).load(path)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
