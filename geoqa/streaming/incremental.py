"""Triggered incremental execution of a check over newly arrived files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def run_incremental(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                    check: Callable[[DataFrame], DataFrame], sink_dir: str,
                    checkpoint_location: str, max_files_per_trigger: int | None = None) -> None:
    """Run ``check`` on every Parquet file that arrived in ``source_dir``
    since the last run, write its anomalies under ``sink_dir/epoch=N`` and
    stop.  Each micro-batch overwrites its own epoch folder, so a retried
    batch replaces (never duplicates) its output; the stream checkpoint
    (in shared storage, the same for every run) records which files were
    processed."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def batch(df: DataFrame, epoch_id: int) -> None:
        check(df).write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/epoch={epoch_id}")

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
