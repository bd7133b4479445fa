"""Work that goes on where it stopped: files of rows as a stream, a checkpoint folder, and a sink that overwrites a batch by its number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_rows(df: DataFrame, path: str, rows_per_file: int) -> None:
    """The rows to work on, written once in files of at most ``rows_per_file`` (SNK10): what a batch takes."""
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def work_off(
    spark: SparkSession, items: str, schema: str, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files_per_batch: int = 1, after: Callable[[int], None] | None = None
) -> None:
    """Every file of ``items`` through ``step`` into ``target``, once (SNK10, UD12).

    The checkpoint names each batch's files before it runs and marks it when it is saved. A run that is killed is started again with the same
    folders: finished batches are not looked at, and one that was under way takes the same files and overwrites its own folder, so
    that no row is lost or saved twice. Files that came meanwhile are taken, too. ``after`` is called with a batch's number once it is saved.
    """

    def save(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        if after is not None:
            after(number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(items)
    query = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def worked_off(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """What has been saved so far, with the number of its batch."""
    return spark.read.schema(schema).parquet(f"{target}/batch=*").withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("int"))
