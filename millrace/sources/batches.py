"""Numbered training batches and the record of those already used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import batch_number
from millrace.session import move_path, path_exists

PROCESSED = "batch_id int, modified timestamp, status string"
BATCH = ("batch_id", "modified")


def list_batches(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, path, modified) of the batches in ``folder``; contents are not read.

    A batch is one Parquet file or one folder of Parquet part files.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(folder))
    return (numbered(files, "path", "modificationTime")
            .groupBy("batch_id", "path").agg(F.max("modificationTime").alias("modified")))


def numbered(files: DataFrame, path: str = "path", *carried: str) -> DataFrame:
    """Number and batch path of each file that belongs to a numbered batch."""
    batch = F.regexp_extract(F.col(path), r"^(.*_\d+\.parquet)(/.*)?$", 1)
    return (files.select(batch_number(batch).alias("batch_id"), batch.alias("path"), *carried)
            .where("batch_id IS NOT NULL"))


def read_processed(spark: SparkSession, location: str) -> DataFrame:
    if not path_exists(spark, location):
        return spark.createDataFrame([], PROCESSED)
    return spark.read.schema(PROCESSED).parquet(location).select(*BATCH, "status")


def mark_processed(spark: SparkSession, location: str, batch_id: int, modified, status: str) -> None:
    """Written after the batch was handled, so a failed run is tried again."""
    row = spark.createDataFrame([(batch_id, modified, status)], PROCESSED)
    run = f"{batch_id}-{modified:%Y%m%dT%H%M%S}"
    row.coalesce(1).write.mode("overwrite").parquet(f"{location}/batch={run}")


def next_batch(available: DataFrame, processed: DataFrame, keys=BATCH) -> DataFrame:
    """Lowest-numbered batch not processed yet: one row, or none.

    A number used before counts as new when its file was replaced since.
    """
    waiting = available.join(processed, list(keys), "left_anti")
    return (waiting.agg(F.min_by(F.struct("*"), "batch_id").alias("batch"))
            .where("batch IS NOT NULL").select("batch.*"))


def retire_batches(spark: SparkSession, folder: str, processed: str, archive: str) -> int:
    """Move all processed batches out of ``folder``, which frees their numbers."""
    used = list_batches(spark, folder).join(
        read_processed(spark, processed), list(BATCH), "left_semi")
    moved = 0
    for batch in used.toLocalIterator():
        name = f"{batch['modified']:%Y%m%dT%H%M%S}-{batch['path'].rsplit('/', 1)[1]}"
        moved += move_path(spark, batch["path"], f"{archive}/{name}")
    return moved
