"""New training batches as a stream, each starting a training run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import batch_number


def training_files(spark: SparkSession, folder: str, schema: T.StructType,
                   archive_to: str | None = None) -> DataFrame:
    """Rows of new batches with ``batch_id`` from the batch's name.

    A batch is one Parquet file or one folder of part files, which appears complete (written
    elsewhere and renamed). With ``archive_to`` used files are moved there afterwards.
    """
    reader = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet"))
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*_\d+\.parquet)(/.*)?$", 1)
    return reader.parquet(folder).withColumn("batch_id", batch_number(batch))


def start_retraining(files: DataFrame, train, checkpoint: str) -> StreamingQuery:
    """Call ``train(rows, batch_id)`` once for each batch that is new, in order, then stop.

    Numbers come from file names: the rows are not read to learn them. Files without a
    number are left alone.
    """
    def run(rows: DataFrame, _: int) -> None:
        found = rows.select("batch_id").distinct().where("batch_id IS NOT NULL").collect()
        for number in sorted(r[0] for r in found):
            train(rows.where(F.col("batch_id") == number).drop("batch_id"), number)

    return (files.writeStream.foreachBatch(run).trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start())
