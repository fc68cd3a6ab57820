"""Parquet folders dealt into buckets by a hash of some columns.

A join on these columns reads bucket by bucket: the stored side is not shuffled, however large.
Spark knows the buckets from its catalog, so a folder is registered under a name derived from
its path in every session that reads it; the files are the only state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import delete_path, path_exists


def bucket_count(spark: SparkSession) -> int:
    """As many as the session shuffles into, so that a join keeps to the buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class BucketedFolder:
    """One folder. ``by`` are the bucketed columns; ``part`` may name a string column that
    makes a sub-folder per value, each replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: list[str],
                 buckets: int, part: str | None = None):
        self.spark, self.path, self.by, self.buckets, self.part = spark, path.rstrip("/"), by, buckets, part
        fields = [*schema.fields, T.StructField(part, T.StringType())] if part else schema.fields
        self.schema = T.StructType(fields)
        # 128 bits of the path, so that folders do not share a name.
        self.name = f"bucketed_{hashlib.md5(self.path.encode()).hexdigest()}"

    def forget(self) -> None:
        """Take the folder out of the catalog; files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def read(self) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        by = ", ".join(f"`{c}`" for c in self.by)
        part = f"PARTITIONED BY (`{self.part}`)" if self.part else ""
        self.forget()
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet {part} "
                       f"CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        if self.part:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.spark.table(self.name)

    def write(self, rows: DataFrame, value: str | None = None) -> None:
        """Replace the folder, or the sub-folder of ``value``: one file per bucket."""
        target = f"{self.path}/{self.part}={value}" if self.part else self.path
        if path_exists(self.spark, target):
            delete_path(self.spark, target)
        if self.part:
            rows = rows.withColumn(self.part, F.lit(value))
        self.forget()
        writer = (rows.select(*[F.col(f"`{c}`") for c in self.schema.names])
                  .repartition(self.buckets, *[F.col(f"`{c}`") for c in self.by])
                  .write.format("parquet").bucketBy(self.buckets, *self.by)
                  .option("path", self.path))
        if self.part:
            # Into the registered folder, beside the other sub-folders.
            if path_exists(self.spark, self.path):
                self.read()
            writer.partitionBy(self.part).mode("append").saveAsTable(self.name)
        else:
            writer.mode("overwrite").saveAsTable(self.name)
