"""File and table scans and writes. The location is always a URI parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, location: str, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """Any file format or installed table connector (``fmt="delta"`` needs its jar)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location)


def write_table(df: DataFrame, location: str, fmt: str = "parquet", mode: str = "append",
                partition_by: tuple[str, ...] = (), **options) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(location)


def read_csv(spark: SparkSession, location: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line; types are inferred only when no schema is given."""
    if schema is None:
        return read_table(spark, location, "csv", header=True, inferSchema=True)
    return read_table(spark, location, "csv", schema, header=True)


def write_csv(df: DataFrame, location: str, mode: str = "overwrite") -> None:
    write_table(df, location, "csv", mode, header=True)


def empty_relation(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema=schema)


def read_boundaries(spark: SparkSession, location: str, name: str = "NAME_1") -> DataFrame:
    """One row per feature of a GeoJSON collection, keeping the region name only."""
    schema = T.StructType().add(
        "features", T.ArrayType(T.StructType().add("properties", T.StructType().add(name, "string"))))
    features = read_table(spark, location, "json", schema, multiLine=True)
    return features.select(F.explode("features").alias("feature")).select(
        F.col("feature.properties").getField(name).alias(name))


def select_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns and types, in the declared order."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
