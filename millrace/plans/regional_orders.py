"""Job: regional order payloads to landing, archive and warehouse."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.orders import clean_orders, regions_complete
from millrace.schemas import LANDED_ORDER
from millrace.session import path_exists
from millrace.sources.published import PublishedRuns
from millrace.sources.regions import (Region, archive, as_variant, declared_fields, envelope_items,
                                      land, read_landing, read_raw, region_of, undeclared_fields)


def land_payloads(payloads: dict[str, DataFrame], regions: list[Region], store: str) -> None:
    """Land each region's raw orders; ``payloads`` holds its JSON responses in ``value``."""
    for region in regions:
        land(envelope_items(payloads[region.datakey], region.datakey), region.landing(store))


def _raw(spark: SparkSession, regions: list[Region], store: str) -> DataFrame:
    """Raw orders (value, datakey) of the regions that landed, in one scan."""
    found = [r.landing(store) for r in regions if path_exists(spark, r.landing(store))]
    if not found:
        return spark.createDataFrame([], "value string, datakey string")
    return read_raw(spark, found).select("value", region_of(F.col("path"), regions).alias("datakey"))


def archive_landing(spark: SparkSession, regions: list[Region], store: str, run_ts: str) -> None:
    """Copy the raw orders of all regions of a bucket into this run's snapshot, every field kept."""
    for _, group in _grouped(regions, lambda r: r.bucket):
        archive(_raw(spark, group, store).withColumn("run_ts", F.lit(run_ts)), group[0].archive(store))


def parse_landing(spark: SparkSession, regions: list[Region], store: str, location: str) -> DataFrame:
    """Parse the landing files of all regions once, into ``location``: rows (datakey, item, unread).

    ``curated`` and ``drift`` read these VARIANT values; no text is parsed again.
    """
    as_variant(_raw(spark, regions, store)).write.mode("overwrite").parquet(location)
    return spark.read.parquet(location)


def curated(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Curated orders from parsed landing files; an unread item is a row of NULLs."""
    return clean_orders(declared_fields(parsed, LANDED_ORDER), strict)


def drift(parsed: DataFrame) -> DataFrame:
    """What each region sends beside, or other than, the declared fields."""
    return undeclared_fields(parsed, "datakey", LANDED_ORDER)


def landing_status(spark: SparkSession, regions: list[Region], store: str) -> DataFrame:
    """Which regions delivered and which are missing, from one scan over all of them."""
    return regions_complete(_raw(spark, regions, store), "datakey", [r.datakey for r in regions])


def check_landing(spark: SparkSession, regions: list[Region], store: str) -> bool:
    """Whether every region delivered; no region is loaded otherwise."""
    return landing_status(spark, regions, store).first()["complete"]


def transform(spark: SparkSession, regions: list[Region], store: str,
              strict: bool = False) -> DataFrame:
    """Curated orders of all regions: one scan over their landing files."""
    return clean_orders(read_landing(spark, [r.landing(store) for r in regions]), strict)


def load_warehouse(spark: SparkSession, regions: list[Region], store: str, write,
                   strict: bool = False) -> None:
    """Append each target table once: ``write(rows, database, table)``."""
    for (database, table), group in _grouped(regions, lambda r: (r.database, r.table)):
        write(transform(spark, group, store, strict), database, table)


def warehouse_writer(spark: SparkSession, root: str, run_ts: str):
    """A ``write`` whose target tables are published run by run: a run that is repeated, also
    after it died half-way, leaves every row once and reads no target."""
    def write(rows: DataFrame, database: str, table: str) -> None:
        PublishedRuns(spark, f"{root.rstrip('/')}/{database}/{table}").append(rows, run_ts)
    return write


def run(spark: SparkSession, payloads: dict[str, DataFrame], regions: list[Region],
        store: str, run_ts: str, write) -> bool:
    land_payloads(payloads, regions, store)
    if not check_landing(spark, regions, store):
        return False
    archive_landing(spark, regions, store, run_ts)
    load_warehouse(spark, regions, store, write)
    return True


def _grouped(regions, key):
    for value, group in groupby(sorted(regions, key=key), key=key):
        yield value, list(group)
