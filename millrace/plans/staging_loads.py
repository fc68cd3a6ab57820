"""Job: raw CSV tables to staging, and staged rows to the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.staging import (absent, added_counts, hourly_clicks, monthly_trend, new_by_index,
                                        new_rows, star_target, transformed_source, with_fingerprint)
from millrace.schemas import LONG, STAGING_TABLES, struct
from millrace.session import child_names, delete_path, path_exists, settle
from millrace.sources.buckets import BucketedFolder, bucket_count
from millrace.sources.jdbc import Database, ReadSplit, read_jdbc, write_jdbc
from millrace.sources.published import PublishedRuns
from millrace.sources.tables import empty_relation, read_csv, select_schema

MODES = ("append_new", "replace")


_PRINTS = struct(__h1=LONG, __h2=LONG)


class FolderStaging:
    """Staging tables as Parquet folders, one sub-folder per run.

    Run names must sort in time order. A run may be repeated: it never compares
    with its own earlier output, and replaces it. Beside each table an index keeps the
    fingerprints of its rows, by run and in buckets; differences are taken from it alone.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets`` of new indexes: by default as many as the session shuffles into."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def read(self, table: str, schema, mode: str = "append_new", without: str | None = None) -> DataFrame:
        """All staged rows; in ``replace`` mode those of the last run that had any."""
        if not path_exists(self.spark, f"{self.root}/{table}"):
            return empty_relation(self.spark, schema)
        return self._chosen(self._runs(table, schema), mode, without)

    def index(self, table: str, schema, mode: str = "append_new", without: str | None = None) -> DataFrame:
        """Fingerprints of what ``read`` returns. Runs that have none yet are read for them."""
        folder = self._index(table)
        for run in self._named(table) - self._named(f"_index/{table}/n={folder.buckets}") - {without}:
            rows = self._runs(table, schema).where(F.col("run") == run).drop("run")
            folder.write(with_fingerprint(rows), run)
        if not path_exists(self.spark, folder.path):
            return empty_relation(self.spark, _PRINTS)
        return self._chosen(folder.read(), mode, without)

    def stage(self, raw: DataFrame, table: str, run: str, mode: str) -> DataFrame:
        """The index of a run goes before its rows change and comes after, so it never tells
        of rows that are not there."""
        target, folder = f"{self.root}/{table}/run={run}", self._index(table)
        fresh = new_by_index(raw, self.index(table, raw.schema, mode, without=run))
        there = path_exists(self.spark, target)
        if not there and fresh.isEmpty():
            return empty_relation(self.spark, raw.schema)
        if there:
            delete_path(self.spark, f"{folder.path}/run={run}")
        fresh.write.mode("overwrite").parquet(target)
        stored = self.spark.read.schema(raw.schema).parquet(target)
        folder.write(with_fingerprint(stored), run)
        return stored

    def _runs(self, table, schema):
        return (self.spark.read.schema(StructType([*schema.fields, StructField("run", StringType())]))
                .parquet(f"{self.root}/{table}"))

    def _chosen(self, runs, mode, without):
        if without is not None:
            runs = runs.where(F.col("run") != without)
        if mode == "replace":
            last = runs.agg(F.max("run")).first()[0]
            runs = runs.where(F.col("run") == F.lit(last))
        return runs.drop("run")

    def _named(self, folder):
        """Runs that have a sub-folder: control data."""
        return {n.split("=", 1)[1] for n in child_names(self.spark, f"{self.root}/{folder}") if n.startswith("run=")}

    def _index(self, table):
        path = f"{self.root}/_index/{table}"
        made = [int(n[2:]) for n in child_names(self.spark, path) if n.startswith("n=")]
        buckets = min(made) if made else self.buckets or bucket_count(self.spark)
        return BucketedFolder(self.spark, f"{path}/n={buckets}", _PRINTS, ["__h1", "__h2"], buckets, "run")


class JdbcStaging:
    """Staging tables in a database. ``splits`` names the range each table is read by;
    a table without one would come through a single task and is refused."""

    def __init__(self, spark: SparkSession, database: Database, splits: dict[str, ReadSplit]):
        self.spark, self.database, self.splits = spark, database, splits

    def read(self, table: str, schema) -> DataFrame:
        if table not in self.splits:
            raise ValueError(f"no read split for {table}")
        stored = read_jdbc(self.spark, self.database, table, self.splits[table])
        return select_schema(stored, schema)

    def stage(self, raw: DataFrame, table: str, run: str, mode: str) -> DataFrame:
        """The difference is settled before the table it was taken from is written."""
        fresh = settle(new_rows(raw, self.read(table, raw.schema)))
        if not fresh.isEmpty():
            write_jdbc(fresh, self.database, table,
                       "append" if mode == "append_new" else "overwrite")
        return fresh


def stage(raw: DataFrame, staging, table: str, run: str, mode: str = "append_new") -> DataFrame:
    """Stage the rows of ``raw`` not staged yet and return them as stored.

    ``append_new`` adds them, ``replace`` leaves only them; without any new row
    the table stays as it is.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return staging.stage(raw, table, run, mode)


def stage_csv(spark: SparkSession, folder: str, staging, run: str,
              mode: str = "append_new") -> dict[str, DataFrame]:
    """Stage all four raw tables; the result maps each to its new rows."""
    return {table: stage(read_csv(spark, f"{folder.rstrip('/')}/{table}.csv", schema),
                         staging, table, run, mode)
            for table, schema in STAGING_TABLES.items()}


def load_transformed(read, write) -> None:
    """Append each transformed table to its star target: ``write(read(source), target)``."""
    for table in STAGING_TABLES:
        write(read(transformed_source(table)), star_target(table))


def load_star(fresh: dict[str, DataFrame], write, loaded=None) -> dict[str, str]:
    """Append each table's new rows to its star target: ``write(rows, target)``.

    ``loaded(target)`` may return what a target holds already; rows that are there as they
    are get left out, so a repeated load adds nothing and a changed row is added. Nothing
    is written where nothing is new.
    """
    targets = {}
    for table, rows in fresh.items():
        target = star_target(table)
        if loaded is not None:
            rows = settle(absent(rows, loaded(target)))
        if loaded is None or not rows.isEmpty():
            write(rows, target)
        targets[table] = target
    return targets


def star_writer(spark: SparkSession, root: str, run: str):
    """A ``write`` for ``load_star`` and ``load_transformed`` whose targets are published run by
    run: a repeated load leaves every row once and reads no target."""
    def write(rows: DataFrame, target: str) -> None:
        PublishedRuns(spark, f"{root.rstrip('/')}/{target}").append(rows, run)
    return write


class Trends:
    """Monthly and hourly counts kept up to date: each staging run adds the counts of its own rows.

    Runs may come in any order, with rows of any month. A run that is repeated replaces its
    counts. Reading adds up one small table per run; staged rows are never read.
    """

    MONTHLY, HOURLY = "month date, orders bigint, clicks bigint", "hour int, clicks bigint"

    def __init__(self, spark: SparkSession, root: str):
        self._monthly = PublishedRuns(spark, f"{root.rstrip('/')}/monthly")
        self._hourly = PublishedRuns(spark, f"{root.rstrip('/')}/hourly")

    def add(self, run: str, orders: DataFrame, order_time: str, clicks: DataFrame, click_time: str) -> None:
        """Count the new rows of ``run``, as ``stage`` returned them."""
        self._monthly.replace(monthly_trend(orders, order_time, clicks, click_time).coalesce(1), run)
        self._hourly.replace(hourly_clicks(clicks, click_time).coalesce(1), run)

    def monthly(self) -> DataFrame:
        return added_counts(self._monthly.read(self.MONTHLY), "month")

    def hourly(self) -> DataFrame:
        return added_counts(self._hourly.read(self.HOURLY), "hour")
