"""Tables made of runs, each published by one row of a ledger once its files are complete."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import child_names, delete_path, path_exists
from millrace.sources.tables import empty_relation

_LEDGER = "run string, version int, attempt string, at timestamp"


class PublishedRuns:
    """A Parquet table below ``root``: a folder of files per attempt at a run, and the ledger.

    An attempt counts from the moment its ledger row is there, which is one file. A load that
    dies before leaves files nobody reads; the same run can be loaded again. Of two loads of
    one run at a time the first row in the ledger counts. The ledger has a row per run: it is
    control data, and the only thing a load reads besides its own rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def published(self) -> dict[str, tuple[int, str]]:
        """(version, attempt) that counts, by run."""
        if not path_exists(self.spark, f"{self.root}/ledger"):
            return {}
        rows = self.spark.read.schema(_LEDGER).parquet(f"{self.root}/ledger")
        last = F.min_by(F.struct("version", "attempt"), F.struct(-F.col("version"), "at", "attempt"))
        return {r["run"]: tuple(r["last"]) for r in rows.groupBy("run").agg(last.alias("last")).collect()}

    def append(self, rows: DataFrame, run: str) -> bool:
        """Load ``rows`` as ``run``; nothing is computed or written if the run is published."""
        if run in self.published():
            return False
        self.publish(run, self.write(rows))
        return True

    def replace(self, rows: DataFrame, run: str) -> None:
        """Load ``rows`` as ``run`` in place of what it was before; readers see one or the other."""
        version = self.published().get(run, (-1, ""))[0] + 1
        self.publish(run, self.write(rows), version)

    def write(self, rows: DataFrame) -> str:
        """The files of a new attempt, which nobody reads yet."""
        attempt = uuid.uuid4().hex
        rows.write.parquet(self._files(attempt))
        return attempt

    def publish(self, run: str, attempt: str, version: int = 0) -> None:
        row = self.spark.createDataFrame([(run, version, attempt)], "run string, version int, attempt string")
        (row.withColumn("at", F.current_timestamp()).coalesce(1)
            .write.mode("append").parquet(f"{self.root}/ledger"))

    def read(self, schema: T.StructType | str) -> DataFrame:
        """The rows of all published runs; an empty table without any."""
        folders = [self._files(attempt) for _, attempt in self.published().values()]
        if not folders:
            return empty_relation(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def vacuum(self) -> int:
        """Delete attempts that do not count, while no load is running; their number."""
        counting = {attempt for _, attempt in self.published().values()}
        names = child_names(self.spark, f"{self.root}/attempts")
        gone = [n for n in names if n.split("=", 1)[-1] not in counting]
        for name in gone:
            delete_path(self.spark, f"{self.root}/attempts/{name}")
        return len(gone)

    def _files(self, attempt):
        return f"{self.root}/attempts/attempt={attempt}"
