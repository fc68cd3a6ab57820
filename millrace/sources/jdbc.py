"""Database tables over JDBC. Drivers and credentials come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str
    password: str = field(repr=False)

    def options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "dbtable": table,
                "user": self.user, "password": self.password}


@dataclass(frozen=True)
class ReadSplit:
    """How a large table is cut into parallel range reads."""
    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.lower,
                "upperBound": self.upper, "numPartitions": str(self.partitions)}


def read_jdbc(spark: SparkSession, database: Database, table: str,
              split: ReadSplit | None = None, fetch_size: int = 10_000) -> DataFrame:
    options = {**database.options(table), "fetchsize": str(fetch_size)}
    if split:
        options |= split.options()
    return spark.read.format("jdbc").options(**options).load()


def warehouse_writer(database: Database, mode: str = "append", **settings):
    """``write(rows, table)`` for the load jobs."""
    return lambda rows, table: write_jdbc(rows, database, table, mode, **settings)


def write_jdbc(df: DataFrame, database: Database, table: str, mode: str = "append",
               connections: int = 64, batch_size: int = 10_000) -> None:
    """``connections`` bounds the parallel writers so the database survives the load."""
    (df.write.format("jdbc")
       .options(**database.options(table), batchsize=str(batch_size),
                numPartitions=str(connections))
       .mode(mode).save())
