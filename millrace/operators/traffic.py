"""Traffic per state and its fill over all known regions.

Both join sides hold one row per state, so these joins carry no hint: the
aggregate is already partitioned by state and has no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def traffic_by_state(events: DataFrame) -> DataFrame:
    """Known events per state: event rows, not distinct users."""
    return events.groupBy("state").agg(F.count("event").alias("app_traffic"))


def traffic_by_user_state(events: DataFrame, users: DataFrame) -> DataFrame:
    """The same for events that carry a user only, its state known to ``users``.

    Events are counted per user first: the join then moves one row per user, and
    a user with very many events is no more work than any other.
    """
    per_user = events.groupBy("user_id").agg(F.count("event").alias("n"))
    placed = per_user.join(users.withColumnRenamed("user_id", "__user"),
                           F.col("user_id") == F.col("__user"), "left")
    return placed.groupBy("state").agg(F.sum("n").alias("app_traffic"))


def fill_regions(regions: DataFrame, traffic: DataFrame, name: str = "NAME_1") -> DataFrame:
    """Every region once, 0 without traffic; traffic of unknown states falls out."""
    filled = regions.join(traffic, regions[name] == traffic["state"], "left").drop("state")
    return filled.withColumn("app_traffic", F.coalesce("app_traffic", F.lit(0)))


def unmatched_states(regions: DataFrame, traffic: DataFrame, name: str = "NAME_1") -> DataFrame:
    return traffic.join(regions, traffic["state"] == regions[name], "left_anti")


def scale_domain(traffic: DataFrame) -> DataFrame:
    return traffic.agg(F.min("app_traffic").alias("low"), F.max("app_traffic").alias("high"))
