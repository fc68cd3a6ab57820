"""Staging: the rows a source has and the staging table lacks, and the star targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import BROADCAST_ROWS, fits_broadcast
from millrace.session import settle

# Source table -> warehouse table.
STAR_TARGETS = {
    "users": "dim_users",
    "products": "dim_products",
    "orders": "fact_orders",
    "clickstream": "fact_clicks",
}


def star_target(table: str) -> str:
    return STAR_TARGETS.get(table, f"dim_{table}")


def transformed_source(table: str) -> str:
    return f"T{table}"


def new_rows(raw: DataFrame, staged: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct rows of ``raw`` that ``staged`` lacks; NULLs compare equal.

    The distinct new side is settled and measured. If it fits, it is broadcast over one scan
    of ``staged``, whose rows stay where they are. Two large sides are grouped together:
    copies collapse before the shuffle, so no repeated row makes one task heavy.
    """
    columns = raw.columns
    staged = staged.toDF(*columns)
    fresh = settle(raw.distinct())
    if fits_broadcast(fresh, max_rows):
        here, there = fresh.alias("here"), staged.alias("there")
        same = reduce(lambda a, b: a & b, [
            F.col(f"there.`{c}`").eqNullSafe(F.col(f"here.`{c}`")) for c in columns])
        return fresh.subtract(there.join(F.broadcast(here), same, "left_semi"))
    both = fresh.withColumn("__staged", F.lit(False)).union(staged.withColumn("__staged", F.lit(True)))
    grouped = both.groupBy(*[F.col(f"`{c}`") for c in columns])
    return (grouped.agg(F.max("__staged").alias("__staged"))
            .where("NOT __staged").drop("__staged"))


def with_fingerprint(rows: DataFrame) -> DataFrame:
    """Add ``__h1`` and ``__h2``: 128 bits of all columns by position, equal where rows are
    (NULLs, NaNs and zeros of either sign as in ``distinct``). Two of a thousand billion
    different rows share them with a chance below 1e-14."""
    told = [x for c in rows.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return rows.withColumns({"__h1": F.xxhash64(*told), "__h2": F.xxhash64(F.lit(1), *told)})


def new_by_index(raw: DataFrame, index: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Distinct rows of ``raw`` whose fingerprint ``index`` (__h1, __h2) lacks.

    Staged rows are not read. The distinct new side is settled and measured: if it fits, its
    fingerprints are broadcast over one scan of the index; else it is shuffled to the index,
    which stays in its buckets (by both halves).
    """
    fresh = settle(with_fingerprint(raw.distinct()))
    known = index.select(F.col("__h1").alias("__k1"), F.col("__h2").alias("__k2"))
    same = (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2"))
    if fits_broadcast(fresh, max_rows):
        hits = settle(known.join(F.broadcast(fresh.select("__h1", "__h2")), same, "left_semi").distinct())
        known = F.broadcast(hits)  # at most as many as fresh rows
    else:
        known = known.hint("merge")
    return fresh.join(known, same, "left_anti").drop("__h1", "__h2")


def absent(rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """Distinct rows that the target does not hold as they are, for loads that may be
    repeated: a changed row is loaded, NULL keys compare equal."""
    return new_rows(rows, loaded.select([F.col(f"`{c}`") for c in rows.columns]))


def monthly_trend(orders: DataFrame, order_time: str,
                  clicks: DataFrame, click_time: str) -> DataFrame:
    """Orders and clicks per month in one shuffle; a month with neither has no row."""
    def monthly(df, column, orders_n, clicks_n):
        return df.select(F.trunc(F.col(column).cast("date"), "month").alias("month"),
                         F.lit(orders_n).cast("long").alias("orders"),
                         F.lit(clicks_n).cast("long").alias("clicks"))

    both = monthly(orders, order_time, 1, 0).unionByName(monthly(clicks, click_time, 0, 1))
    return both.groupBy("month").agg(F.sum("orders").alias("orders"), F.sum("clicks").alias("clicks"))


def hourly_clicks(clicks: DataFrame, click_time: str) -> DataFrame:
    return (clicks.groupBy(F.hour(click_time).alias("hour"))
            .agg(F.count(F.lit(1)).alias("clicks")))


def added_counts(partials: DataFrame, key: str) -> DataFrame:
    """Partial counts of one kind, such as one per run, added up by ``key``."""
    counts = [c for c in partials.columns if c != key]
    return partials.groupBy(key).agg(*[F.sum(c).alias(c) for c in counts])
