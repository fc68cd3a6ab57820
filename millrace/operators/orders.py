"""Regional orders: clean, collect rejects, union and check completeness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import address_country, convert, joined_timestamp, price_amount
from millrace.schemas import CURATED_ORDER


def clean_orders(orders: DataFrame, strict: bool = False) -> DataFrame:
    """Curated columns in their fixed order.

    A value that cannot be read becomes NULL and shows up in ``order_rejects``;
    with ``strict`` it fails the job instead.
    """
    return _converted(orders, strict).select(*[f"`{name}`" for name in CURATED_ORDER.names])


def order_rejects(orders: DataFrame) -> DataFrame:
    """Source rows with an unreadable value, and the names of the fields at fault."""
    def lost(source, result):
        return F.col(source).isNotNull() & F.col(result).isNull()

    faults = {
        "delivery address": lost("delivery address", "country"),
        "price": lost("price", "price_dollar"),
        "rating": lost("__rating", "rating"),
        "timestamp": lost("__when", "timestamp"),
    }
    named = F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in faults.items()])
    flagged = _converted(orders.withColumns({
        "__rating": F.col("rating"), "__when": F.coalesce("date", "time")}), strict=False)
    return (flagged.withColumn("faults", named)
            .where("faults <> ''")
            .select("`order-id`", "price", F.col("__rating").alias("rating"),
                    "`delivery address`", "date", "time", "faults"))


def _converted(orders, strict):
    return orders.withColumns({
        "country": address_country(F.col("`delivery address`"), strict),
        "price_dollar": price_amount(F.col("price"), strict),
        "rating": convert(F.col("rating"), "int", strict),
        "timestamp": joined_timestamp(F.col("date"), F.col("time"), strict),
    })


def union_regions(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of frames that were already projected to the same schema."""
    return reduce(DataFrame.unionByName, frames)


def regions_complete(orders: DataFrame, region: str, expected: list[str]) -> DataFrame:
    """One row: how many expected regions delivered rows, the names of those that did not,
    how many others turned up, and whether none is missing."""
    wanted = F.array(*[F.lit(name) for name in sorted(set(expected))]).cast("array<string>")
    known = F.array_contains(wanted, F.col(region))
    found = orders.agg(F.collect_set(F.when(known, F.col(region))).alias("found"),
                       F.count_distinct(F.when(~known, F.col(region))).alias("unexpected"))
    missing = F.array_except(wanted, F.col("found"))
    return found.select(F.size("found").alias("present"), F.array_join(missing, ",").alias("missing"),
                        "unexpected", (F.size(missing) == 0).alias("complete"))
