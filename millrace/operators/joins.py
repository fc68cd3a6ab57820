"""Joins of a large, possibly skewed side with a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
JOINS = ("left", "inner", "left_semi", "left_anti")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one aggregate: its rows and the bytes they take."""
    if max_rows <= 0:
        return False
    width = F.lit(16 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            nested = F.to_json(F.struct(F.col(f"`{field.name}`")))
            width = width + F.coalesce(F.octet_length(nested), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str,
                how: str = "left", broadcast: bool | None = None,
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join ``fact`` with ``lookup``, dropping ``lookup_key``.

    ``lookup`` is read twice, to measure and to join: pass a scan or a settled frame.
    A lookup measured to fit is broadcast. For a larger one both sides are shuffled, after
    one scan of each; partitions that a hot or NULL key makes large are split at run time
    (``spark.sql.adaptive.skewJoin``), as ``fact`` is the outer side of every allowed join.
    ``broadcast`` states the outcome of a measurement made before.
    """
    if how not in JOINS:
        raise ValueError(f"how must be one of {JOINS}")
    if broadcast is None:
        broadcast = fits_broadcast(lookup, max_rows)
    side = F.broadcast(lookup) if broadcast else lookup.hint("merge")
    return _equi_join(fact, side, fact_key, lookup_key, how)


def _equi_join(fact, lookup, fact_key, lookup_key, how):
    if how in ("left_anti", "left_semi"):
        lookup = lookup.select(lookup_key)
    renamed = lookup.withColumnRenamed(lookup_key, "__lookup_key")
    return fact.join(renamed, F.col(fact_key) == F.col("__lookup_key"), how).drop("__lookup_key")
