"""Exact stratified train/test split without sorting or shuffling the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.joins import fits_broadcast
from millrace.session import settle


def hashed_order(*keys: str, seed: int = 42) -> list[Column]:
    """Pseudo-random order by a 32-bit hash of ``keys``, coarse level first.

    Rows that share a hash are told apart by their place in the input, so the
    input must be a scan of files that do not change meanwhile.
    """
    mixed = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(2 ** 32))
    place = F.monotonically_increasing_id()
    return [F.shiftright(mixed, 16), mixed, F.shiftright(place, 33), place]


def stratified_split(rows: DataFrame, label: str, order: list[Column],
                     test_share: float = 0.2) -> DataFrame:
    """Add boolean ``is_test``: per class the first round(share * n) rows of ``order``.

    ``order`` is a list of integer levels, each refining the one before, the last
    unique within the others. Per level the rows still undecided are counted by
    value and the value where the quota runs out is found; only those counts are
    sorted. The rows themselves are never moved: the flag compares them with one
    boundary per class and level. Finer levels are left out once the quota of
    every class ends with a whole group.
    """
    levels = [f"__level_{i}" for i in range(len(order))]
    keyed = rows.withColumns(dict(zip(levels, order)))
    cuts, used, settled = None, 0, False
    while used < len(levels) and not settled:
        cuts, settled = _refine(keyed, label, levels[:used], levels[used], cuts, test_share)
        used += 1

    flagged = _with_cuts(keyed, label, cuts)
    inside = F.lit(True)
    for i in reversed(range(used)):
        level, cut = F.col(levels[i]), F.col(f"__cut_{i}")
        inside = (level < cut) | ((level == cut) & inside)
    return (flagged.withColumn("is_test", (F.col("__quota") > 0) & inside)
            .select(*rows.columns, "is_test"))


def _refine(keyed, label, fixed, level, cuts, test_share):
    """Boundaries per class with that of ``level``, and whether they settle the quotas."""
    open_rows = keyed.select(label, *fixed, level)
    fixed_cuts = [f"__cut_{i}" for i in range(len(fixed))]
    carried = []
    if cuts is not None:
        carried = ["__quota", "__need", *fixed_cuts]
        open_rows = _with_cuts(open_rows, label, cuts)
        for name, cut in zip(fixed, fixed_cuts):
            open_rows = open_rows.where(F.col(name) == F.col(cut))

    counts = open_rows.groupBy(label, *carried, level).agg(F.count(F.lit(1)).alias("__size"))
    in_class = Window.partitionBy(label)
    running = counts.withColumn("upto", F.sum("__size").over(
        in_class.orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if cuts is None:
        total = F.sum("__size").over(in_class)
        running = running.withColumn("__quota", F.round(total * F.lit(test_share)).cast("long"))
        running = running.withColumn("__need", F.greatest("__quota", F.lit(1)))

    before = F.col("upto") - F.col("__size")
    found = running.where((F.col("upto") >= F.col("__need")) & (before < F.col("__need"))).select(
        label, "__quota", (F.col("__need") - before).alias("__need"), "__size",
        *fixed_cuts, F.col(level).cast("long").alias(f"__cut_{len(fixed)}"))
    found = settle(found)
    whole = (F.col("__quota") == 0) | (F.col("__need") == F.col("__size"))
    settled = found.agg(F.coalesce(F.bool_and(whole), F.lit(True))).first()[0]
    return found.drop("__size"), settled


def _with_cuts(df, label, cuts):
    """Boundaries are one row per class; only if there are very many the rows are shuffled."""
    wanted = cuts.withColumnRenamed(label, "__class")
    side = F.broadcast(wanted) if fits_broadcast(cuts) else wanted.hint("merge")
    return df.join(side, F.col(label).eqNullSafe(F.col("__class"))).drop("__class")
