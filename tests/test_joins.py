from __future__ import annotations

import random

import pytest

from millrace.operators.joins import fits_broadcast, lookup_join
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some keys are NULL or unknown."""
    rng = random.Random(1)
    keys = [5 if rng.random() < 0.34 else rng.choice([None, *range(40)]) for _ in range(3000)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(30)] + [(None, "none")],
                                 "key int, name string")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_both_ways_agree_with_a_plain_join(skewed, lookup, how):
    plain = skewed.join(lookup, skewed["k"] == lookup["key"], how).drop("key")
    expected = rows(plain)
    assert rows(lookup_join(skewed, lookup, "k", "key", how)) == expected
    assert rows(lookup_join(skewed, lookup, "k", "key", how, max_rows=0)) == expected


@pytest.mark.parametrize("how", ["right", "full", "cross"])
def test_other_joins_are_refused(skewed, lookup, how):
    with pytest.raises(ValueError):
        lookup_join(skewed, lookup, "k", "key", how)


def test_large_lookup_may_repeat_keys(spark):
    few = spark.createDataFrame([(1, 1), (2, 9)], "id int, k int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "key int, name string")
    assert rows(lookup_join(few, twice, "k", "key", max_rows=0)) == [(1, 1, "a"), (1, 1, "b"), (2, 9, None)]


def test_unknown_key_beyond_the_bound(spark, lookup):
    few = spark.createDataFrame([(1, 1), (2, 99)], "id int, k int")
    assert rows(lookup_join(few, lookup, "k", "key", max_rows=0)) == [(1, 1, "name 1"), (2, 99, None)]


def test_size_is_measured_by_rows_and_bytes(spark, lookup):
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=30)
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS text")
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=9_000)


def test_small_lookup_is_broadcast_and_large_is_not(spark, skewed, lookup, tmp_path):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(lookup_join(skewed, lookup, "k", "key"))
    skewed.write.parquet(str(tmp_path / "fact"))
    large = plan(lookup_join(spark.read.parquet(str(tmp_path / "fact")), lookup, "k", "key", max_rows=0))
    assert "SortMergeJoin" in large and "Broadcast" not in large
    assert large.count("FileScan") == 1
