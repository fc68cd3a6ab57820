"""Bucketed folders: the base of the active table and the index of staged rows stay in place."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators.staging import new_by_index, new_rows, with_fingerprint
from millrace.plans.staging_loads import FolderStaging, stage
from millrace.schemas import LONG, STRING, struct
from millrace.sources.buckets import BucketedFolder
from millrace.streaming.active_table import ActiveTable
from tests.helpers import rows
from tests.test_active_table import batch, pairs


def tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(plan, scan):
    """The lines from the root of the plan down to the line that holds ``scan``, on its branch."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, out = len(re.match(r"[\s:+|-]*", lines[at])[0]), [lines[at]]
    for line in reversed(lines[:at]):
        own = len(re.match(r"[\s:+|-]*", line)[0])
        if own < depth:
            depth = own
            out.append(line)
    return out


def test_folder_is_replaced_and_read_again(spark, tmp_path):
    schema = struct(k=LONG, v=STRING)
    folder = BucketedFolder(spark, str(tmp_path / "f"), schema, ["k"], 4)
    for n in (10, 7):
        folder.write(spark.range(n).selectExpr("id AS v", "id AS k").withColumn("v", F.col("v").cast("string")))
        assert folder.read().count() == n
    folder.forget()
    again = BucketedFolder(spark, str(tmp_path / "f"), schema, ["k"], 4).read()
    assert again.columns == ["k", "v"] and again.count() == 7


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    folder = BucketedFolder(spark, str(tmp_path / "f"), struct(k=LONG), ["k"], 4, "run")
    for n, run in ((5, "a"), (6, "b"), (2, "a"), (0, "c")):
        folder.write(spark.range(n).selectExpr("id AS k"), run)
    assert rows(folder.read().groupBy("run").count()) == [("a", 2), ("b", 6)]


@pytest.fixture
def table(spark, tmp_path):
    active = ActiveTable(spark, str(tmp_path / "active"), buckets=8)
    active.create()
    active.append_batch(batch(spark, [(u, "login") for u in [*range(60), *[7] * 900, None, None]]), 0)
    active.compact()
    return active


def test_base_is_not_shuffled(spark, table):
    table.append_batch(batch(spark, [*[(u, "session_ended") for u in range(0, 50, 2)], (2, "login"), (70, "login")]), 1)
    expected = sorted([(u, "login") for u in [*range(1, 50, 2), *range(50, 60), *[7] * 900, None, None, 2, 70]], key=repr)
    small, large = table.read(), table.read(max_rows=0)
    assert pairs(small) == pairs(large) == expected
    found = above(tree(large), "Bucketed: true")
    assert any("SortMergeJoin" in line for line in found)
    assert not any("Exchange" in line for line in found)


def test_hot_user_is_in_several_buckets(spark, table):
    stored = spark.read.parquet(f"{table.root}/base/upto=0").where("user_id = 7")
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 600


def test_bases_in_buckets_follow_each_other(spark, table):
    rng = random.Random(5)
    alive = pairs(table.read())
    for number in range(1, 5):
        given = [(rng.randrange(80), rng.choice(["login", "login", "session_ended"])) for _ in range(400)]
        table.append_batch(batch(spark, given), number)
        gone = {u for u, e in given if e == "session_ended"}
        alive = [(u, e) for u, e in alive if u not in gone] + [(u, e) for u, e in given if e == "login"]
        table.compact()
        assert pairs(table.read(max_rows=0)) == pairs(table.read()) == sorted(alive, key=repr)
    table.vacuum(1)
    assert pairs(ActiveTable(spark, table.root).read(max_rows=0)) == sorted(alive, key=repr)


def test_fingerprints_tell_what_distinct_tells(spark):
    given = spark.createDataFrame(
        [(None, "x", 0.0), ("x", None, 0.0), ("x", "", 0.0), ("x", "", -0.0), (None, None, float("nan")),
         (None, None, float("nan")), ("xy", "z", 1.0), ("x", "yz", 1.0), (None, None, None)], "a string, b string, c double")
    prints = with_fingerprint(given)
    assert prints.select("__h1", "__h2").distinct().count() == given.distinct().count() == 7
    assert prints.select("__h1").distinct().count() == prints.select("__h2").distinct().count() == 7


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_difference_by_index_equals_difference(spark, max_rows):
    raw = spark.range(900).selectExpr("IF(id % 9 = 0, NULL, id % 200) AS a", "CAST(id % 3 AS STRING) AS b")
    staged = raw.where("a < 90 OR (a IS NULL AND b = '0')")
    found = new_by_index(raw, with_fingerprint(staged), max_rows)
    assert rows(found) == rows(new_rows(raw, staged)) and found.columns == raw.columns


def test_large_difference_reads_no_staged_row_and_moves_no_index(spark, tmp_path):
    raw = spark.range(500).selectExpr("id AS a", "CAST(id AS STRING) AS b")
    store = FolderStaging(spark, str(tmp_path), buckets=8)
    stage(raw.where("a < 300"), store, "t", "1")
    for name in (tmp_path / "t" / "run=1").iterdir():
        name.rename(tmp_path / name.name)  # the staged rows are out of reach
    index = store.index("t", raw.schema)
    found = new_by_index(raw, index, max_rows=0)
    plan = tree(found)
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<__h1:bigint,__h2:bigint>" in plan
    assert not any("Exchange" in line for line in above(plan, "Bucketed: true"))
    assert found.count() == 200


def test_index_is_made_for_runs_without_one_and_follows_repeats(spark, tmp_path):
    def some(*numbers):
        return spark.createDataFrame([(n,) for n in numbers], "a int")

    store = FolderStaging(spark, str(tmp_path), buckets=4)
    some(1, 2).write.parquet(str(tmp_path / "t" / "run=0"))  # as before there was an index
    assert rows(stage(some(2, 3, 3), store, "t", "1")) == [(3,)]
    assert rows(stage(some(2, 4), store, "t", "1")) == [(4,)]  # repeated with other rows
    assert rows(stage(some(3, 4, 5), store, "t", "2")) == [(3,), (5,)]
    assert rows(store.read("t", some(1).schema)) == [(n,) for n in (1, 2, 3, 4, 5)]
    assert rows(stage(some(1, 3), FolderStaging(spark, str(tmp_path)), "t", "3", "replace")) == [(1,)]
