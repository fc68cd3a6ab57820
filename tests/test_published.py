from __future__ import annotations

import datetime

import pytest

from millrace.operators.staging import hourly_clicks, monthly_trend
from millrace.plans.staging_loads import Trends, load_star, star_writer
from millrace.sources.published import PublishedRuns
from tests.helpers import rows


@pytest.fixture
def target(spark, tmp_path):
    return PublishedRuns(spark, str(tmp_path / "t"))


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def test_a_run_is_loaded_once(spark, target):
    assert rows(target.read("id bigint")) == []
    assert target.append(frame(spark, 1, 1, None), "a") and target.append(frame(spark, 2), "b")
    assert not target.append(frame(spark, 7), "a")
    assert rows(target.read("id bigint")) == [(1,), (1,), (2,), (None,)]


def test_a_load_that_died_leaves_nothing_to_read(spark, target):
    target.append(frame(spark, 1), "a")
    target.write(frame(spark, 5))  # no ledger row: killed between write and publish
    assert rows(target.read("id bigint")) == [(1,)]
    assert target.append(frame(spark, 5), "b")
    assert rows(target.read("id bigint")) == [(1,), (5,)]
    assert target.vacuum() == 1 and target.vacuum() == 0
    assert rows(target.read("id bigint")) == [(1,), (5,)]


def test_the_first_of_two_loads_at_a_time_counts(spark, target):
    first, second = target.write(frame(spark, 1)), target.write(frame(spark, 1))
    target.publish("a", second), target.publish("a", first)
    assert rows(target.read("id bigint")) == [(1,)]
    assert target.published() == {"a": (0, second)}


def test_replaced_and_empty_runs(spark, target):
    target.append(frame(spark, 1), "a")
    target.replace(frame(spark, 2, 3), "a"), target.replace(frame(spark, 4), "a")
    target.replace(frame(spark), "empty")
    assert rows(target.read("id bigint")) == [(4,)]
    assert not target.append(frame(spark, 9), "empty")


def test_a_repeated_load_computes_nothing(spark, target):
    """The rows of a published run are not even looked at."""
    target.append(frame(spark, 1), "a")
    broken = spark.range(1).selectExpr("CAST(raise_error('computed') AS BIGINT) AS id")
    assert not target.append(broken, "a")


def test_star_targets_by_run(spark, tmp_path):
    write = star_writer(spark, str(tmp_path), "1")
    for _ in range(2):
        load_star({"orders": frame(spark, 1, 2), "users": frame(spark, 3)}, write)
    assert rows(PublishedRuns(spark, f"{tmp_path}/fact_orders").read("id bigint")) == [(1,), (2,)]
    assert rows(PublishedRuns(spark, f"{tmp_path}/dim_users").read("id bigint")) == [(3,)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 1, 2, 0, 2)])
def test_trends_by_run_equal_the_whole(spark, tmp_path, order):
    day = datetime.datetime(2025, 1, 5, 3)
    orders = spark.createDataFrame([(i, day + datetime.timedelta(days=9 * i)) for i in range(30)] + [(31, None)],
                                   "k int, at timestamp")
    clicks = spark.createDataFrame([(i, day + datetime.timedelta(hours=31 * i)) for i in range(40)],
                                   "k int, at timestamp")
    trends = Trends(spark, str(tmp_path / "trends"))
    for run in order:
        trends.add(str(run), orders.where(f"k % 3 = {run}"), "at", clicks.where(f"k % 3 = {run}"), "at")
    assert rows(trends.monthly()) == rows(monthly_trend(orders, "at", clicks, "at"))
    assert rows(trends.hourly()) == rows(hourly_clicks(clicks, "at"))
    # A repeated run replaces what it counted, and an empty one counts nothing.
    trends.add("1", orders.where("false"), "at", clicks.where("false"), "at")
    assert rows(trends.hourly()) == rows(hourly_clicks(clicks.where("k % 3 <> 1"), "at"))
