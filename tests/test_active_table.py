from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from millrace.operators.traffic import traffic_by_state
from millrace.sources.messages import await_or_stop, folder_stream
from millrace.streaming.active_table import (ActiveTable, delete_matched, matched_rows, resolve)
from millrace.streaming.app_events import Lookups, start_app_events
from tests.helpers import rows, values

DDL = "user_id int, state string, event string, device string"


def batch(spark, pairs):
    return spark.createDataFrame([(u, "Goa", e, "Mobile") for u, e in pairs], DDL)


@pytest.fixture
def table(spark, tmp_path):
    active = ActiveTable(spark, str(tmp_path / "active"))
    active.create()
    return active


def pairs(df):
    return sorted(((r["user_id"], r["event"]) for r in df.collect()), key=repr)


SCRIPT = [
    [(1, "login"), (2, "login")],
    [(1, "session_ended"), (1, "login"), (3, "login"), (3, "session_ended")],
    [(2, "account_deleted"), (4, None)],
]
AFTER = [
    [(1, "login"), (2, "login")],
    [(1, "login"), (2, "login"), (3, "login")],
    [(1, "login"), (3, "login")],
]


def test_empty_table_is_typed_and_made_once(table):
    assert table.read().columns == ["user_id", "state", "event", "device"]
    assert table.read().count() == 0
    with pytest.raises(AnalysisException):
        table.create()


def test_delete_before_append(spark, table):
    for number, (given, expected) in enumerate(zip(SCRIPT, AFTER)):
        table.append_batch(batch(spark, given), number)
        assert pairs(table.read()) == expected


def test_counts(spark, table):
    counts = table.append_batch(batch(spark, [(1, "login"), (2, "session_ended"), (3, None)]), 0)
    assert counts == {"live": 1, "ended": 1, "unknown_event": 1, "unknown_user": 0}


def test_replayed_batch_changes_nothing(spark, table):
    for number in (0, 1, 1, 0, 1, 2, 2):
        table.append_batch(batch(spark, SCRIPT[number]), number)
    assert pairs(table.read()) == AFTER[-1]


def test_compaction_keeps_the_rows(spark, table):
    for number, (given, expected) in enumerate(zip(SCRIPT, AFTER)):
        table.append_batch(batch(spark, given), number)
        assert table.compact() == number
        assert pairs(table.read()) == expected
    table.append_batch(batch(spark, [(9, "login")]), 3)
    for keep in (2, 2, 1):
        table.vacuum(keep)
        assert pairs(table.read()) == [(1, "login"), (3, "login"), (9, "login")]
    assert table.last_batch() == 3
    assert sorted(p.name for p in Path(table.root, "batches").glob("b*")) == ["batch_id=3"]


def test_large_base_is_not_rewritten(spark, table):
    table.append_batch(batch(spark, [(u, "login") for u in range(100)]), 0)
    table.compact()
    bases = lambda: sorted(p.name for p in Path(table.root, "base").iterdir())
    assert bases() == ["upto=-1", "upto=0"]
    for number in (1, 2, 3):
        table.append_batch(batch(spark, [(number, "session_ended"), (500 + number, "login")]), number)
        table.compact()
    table.append_batch(batch(spark, [(502, "session_ended"), (50, "session_ended")]), 4)
    assert bases() == ["upto=-1", "upto=0"]
    expected = sorted(((u, "login") for u in [*range(100), 501, 503] if u not in (1, 2, 3, 50)), key=repr)
    assert pairs(table.read()) == expected
    table.vacuum()
    assert pairs(table.read()) == expected
    table.append_batch(batch(spark, [(u, "login") for u in range(1000, 1100)]), 5)
    table.compact()
    assert "upto=5" in bases()
    assert len(pairs(table.read())) == len(expected) + 100


def test_unmarked_leftovers_are_not_read(spark, table):
    """What a compaction that died left behind."""
    table.append_batch(batch(spark, [(1, "login")]), 0)
    batch(spark, [(7, "login")]).write.parquet(f"{table.root}/merged/upto=0/kind=live")
    batch(spark, [(8, "login")]).write.parquet(f"{table.root}/base/upto=0")
    assert pairs(table.read()) == [(1, "login")]
    table.append_batch(batch(spark, [(2, "login")]), 1)
    table.compact()
    assert pairs(table.read()) == [(1, "login"), (2, "login")]


def test_null_users_never_match(spark, table):
    table.append_batch(batch(spark, [(None, "login"), (1, "login")]), 0)
    table.append_batch(batch(spark, [(None, "session_ended")]), 1)
    assert pairs(table.read()) == sorted([(None, "login"), (1, "login")], key=repr)


def test_batch_without_rows(spark, table):
    table.append_batch(batch(spark, [(1, "login")]), 0)
    table.append_batch(batch(spark, []), 1)
    assert pairs(table.read()) == [(1, "login")]


def brute_force(stored):
    """Replay the batches one by one over a plain list."""
    alive = []
    for number in sorted({b for _, _, b in stored}):
        of_batch = [(u, e) for u, e, b in stored if b == number]
        ended = {u for u, e in of_batch if e == "session_ended" and u is not None}
        alive = [(u, e) for u, e in alive if u not in ended]
        alive += [(u, e) for u, e in of_batch if e is not None and e != "session_ended"]
    return sorted(alive, key=repr)


@pytest.mark.parametrize("compact_after", [(), (3,), (0, 1, 2, 4)])
def test_random_batches_with_one_hot_user(spark, table, compact_after):
    rng = random.Random(3)
    events = ["login", "in_app_purchase", "session_started", "session_ended", None]
    stored = [(7 if rng.random() < 0.35 else rng.choice([None, *range(25)]),
               rng.choices(events, [5, 5, 5, 1, 1])[0], rng.randrange(6)) for _ in range(1500)]
    for number in range(6):
        table.append_batch(batch(spark, [(u, e) for u, e, b in stored if b == number]), number)
        if number in compact_after:
            table.compact()
            table.vacuum()
    assert pairs(table.read()) == brute_force(stored)
    assert pairs(table.read(max_rows=0)) == brute_force(stored)


def test_resolve_on_frames(spark):
    live = spark.createDataFrame([(1, 0), (1, 2), (2, 1), (None, 0)], "user_id int, batch_id long")
    ended = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id int, batch_id long")
    expected = sorted([(1, 2), (2, 1), (None, 0)], key=repr)
    assert rows(resolve(live, ended)) == expected
    assert rows(resolve(live, ended, max_rows=0)) == expected


def test_matched_and_kept_are_a_partition(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "user_id int, x string")
    users = spark.createDataFrame([(1,), (None,)], "user_id int")
    assert rows(matched_rows(target, users)) == [(1, "a"), (1, "b")]
    assert rows(delete_matched(target, users)) == sorted([(2, "c"), (None, "d")], key=repr)


def message(user, event_id, state="West Bengal"):
    return f'{{"user_id":{user},"state":"{state}","event_id":{event_id},"device_id":1}}'


def test_lookups_too_large_to_broadcast(spark, tmp_path):
    names = spark.createDataFrame([(0, "session_ended"), (1, "login")], "Event_ID int, event string")
    devices = spark.createDataFrame([(1, "Computer")], "Device_ID int, device string")
    values(spark, [message(u, 1) for u in range(30)] + [message(3, 9)]).write.text(str(tmp_path / "in"))
    active = ActiveTable(spark, str(tmp_path / "active"))
    query = start_app_events(folder_stream(spark, str(tmp_path / "in")),
                             Lookups(names, devices, broadcast=False), active,
                             str(tmp_path / "checkpoint"), {"availableNow": True})
    assert await_or_stop(query, 120)
    assert pairs(active.read()) == sorted(((u, "login") for u in range(30)), key=repr)


def test_stream_end_to_end(spark, tmp_path):
    lookups = Lookups.load(
        spark.createDataFrame([(0, "session_ended"), (1, "login")], "Event_ID int, event string"),
        spark.createDataFrame([(1, "Computer")], "Device_ID int, device string"))
    assert lookups.broadcast
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    active, seen = ActiveTable(spark, str(tmp_path / "active")), []

    def land_and_run(texts, checkpoint=checkpoint):
        values(spark, texts).write.mode("append").text(folder)
        query = start_app_events(folder_stream(spark, folder), lookups, active, checkpoint,
                                 {"availableNow": True},
                                 on_batch=lambda number, counts: seen.append((number, counts)))
        assert await_or_stop(query, 60)

    land_and_run([message(1, 1), message(2, 1), message(3, 8)])
    land_and_run(["garbage"])
    land_and_run([message(1, 0), message(2, 1, "Andaman and Nicobar Islands")])
    assert rows(active.read()) == [
        (2, "AndamanandNicobar", "login", "Computer"), (2, "WestBengal", "login", "Computer")]
    assert rows(traffic_by_state(active.read())) == [("AndamanandNicobar", 1), ("WestBengal", 1)]
    assert seen[0] == (0, {"live": 2, "ended": 0, "unknown_event": 1, "unknown_user": 0})
    # The second landing held no event: nothing was written for it.
    assert [number for number, _ in seen] == [0, 2]
    assert not (tmp_path / "active" / "batches" / "batch_id=1").exists()

    # A stream with a new checkpoint reads everything again and counts on.
    land_and_run([message(5, 1)], str(tmp_path / "checkpoint-2"))
    assert active.last_batch() == 3
    assert active.attach(checkpoint) == 0
    assert active.attach(str(tmp_path / "checkpoint-2")) == 3
