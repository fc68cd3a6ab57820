from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import clean_state
from millrace.operators.events import (clean_events, enrich, live_events, normalise_payloads,
                                       parse_events, terminal_users)
from millrace.operators.traffic import (fill_regions, scale_domain, traffic_by_state,
                                        traffic_by_user_state, unmatched_states)
from tests.helpers import rows, values


def test_parse_edge_rows(spark):
    messages = values(spark, [
        '{"user_id":103,"state":"West Bengal","event_id":3,"device_id":1}',
        '[{"user_id":1,"state":"Goa","event_id":1,"device_id":0},'
        '{"user_id":2,"state":"Goa","event_id":2,"device_id":1}]',
        "[]", "garbage", None,
        '{"user_id":4,"state":"Kerala","event_id":1,"device_id":"one"}',
        '{"user_id":5,"state":"Kerala","event_id":1.5,"device_id":1}',
        '{"user_id":6,"state":"Kerala","event_id":1,"device_id":1,"extra":9}',
        '{"state":"Kerala"}',
    ]).select(F.encode("value", "UTF-8").alias("value"))
    assert rows(parse_events(messages)) == sorted([
        (103, "West Bengal", 3, 1), (1, "Goa", 1, 0), (2, "Goa", 2, 1),
        (4, "Kerala", 1, None), (5, "Kerala", None, 1), (6, "Kerala", 1, 1),
        (None, "Kerala", None, None)], key=repr)


def test_clean_state(spark):
    states = spark.createDataFrame(
        [("West Bengal",), ("Andaman and Nicobar Islands",), (" Goa ",), (None,)], "state string")
    assert [r[0] for r in states.select(clean_state(F.col("state"))).collect()] == [
        "WestBengal", "AndamanandNicobar", "Goa", None]


def test_normalise_payloads(spark):
    payloads = values(spark, [
        '{"data":[{"user_id":"1034567890123","state":"Goa","event_id":"845","device_id":1}]}',
        '{"data":[{"user_id":"9990","state":"Goa","event_id":"5","device_id":0},'
        '{"user_id":"1110","state":"Goa","event_id":"1","device_id":0}]}',
        '{"data":[]}', '{"data":[null]}', '{"status":"OK"}', "garbage", None])
    assert rows(normalise_payloads(payloads)) == [(103, "Goa", 3, 1), (999, "Goa", 5, 0)]


def test_enrich_and_filters(spark):
    events = spark.createDataFrame(
        [(1, "Goa", 1, 0), (2, "Goa", 9, 1), (3, "Goa", 2, 7), (None, "Goa", 2, 1)],
        "user_id int, state string, event_id int, device_id int")
    names = spark.createDataFrame([(1, "login"), (2, "session_ended")], "Event_ID int, event string")
    devices = spark.createDataFrame([(0, "Mobile"), (1, "Computer")], "Device_ID int, device string")
    named = enrich(clean_events(events), names, devices)
    assert named.columns == ["user_id", "state", "event", "device"]
    assert rows(named) == sorted([
        (1, "Goa", "login", "Mobile"), (2, "Goa", None, "Computer"),
        (3, "Goa", "session_ended", None), (None, "Goa", "session_ended", "Computer")], key=repr)
    assert rows(live_events(named)) == [(1, "Goa", "login", "Mobile")]
    assert rows(terminal_users(named)) == [(3,), (None,)]


def test_traffic_counts_events_not_users(spark):
    events = spark.createDataFrame(
        [(1, "Goa", "login"), (1, "Goa", "login"), (2, "Goa", None), (3, "Nowhere", "login"),
         (4, None, "login")], "user_id int, state string, event string")
    traffic = traffic_by_state(events)
    assert rows(traffic) == sorted([("Goa", 2), ("Nowhere", 1), (None, 1)], key=repr)
    regions = spark.createDataFrame([("Goa",), ("Kerala",)], "NAME_1 string")
    filled = fill_regions(regions, traffic)
    assert rows(filled) == [("Goa", 2), ("Kerala", 0)]
    assert rows(scale_domain(filled)) == [(0, 2)]
    assert rows(unmatched_states(regions, traffic)) == sorted([("Nowhere", 1), (None, 1)], key=repr)


def test_traffic_by_user_equals_traffic_by_event(spark):
    events = spark.createDataFrame(
        [(u, "login" if u % 4 else None) for u in [1] * 50 + list(range(20))],
        "user_id int, event string")
    users = spark.createDataFrame([(u, f"s{u % 3}") for u in range(15)], "user_id int, state string")
    direct = traffic_by_state(events.join(users, "user_id", "left"))
    assert rows(traffic_by_user_state(events, users)) == rows(direct)
