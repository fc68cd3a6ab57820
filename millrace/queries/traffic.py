"""App traffic on the given tables: ``events`` is the stream, its days are batches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import row_json
from millrace.operators.events import (clean_events, enrich, live_events, normalise_payloads,
                                       parse_events, terminal_users)
from millrace.operators.joins import lookup_join
from millrace.operators.traffic import (fill_regions, scale_domain, traffic_by_user_state,
                                        unmatched_states)
from millrace.queries import table
from millrace.schemas import INT, LONG, STRING, struct
from millrace.session import move_path, path_exists, scratch_path, settle
from millrace.sources.messages import folder_stream
from millrace.sources.tables import read_boundaries
from millrace.streaming.active_table import (ENDED, LIVE, ActiveTable, delete_matched,
                                             matched_rows, resolve, split_kinds)
from millrace.streaming.app_events import Lookups, start_app_events

LONG_EVENTS = T.ArrayType(struct(user_id=LONG, state=STRING, event_id=LONG, device_id=INT))
# Ids and names of the event and device lookups used here.
EVENT_NAMES = [(0, "session_ended"), (1, "login"), (2, "in_app_purchase"), (3, "session_started")]
DEVICE_NAMES = [(0, "Mobile"), (1, "Computer")]
BATCH_DAYS = 7


def _props_k():
    return F.get_json_object("props", "$.k").cast("int")


def _users(spark, folder):
    """user_id and state of every customer."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    placed = lookup_join(customers, nations, "c_nationkey", "n_nationkey")
    return placed.select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("state"))


def traffic_by_state(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "event")
    return traffic_by_user_state(events, _users(spark, folder))


def _regions(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_name").alias("NAME_1"))
    return nations.unionByName(
        table(spark, folder, "region").select(F.col("r_name").alias("NAME_1")))


def traffic_region_fill(spark, folder):
    return fill_regions(_regions(spark, folder), traffic_by_state(spark, folder))


def traffic_geojson(spark, folder):
    """The same with the regions read from a GeoJSON collection."""
    location = f"{scratch_path(spark, 'map')}"
    feature = F.struct(F.lit("Feature").alias("type"),
                       F.struct(F.col("NAME_1"), F.lit(1).alias("GID")).alias("properties"))
    (_regions(spark, folder).agg(F.to_json(F.struct(
        F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))
        .write.text(location))
    return fill_regions(read_boundaries(spark, location), traffic_by_state(spark, folder))


def traffic_scale_domain(spark, folder):
    return scale_domain(traffic_region_fill(spark, folder))


def traffic_unmatched(spark, folder):
    """Traffic of the states a smaller map does not show."""
    shown = (table(spark, folder, "nation").where("n_regionkey < 3")
             .select(F.col("n_name").alias("NAME_1")))
    return unmatched_states(shown, traffic_by_state(spark, folder))


def parse_event_json(spark, folder):
    event = F.struct("user_id", F.col("event_type").alias("state"), "event_id",
                     _props_k().alias("device_id"))
    text = (F.when(F.col("event_type") == "click", F.to_json(event))
            .when(F.col("event_type") == "view", F.to_json(F.array(event, event)))
            .when(F.col("event_type") == "error", F.lit("garbage"))
            .otherwise(F.to_json(F.array(event))))
    messages = table(spark, folder, "events").select(F.encode(text, "UTF-8").alias("value"))
    return parse_events(messages, LONG_EVENTS)


def clean_state(spark, folder):
    state = (F.when(F.col("state") == "NATION_7", "Andaman and Nicobar Islands")
             .otherwise(F.replace("state", F.lit("_"), F.lit(" of "))))
    return clean_events(_users(spark, folder).withColumn("state", state))


def _with_ids(spark, folder):
    return table(spark, folder, "events").select(
        "user_id", F.col("event_type").alias("state"), _props_k().alias("event_id"),
        (_props_k() % 7).alias("device_id"))


def enrich_left_join(spark, folder):
    names = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("Event_ID"), F.col("n_name").alias("event"))
    devices = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("Device_ID"), F.col("r_name").alias("device"))
    return enrich(_with_ids(spark, folder), names, devices)


def lookup_join_hot_keys(spark, folder):
    """The way beyond the broadcast bound: both sides shuffled, hot partitions split."""
    events = table(spark, folder, "events").select("event_id", "user_id")
    users = table(spark, folder, "customer").select("c_custkey", "c_name")
    return lookup_join(events, users, "user_id", "c_custkey", max_rows=0)


def _named_events(spark, folder):
    name = (F.when(F.col("event_type") == "error", "session_ended")
            .when(F.col("event_type") == "signup", "account_deleted")
            .when(F.col("event_type") != "view", F.col("event_type")))
    return table(spark, folder, "events").select("event_id", "user_id", name.alias("event"))


def terminal_users_query(spark, folder):
    return terminal_users(_named_events(spark, folder))


def live_events_null_drop(spark, folder):
    return live_events(_named_events(spark, folder))


def merge_delete(spark, folder):
    ends = (F.col("event_type") == "error") & (F.col("value") > 25)
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type",
        F.when(ends, "session_ended").otherwise(F.col("event_type")).alias("event"),
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
         .cast("long").alias("batch_id"))
    kinds = split_kinds(events)
    live = kinds.where(F.col("kind") == LIVE).drop("kind", "event")
    return resolve(live, kinds.where(F.col("kind") == ENDED))


def _ended_users(spark, folder):
    """Users with a large error, once each."""
    ended = table(spark, folder, "events").where("event_type = 'error' AND value > 100")
    return settle(ended.select("user_id").distinct())


def merge_kept_rows(spark, folder):
    target = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return delete_matched(target, _ended_users(spark, folder))


def merge_matched_rows(spark, folder):
    target = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return matched_rows(target, _ended_users(spark, folder))


def _stream_messages(spark, folder):
    """Events as the producer would send them: state name, event id, device id."""
    ends = (F.col("event_type") == "error") & (F.col("value") > 25)
    event_id = (F.when(ends, 0).when(F.col("event_type") == "view", 1)
                .when(F.col("event_type") == "click", 2)
                .when(F.col("event_type") == "purchase", 3).otherwise(9))
    events = table(spark, folder, "events").select(
        "ts", "user_id", event_id.alias("event_id"), (_props_k() % 3).alias("device_id"))
    spaced = F.replace("state", F.lit("_"), F.lit(" "))
    users = _users(spark, folder).select(
        F.col("user_id").alias("state_of"), spaced.alias("state"))
    return lookup_join(events, users, "user_id", "state_of")


def stream_run(spark, folder, on_progress=None, compact_every=2) -> ActiveTable:
    """Publish the events once, then land them week by week: each landing is a batch.

    ``on_progress`` receives the seconds each batch took.
    """
    root = scratch_path(spark, "app-events")
    events = _stream_messages(spark, folder)
    lookups = Lookups.load(
        spark.createDataFrame(EVENT_NAMES, "Event_ID int, event string"),
        spark.createDataFrame(DEVICE_NAMES, "Device_ID int, device string"))
    active = ActiveTable(spark, f"{root}/active")
    first, last = table(spark, folder, "events").agg(
        F.min(F.col("ts").cast("date")), F.max(F.col("ts").cast("date"))).first()
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit(first)) / BATCH_DAYS)
    fields = [c for c in events.columns if c != "ts"]
    (events.select(row_json(*fields).alias("value"), F.coalesce(week, F.lit(0)).alias("week"))
        .write.partitionBy("week").text(f"{root}/published"))
    for number in range((last - first).days // BATCH_DAYS + 1):
        if not path_exists(spark, f"{root}/published/week={number}"):
            continue
        move_path(spark, f"{root}/published/week={number}", f"{root}/messages/{number}")
        landed = folder_stream(spark, f"{root}/messages", recursiveFileLookup="true")
        query = start_app_events(landed, lookups, active, f"{root}/checkpoint", {"availableNow": True},
                                 compact_every=compact_every)
        query.awaitTermination()
        if on_progress:
            for progress in query.recentProgress:
                on_progress(progress["durationMs"]["triggerExecution"] / 1000)
    return active


def merge_delete_stream(spark, folder):
    return stream_run(spark, folder).read()


def merge_delete_bucketed(spark, folder):
    """The way beyond the broadcast bound: ended users are shuffled to the base's buckets."""
    return stream_run(spark, folder, compact_every=1).read(max_rows=0)


def normalize_raw_event(spark, folder):
    item = F.struct(
        (F.col("event_id") + 1_000_000).cast("string").alias("user_id"),
        F.col("event_type").alias("state"),
        _props_k().cast("string").alias("event_id"),
        (_props_k() % 2).alias("device_id"))
    data = (F.when(F.col("event_type") == "signup", F.expr("slice(array(item), 1, 0)"))
            .when(F.col("event_type") == "view", F.expr("array(item, item)"))
            .otherwise(F.expr("array(item)")))
    payloads = (table(spark, folder, "events").withColumn("item", item)
                .select(row_json(data.alias("data")).alias("value")))
    return normalise_payloads(payloads)


QUERIES = {
    "traffic_by_state": traffic_by_state,
    "traffic_region_fill": traffic_region_fill,
    "traffic_geojson": traffic_geojson,
    "traffic_scale_domain": traffic_scale_domain,
    "traffic_unmatched": traffic_unmatched,
    "parse_event_json": parse_event_json,
    "clean_state": clean_state,
    "enrich_left_join": enrich_left_join,
    "lookup_join_hot_keys": lookup_join_hot_keys,
    "terminal_users": terminal_users_query,
    "live_events_null_drop": live_events_null_drop,
    "merge_kept_rows": merge_kept_rows,
    "merge_matched_rows": merge_matched_rows,
    "merge_delete": merge_delete,
    "merge_delete_stream": merge_delete_stream,
    "merge_delete_bucketed": merge_delete_bucketed,
    "normalize_raw_event": normalize_raw_event,
}

_TRAFFIC = """
    SELECT n_name AS state, count(event_type) AS app_traffic
    FROM events
    LEFT JOIN customer ON user_id = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name"""
_FILLED = f"""
    SELECT "NAME_1", coalesce(app_traffic, 0) AS app_traffic
    FROM (SELECT n_name AS "NAME_1" FROM nation UNION ALL SELECT r_name FROM region) regions
    LEFT JOIN ({_TRAFFIC}) traffic ON "NAME_1" = state"""
_K = "CAST(json_extract(props, '$.k') AS INTEGER)"
_NAMED = """
    SELECT event_id, user_id,
           CASE WHEN event_type = 'error' THEN 'session_ended'
                WHEN event_type = 'signup' THEN 'account_deleted'
                WHEN event_type <> 'view' THEN event_type END AS event
    FROM events"""
_STREAMED = f"""
    WITH batched AS (
        SELECT user_id, replace(n_name, '_', '') AS state,
               CASE WHEN event_type = 'error' AND value > 25 THEN 'session_ended'
                    WHEN event_type = 'view' THEN 'login'
                    WHEN event_type = 'click' THEN 'in_app_purchase'
                    WHEN event_type = 'purchase' THEN 'session_started' END AS event,
               CASE {_K} % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Computer' END AS device,
               date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events),
                         CAST(ts AS DATE)) // {BATCH_DAYS} AS batch_id
        FROM events
        LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey)
    SELECT CAST(user_id AS INTEGER) AS user_id, state, event, device FROM batched kept
    WHERE event IS NOT NULL AND event <> 'session_ended' AND NOT EXISTS (
        SELECT 1 FROM batched later
        WHERE later.event = 'session_ended' AND later.user_id = kept.user_id
          AND later.batch_id > kept.batch_id)"""

ORACLE = {
    "traffic_by_state": _TRAFFIC,
    "traffic_region_fill": _FILLED,
    "traffic_geojson": _FILLED,
    "traffic_scale_domain":
        f"SELECT min(app_traffic) AS low, max(app_traffic) AS high FROM ({_FILLED}) filled",
    "traffic_unmatched": f"""
        SELECT * FROM ({_TRAFFIC}) traffic
        WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey < 3 AND n_name = state)""",
    "parse_event_json": f"""
        SELECT user_id, event_type AS state, event_id, {_K} AS device_id
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT user_id, event_type, event_id, {_K} FROM events WHERE event_type = 'view'""",
    "clean_state": """
        SELECT c_custkey AS user_id,
               CASE WHEN n_name = 'NATION_7' THEN 'AndamanandNicobar'
                    ELSE replace(n_name, '_', 'of') END AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "enrich_left_join": f"""
        SELECT user_id, event_type AS state, n_name AS event, r_name AS device
        FROM events
        LEFT JOIN nation ON {_K} = n_nationkey
        LEFT JOIN region ON {_K} % 7 = r_regionkey""",
    "lookup_join_hot_keys": """
        SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "terminal_users": f"""
        SELECT DISTINCT user_id FROM ({_NAMED}) named
        WHERE event IN ('account_deleted', 'session_ended')""",
    "live_events_null_drop": f"""
        SELECT * FROM ({_NAMED}) named
        WHERE event <> 'account_deleted' AND event <> 'session_ended'""",
    "merge_kept_rows": """
        SELECT event_id, user_id, event_type FROM events
        WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)""",
    "merge_matched_rows": """
        SELECT event_id, user_id, event_type FROM events
        WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)""",
    "merge_delete": """
        WITH batched AS (
            SELECT event_id, user_id, event_type,
                   event_type = 'error' AND value > 25 AS ends,
                   CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id
            FROM events)
        SELECT event_id, user_id, event_type, batch_id FROM batched kept
        WHERE NOT ends AND NOT EXISTS (
            SELECT 1 FROM batched later
            WHERE later.ends AND later.user_id = kept.user_id AND later.batch_id > kept.batch_id)""",
    "merge_delete_stream": _STREAMED,
    "merge_delete_bucketed": _STREAMED,
    "normalize_raw_event": f"""
        WITH cut AS (
            SELECT CAST(substr(CAST(event_id + 1000000 AS VARCHAR), 1, 3) AS INTEGER) AS user_id,
                   event_type AS state,
                   CAST(substr(CAST({_K} AS VARCHAR), 1, 1) AS INTEGER) AS digit,
                   {_K} % 2 AS device_id
            FROM events WHERE event_type <> 'signup')
        SELECT user_id, state, CASE WHEN digit > 5 THEN digit - 5 ELSE digit END AS event_id,
               device_id
        FROM cut""",
}
