"""App events: decode, parse, clean and enrich.

JSON is parsed inside the generator, not in a column before it: the optimizer would
copy such a column into the filters it derives and parse every message several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clean_state, fold_event_id, is_terminal, leading_int
from millrace.operators.joins import lookup_join
from millrace.schemas import APP_EVENTS, RAW_APP_EVENT_PAYLOAD
from millrace.sources.messages import decode


def parse_events(messages: DataFrame, schema=APP_EVENTS) -> DataFrame:
    """Rows of the JSON array (or single object) in each message ``value``."""
    events = decode(messages).select(F.explode(F.from_json("text", schema)).alias("event"))
    return events.select("event.*")


def normalise_payloads(payloads: DataFrame) -> DataFrame:
    """First event of each raw API payload in ``value``, its digits turned into ids."""
    data = F.from_json(F.col("value"), RAW_APP_EVENT_PAYLOAD)["data"]
    first = payloads.select(F.explode(F.slice(data, 1, 1)).alias("raw")).where("raw IS NOT NULL")
    return first.select(
        leading_int(F.col("raw.user_id"), 3).alias("user_id"),
        F.col("raw.state").alias("state"),
        fold_event_id(leading_int(F.col("raw.event_id"), 1)).alias("event_id"),
        F.col("raw.device_id").alias("device_id"),
    )


def clean_events(events: DataFrame) -> DataFrame:
    return events.withColumn("state", clean_state(F.col("state")))


def enrich(events: DataFrame, event_lookup: DataFrame, device_lookup: DataFrame,
           broadcast: bool | None = None) -> DataFrame:
    """Left joins on both ids; an unknown id gives a NULL name. Ids are dropped."""
    named = lookup_join(events, event_lookup, "event_id", "Event_ID", broadcast=broadcast)
    named = lookup_join(named, device_lookup, "device_id", "Device_ID", broadcast=broadcast)
    return named.select("user_id", "state", "event", "device")


def terminal_users(events: DataFrame) -> DataFrame:
    return events.where(is_terminal(F.col("event"))).select("user_id").distinct()


def live_events(events: DataFrame) -> DataFrame:
    """Rows with a known event that does not end activity; NULL events fall out."""
    return events.where(~is_terminal(F.col("event")))
