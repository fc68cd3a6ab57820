"""Job: app events to active table to traffic per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.traffic import fill_regions, traffic_by_state
from millrace.sources.messages import await_or_stop, folder_stream, topic_stream
from millrace.sources.tables import read_boundaries, read_table
from millrace.streaming.active_table import ActiveTable
from millrace.streaming.app_events import Lookups, start_app_events


def log_events(spark: SparkSession, *, table: str, checkpoint: str, event_lookup: str,
               device_lookup: str, servers: str | None = None, topic: str = "app-events",
               folder: str | None = None, available_now: bool = False,
               compact_every: int | None = 500, timeout: int | None = None) -> None:
    """Run the stream from a broker topic, or from a folder of message files."""
    messages = folder_stream(spark, folder) if folder else topic_stream(spark, servers, topic)
    lookups = Lookups.load(read_table(spark, event_lookup), read_table(spark, device_lookup))
    trigger = {"availableNow": True} if available_now else None
    query = start_app_events(messages, lookups, ActiveTable(spark, table), checkpoint,
                             trigger, compact_every)
    await_or_stop(query, timeout)


def region_traffic(spark: SparkSession, *, table: str, boundaries: str) -> DataFrame:
    """Traffic of every region on the map, 0 where there is none."""
    traffic = traffic_by_state(ActiveTable(spark, table).read())
    return fill_regions(read_boundaries(spark, boundaries), traffic)


def preview(rows: DataFrame, count: int = 5) -> DataFrame:
    """Any few rows, for a look."""
    return rows.limit(count)
