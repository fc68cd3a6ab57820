"""The app-event stream: messages in, active-event table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.events import clean_events, enrich, parse_events
from millrace.operators.joins import fits_broadcast
from millrace.streaming.active_table import ActiveTable


@dataclass(frozen=True)
class Lookups:
    """The two lookup tables, measured once when the stream starts."""
    events: DataFrame
    devices: DataFrame
    broadcast: bool

    @classmethod
    def load(cls, events: DataFrame, devices: DataFrame) -> Lookups:
        small = fits_broadcast(events) and fits_broadcast(devices)
        if small:
            events, devices = events.cache(), devices.cache()
        return cls(events, devices, small)


def start_app_events(messages: DataFrame, lookups: Lookups, table: ActiveTable, checkpoint: str,
                     trigger: dict | None = None, compact_every: int | None = None,
                     on_batch=None) -> StreamingQuery:
    """Start the stream. ``trigger`` as for ``DataStreamWriter.trigger``.

    Enrichment runs inside the batch, in one plan with the split and the write.
    Lookups too large to broadcast need several passes, so the batch is kept then.
    ``on_batch(batch_id, counts)`` receives the row counts of each batch. An empty batch
    writes nothing.
    """
    if not table.exists():
        table.create()
    first = table.attach(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if not lookups.broadcast:
            batch.persist()
        named = enrich(batch, lookups.events, lookups.devices, broadcast=lookups.broadcast)
        counts = table.append_batch(named, first + batch_id)
        batch.unpersist()
        if on_batch:
            on_batch(batch_id, counts)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()
            table.vacuum()

    writer = clean_events(parse_events(messages)).writeStream.foreachBatch(store)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()
