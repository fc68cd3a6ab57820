"""Message streams: a broker topic, or a folder of text files standing in for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import row_json


def topic_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", **options) -> DataFrame:
    """Needs the Kafka connector on the classpath. Yields the binary ``value``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def folder_stream(spark: SparkSession, location: str, max_files: int | None = None,
                  **options) -> DataFrame:
    """New text files of a folder, one message per line."""
    reader = spark.readStream.format("text").options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(location)


def decode(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(value AS STRING) AS text")


def parse_rows(messages: DataFrame, schema) -> DataFrame:
    """One JSON object per message. Bad JSON gives a row of NULLs, not an error.

    The generator keeps later filters from being pushed into a second parse.
    """
    return decode(messages).select(F.inline(F.array(F.from_json("text", schema))))


def first_within(rows: DataFrame, within: str, key) -> DataFrame:
    """Leave out rows of a stream whose ``key`` (a name or a column) came before within that time.

    Time is that of the micro-batch a row arrives in, which a repeated batch keeps. So no row
    is ever late and dropped for it, and keys are forgotten once ``within`` has passed.
    """
    told = rows.withColumns({"__key": F.col(key) if isinstance(key, str) else key,
                             "__arrived": F.current_timestamp()})
    return (told.withWatermark("__arrived", within).dropDuplicatesWithinWatermark(["__key"])
            .select(*[F.col(f"`{c}`") for c in rows.columns]))


def to_messages(rows: DataFrame) -> DataFrame:
    """Every row as one JSON message in a binary ``value`` column."""
    return rows.select(F.encode(row_json(), "UTF-8").alias("value"))


def publish(rows: DataFrame, location: str | None = None, mode: str = "append",
            **broker_options) -> None:
    """Send rows as messages to a broker topic, or to a folder of text files."""
    messages = to_messages(rows)
    if location is None:
        messages.write.format("kafka").options(**broker_options).save()
    else:
        decode(messages).write.mode(mode).text(location)


def await_or_stop(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for the query; stop it when the time is up or the wait is interrupted."""
    try:
        return bool(query.awaitTermination(timeout)) if timeout else query.awaitTermination() is None
    finally:
        if query.isActive:
            query.stop()
