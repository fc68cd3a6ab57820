"""Score a transaction stream and keep the alerts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import transaction_id
from millrace.operators.model import FraudModel, drop_identifiers, predict
from millrace.session import path_exists
from millrace.sources.messages import first_within, parse_rows

# Fixed value: the text of an alert, before the transaction id.
ALERT_TEXT = "ALERT: Fraudulent transaction detected | Transaction_id : "


def with_transaction_id(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("transaction_id", transaction_id(
        F.col("step"), F.col("nameOrig"), F.col("nameDest")))


def fraud_alerts(transactions: DataFrame, model: FraudModel) -> DataFrame:
    """Alert rows of the transactions classed as fraud; batch and streaming alike.

    A message that could not be read has no id and raises no alert.
    """
    known = with_transaction_id(transactions).where("transaction_id IS NOT NULL")
    scored = predict(model, drop_identifiers(known))
    message = F.concat(F.lit(ALERT_TEXT), "transaction_id")
    return (scored.where(F.col("predicted") == 1)
            .select("transaction_id", message.alias("alert")))


def _read(messages, schema):
    return with_transaction_id(parse_rows(messages, schema)).observe(
        "transactions", F.count(F.lit(1)).alias("messages"),
        F.count(F.when(F.col("transaction_id").isNull(), 1)).alias("without_id")).drop("transaction_id")


def start_scoring(messages: DataFrame, schema: T.StructType, model: FraudModel,
                  alerts: str, checkpoint: str, trigger: dict | None = None,
                  once_within: str | None = None) -> StreamingQuery:
    """Append alerts as Parquet, each once. Restart the query to use a newer model.

    The progress of each batch counts its messages and those without an id
    (``observedMetrics["transactions"]``): these raise no alert. With ``once_within`` (such as
    ``"1 day"``) a transaction that is sent again within that time of its alert raises no
    second one. Alerts with one id are equal, so none but repeated ones are left out, and the
    state holds the ids of alerts only, not of all transactions.
    """
    found = fraud_alerts(_read(messages, schema), model)
    if once_within:
        found = first_within(found, once_within, "transaction_id")
    return _writer(found, checkpoint, trigger).format("parquet").start(alerts)


def start_following(messages: DataFrame, schema: T.StructType, store, alerts: str, checkpoint: str,
                    trigger: dict | None = None, once_within: str | None = None) -> StreamingQuery:
    """Score each micro-batch with the model that is in production when it begins.

    ``store`` is a ``ModelStore``. Alerts carry the path of their ``model`` and lie in one folder
    per stream and batch, which a repeated batch replaces. Which model a batch uses is noted
    before its alerts are written, so a repeated batch uses the same one. With ``once_within``
    a message with the same text as one before it within that time is not scored again: a
    newer model would not judge it anew.
    """
    if once_within:
        messages = first_within(messages.select("value"), once_within, F.sha2(F.col("value").cast("binary"), 256))
    used: dict[str, FraudModel] = {}
    stream: list[str] = []

    def score(rows: DataFrame, number: int) -> None:
        if not stream:  # the stream's own name, kept in its checkpoint
            text = rows.sparkSession.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
            stream.append(json.loads(text)["id"])
        path = _noted_model(store, f"{alerts}/_models/stream={stream[0]}/batch={number}")
        if path not in used:
            used.clear()
            used[path] = store.load(path)
        (fraud_alerts(rows, used[path]).withColumn("model", F.lit(path))
            .write.mode("overwrite").parquet(f"{alerts}/stream={stream[0]}/batch={number}"))

    return _writer(_read(messages, schema), checkpoint, trigger).foreachBatch(score).start()


def _noted_model(store, note: str) -> str:
    if path_exists(store.spark, f"{note}/_SUCCESS"):
        return store.spark.read.text(note).first()[0]
    path = store.production_path()
    if path is None:
        raise ValueError(f"no model was promoted in {store.root}")
    store.spark.createDataFrame([(path,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return path


def _writer(rows, checkpoint, trigger):
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer
