"""Job: train on the next batch, validate, promote, and score transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from millrace.operators import model as M
from millrace.operators.boosting import TREE_SCHEMA, trees_of
from millrace.operators.joins import lookup_join
from millrace.operators.split import hashed_order, stratified_split
from millrace.schemas import TRANSACTION_LABEL
from millrace.session import path_exists
from millrace.sources.batches import (list_batches, mark_processed, next_batch, read_processed,
                                      retire_batches)
from millrace.sources.messages import await_or_stop, folder_stream, topic_stream
from millrace.streaming.retrain import start_retraining, training_files
from millrace.streaming.scoring import start_following, start_scoring

ACCEPTED, REJECTED = "accepted", "rejected"
_PROMOTION = "run string, auc double, path string, at timestamp"


@dataclass(frozen=True)
class Outcome:
    run: str
    auc: float | None
    promoted: bool


class ModelStore:
    """Candidate models by run, their metrics, and the list of promotions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def production_path(self) -> str | None:
        """The model promoted last. A promotion is one appended row, so readers
        see the old model or the new one, never half of either."""
        location = f"{self.root}/promotions"
        if not path_exists(self.spark, location):
            return None
        return (self.spark.read.schema(_PROMOTION).parquet(location)
                .agg(F.max_by("path", "at")).first()[0])

    def production(self) -> M.FraudModel | None:
        path = self.production_path()
        return self.load(path) if path else None

    def save_candidate(self, run: str, model: M.FraudModel) -> str:
        """The model as a list of parts: the trees of ``run`` are written, those before named."""
        path = f"{self.root}/candidates/{run}"
        model.encoder.write().overwrite().save(f"{path}/encoder")
        parts = [(i, part.run) for i, part in enumerate(model.parts)]
        inputs = list(enumerate(model.numeric))
        trees = [row for i, tree in enumerate(model.parts[-1].trees) for row in tree.rows(i)]
        for name, rows, schema in (("parts", parts, "number int, run string"),
                                   ("inputs", inputs, "number int, name string"),
                                   ("trees", trees, TREE_SCHEMA)):
            (self.spark.createDataFrame(rows, schema).coalesce(1)
                .write.mode("overwrite").parquet(f"{path}/{name}"))
        return path

    def trees_path(self, run: str) -> str:
        return f"{self.root}/candidates/{run}/trees"

    def load(self, path: str) -> M.FraudModel:
        """A model of this store; its trees and names are bounded by the rounds and runs."""
        def column(name, field):
            return [r[field] for r in self.spark.read.parquet(f"{path}/{name}").orderBy("number").collect()]

        parts = tuple(M.Part(run, tuple(trees_of(
            self.spark.read.schema(TREE_SCHEMA).parquet(self.trees_path(run)).collect())))
            for run in column("parts", "run"))
        return M.FraudModel(PipelineModel.load(f"{path}/encoder"), tuple(column("inputs", "name")), parts)

    def split_path(self, run: str) -> str:
        return f"{self.root}/splits/run={run}"

    def promoted_training_rows(self, schema: StructType) -> DataFrame | None:
        """Training parts of all promoted runs, in one scan that reads only their folders."""
        location = f"{self.root}/promotions"
        if not path_exists(self.spark, location):
            return None
        runs = self.spark.read.schema(_PROMOTION).parquet(location).select("run").distinct()
        stored = StructType([*schema.fields, StructField("run", StringType()),
                             StructField("is_test", BooleanType())])
        splits = self.spark.read.schema(stored).parquet(f"{self.root}/splits")
        return (lookup_join(splits.where("NOT is_test"), runs, "run", "run", "left_semi")
                .select(*schema.names))

    def save_metrics(self, run: str, report: DataFrame, auc: float | None) -> None:
        """The report as a table and as text; it has one row per class and three more."""
        rows = report.collect()
        table = self.spark.createDataFrame(rows, report.schema)
        (table.withColumn("auc", F.lit(auc).cast("double")).coalesce(1)
              .write.mode("overwrite").parquet(f"{self.root}/metrics/run={run}"))
        text = self.spark.createDataFrame([(M.render_report(rows, auc),)], "value string")
        text.write.mode("overwrite").text(f"{self.root}/reports/{run}")

    def save_weights(self, run: str, train: DataFrame) -> None:
        """Rows (label, weight, rows): what a row of each class counts in training."""
        (M.weighted(train).groupBy(F.col(TRANSACTION_LABEL).alias("label"), "weight")
            .agg(F.count(F.lit(1)).alias("rows")).coalesce(1)
            .write.mode("overwrite").parquet(f"{self.root}/weights/run={run}"))

    def promote(self, run: str, auc: float, path: str) -> None:
        row = self.spark.createDataFrame([(run, auc, path)], "run string, auc double, path string")
        (row.withColumn("at", F.current_timestamp()).coalesce(1)
            .write.mode("append").parquet(f"{self.root}/promotions"))


def train_and_promote(batch: DataFrame, store: ModelStore, run: str, order=None,
                      params: M.BoostingParams = M.BoostingParams(),
                      gate: float = M.PROMOTION_AUC, fit_rows: int | None = None,
                      edges: list | None = None) -> Outcome:
    """Train on 80 % of ``batch``, continuing the model in production.

    That model's trees stay as they are: new ones are fitted to what its margin leaves over, on
    this batch alone. The split is stored once and read from there. ``fit_rows`` bounds the
    labelled rows to fit on, drawn evenly; all test rows are scored. A run that is repeated
    continues what was there before it.
    """
    spark, label = batch.sparkSession, TRANSACTION_LABEL
    parts = store.split_path(run)
    split = stratified_split(batch, label, order or hashed_order(*batch.columns))
    split.write.mode("overwrite").partitionBy("is_test").parquet(parts)
    train = M.drop_identifiers(spark.read.parquet(f"{parts}/is_test=false"))
    test = M.drop_identifiers(spark.read.parquet(f"{parts}/is_test=true"))
    if fit_rows is not None:
        train = train.sample(min(1.0, fit_rows / max(1, train.count())), seed=params.seed)
    store.save_weights(run, train)

    model = M.train_model(train, M.numeric_columns(train), store.production(), params, run, edges=edges)
    path = store.save_candidate(run, model)

    scored = M.predict(model, test).select(label, "predicted", "score").persist()
    report, auc_row = M.validate(scored)
    auc = auc_row.first()["auc"]
    store.save_metrics(run, report, auc)
    scored.unpersist()
    promoted = M.passes_gate(auc, gate)
    if promoted:
        store.promote(run, auc, path)
    return Outcome(run, auc, promoted)


def retrain_on_new_batches(spark: SparkSession, folder: str, schema: StructType, store: ModelStore,
                           checkpoint: str, params: M.BoostingParams = M.BoostingParams(),
                           gate: float = M.PROMOTION_AUC, archive_to: str | None = None,
                           timeout: int | None = None) -> list[Outcome]:
    """Train and promote once for every batch that appeared since the last call."""
    outcomes: list[Outcome] = []

    def train(rows: DataFrame, number: int) -> None:
        outcomes.append(train_and_promote(rows, store, f"batch-{number}", params=params, gate=gate))

    files = training_files(spark, folder, schema, archive_to)
    await_or_stop(start_retraining(files, train, checkpoint), timeout)
    return outcomes


def score_transactions(spark: SparkSession, store: ModelStore, schema: StructType, *, alerts: str,
                       checkpoint: str, servers: str | None = None,
                       topic: str = "financial-transactions", folder: str | None = None,
                       available_now: bool = False, timeout: int | None = None,
                       follow: bool = False, once_within: str | None = None,
                       max_files: int | None = None) -> None:
    """Score the stream of transactions with the production model and keep the alerts.

    Messages come from a broker topic, or from a folder of message files. With ``follow`` a
    model promoted meanwhile scores from the next micro-batch on; ``once_within`` leaves out
    what is sent again within that time.
    """
    model = store.production()
    if model is None:
        raise ValueError(f"no model was promoted in {store.root}")
    messages = folder_stream(spark, folder, max_files) if folder else topic_stream(spark, servers, topic)
    trigger = {"availableNow": True} if available_now else None
    start, scorer = (start_following, store) if follow else (start_scoring, model)
    await_or_stop(start(messages, schema, scorer, alerts, checkpoint, trigger, once_within), timeout)


def train_next(spark: SparkSession, folder: str, processed: str, store: ModelStore,
               params: M.BoostingParams = M.BoostingParams(), gate: float = M.PROMOTION_AUC,
               archive: str | None = None) -> Outcome | None:
    """Train on the next unused batch.

    When all were used the result is ``None``, and with ``archive`` the used
    batches are moved there so that their numbers can come again.
    """
    found = next_batch(list_batches(spark, folder), read_processed(spark, processed)).first()
    if found is None:
        if archive:
            retire_batches(spark, folder, processed, archive)
        return None
    run = f"batch-{found['batch_id']}-{found['modified']:%Y%m%dT%H%M%S}"
    outcome = train_and_promote(spark.read.parquet(found["path"]), store, run,
                                params=params, gate=gate)
    mark_processed(spark, processed, found["batch_id"], found["modified"],
                   ACCEPTED if outcome.promoted else REJECTED)
    return outcome
