"""Features, training, validation and promotion of the fraud model."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.boosting import BoostingParams, Tree, boost, margins, staged_margins
from millrace.operators.metrics import classification_report, imbalance_ratio, roc_auc
from millrace.schemas import TRANSACTION_CATEGORY, TRANSACTION_IDS, TRANSACTION_LABEL

# Fixed value: lowest ROC-AUC a model may have to be promoted (inclusive).
PROMOTION_AUC = 0.95


@dataclass(frozen=True)
class Part:
    """The trees that one run added to an ensemble."""

    run: str
    trees: tuple[Tree, ...]


@dataclass(frozen=True)
class FraudModel:
    """An encoder, the numeric columns in order, and the parts of the ensemble in order."""

    encoder: PipelineModel
    numeric: tuple[str, ...]
    parts: tuple[Part, ...] = ()
    category: str = TRANSACTION_CATEGORY

    @property
    def trees(self) -> list[Tree]:
        return [tree for part in self.parts for tree in part.trees]

    @property
    def width(self) -> int:
        return len(self.encoder.stages[0].labels) + len(self.numeric)

    def featured(self, rows: DataFrame, name: str = "features") -> DataFrame:
        """Add the features as one array of doubles."""
        vectors = assembler(list(self.numeric), self.category, "__vector").transform(
            self.encoder.transform(rows))
        return vectors.withColumn(name, vector_to_array("__vector")).select(*rows.columns, name)

    def with_margin(self, rows: DataFrame, name: str = "margin") -> DataFrame:
        """Add the log-odds of class 1: the sum of all trees."""
        found = self.featured(rows, "__features")
        return found.withColumn(name, margins(F.col("__features"), self.trees)).drop("__features")

    def before(self, run: str) -> "FraudModel":
        """The ensemble as it was before ``run`` added to it."""
        names = [part.run for part in self.parts]
        return replace(self, parts=self.parts[:names.index(run)]) if run in names else self


def drop_identifiers(transactions: DataFrame) -> DataFrame:
    return transactions.drop(*TRANSACTION_IDS)


def numeric_columns(transactions: DataFrame, category: str = TRANSACTION_CATEGORY,
                    label: str = TRANSACTION_LABEL, extra: tuple[str, ...] = ()) -> list[str]:
    """Every column but the ids, the category and the label, in source order."""
    other = {*TRANSACTION_IDS, category, label, *extra}
    return [c for c in transactions.columns if c not in other]


def fit_encoder(train: DataFrame, category: str = TRANSACTION_CATEGORY) -> PipelineModel:
    """One-hot slots per category in alphabetical order; unseen ones are all zeros."""
    indexer = StringIndexer(inputCol=category, outputCol=f"{category}_index",
                            handleInvalid="keep", stringOrderType="alphabetAsc")
    one_hot = OneHotEncoder(inputCol=f"{category}_index", outputCol=f"{category}_slots",
                            dropLast=True)
    return Pipeline(stages=[indexer, one_hot]).fit(train)


def assembler(numeric: list[str], category: str = TRANSACTION_CATEGORY,
              output: str = "features") -> VectorAssembler:
    """Category slots first, then the numeric columns."""
    return VectorAssembler(inputCols=[f"{category}_slots", *numeric], outputCol=output,
                           handleInvalid="keep")


def slot_columns(encoded: DataFrame, encoder: PipelineModel,
                 category: str = TRANSACTION_CATEGORY) -> DataFrame:
    """The one-hot slots as plain columns ``<category>_<value>``."""
    slots = vector_to_array(F.col(f"{category}_slots"))
    return encoded.withColumns({
        f"{category}_{value}": slots[i] for i, value in enumerate(encoder.stages[0].labels)})


def weighted(train: DataFrame, label: str = TRANSACTION_LABEL) -> DataFrame:
    """Add ``weight``: negatives per positive for a positive row, 1 otherwise."""
    ratio = imbalance_ratio(train, label).first()["ratio"]
    if ratio is None:
        raise ValueError("no positive rows to train on")
    return train.withColumn(
        "weight", F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def train_model(train: DataFrame, numeric: list[str], previous: FraudModel | None = None,
                params: BoostingParams = BoostingParams(), run: str = "first",
                category: str = TRANSACTION_CATEGORY, label: str = TRANSACTION_LABEL,
                edges: list | None = None) -> FraudModel:
    """Boosted trees fitted on ``train``, weighted against its imbalance.

    With ``previous`` its encoder, columns and parts stay as they are and a further part is
    fitted from their margin; only ``train`` is read. Without it the encoder is fitted too.
    """
    start = previous.before(run) if previous else FraudModel(
        fit_encoder(train, category), tuple(numeric), (), category)
    rows, margin = weighted(train, label), None
    if start.parts:
        rows, margin = start.with_margin(rows, "__margin"), "__margin"
    first = len(start.trees)
    trees = boost(start.featured(rows, "__features"), start.width, params, "__features", label,
                  "weight", margin, first, edges)
    return replace(start, parts=(*start.parts, Part(run, tuple(trees))))


def predict(model: FraudModel, rows: DataFrame) -> DataFrame:
    """Add ``predicted`` (0/1) and ``score`` (probability of class 1)."""
    scored = model.with_margin(rows, "__margin")
    return (scored.withColumn("predicted", (F.col("__margin") > 0).cast("int"))
            .withColumn("score", 1 / (1 + F.exp(-F.col("__margin")))).drop("__margin"))


def staged_scores(model: FraudModel, rows: DataFrame) -> DataFrame:
    """Rows (label, round, score): the margin after each tree, scored once per row."""
    found = model.featured(rows, "__features")
    stages = found.select(TRANSACTION_LABEL, staged_margins(F.col("__features"), model.trees).alias("s"))
    return stages.select(F.col(TRANSACTION_LABEL).alias("label"), F.posexplode("s").alias("round", "score"))


def staged_auc(model: FraudModel, rows: DataFrame) -> DataFrame:
    """ROC-AUC after each tree: rows (round, auc, positives, negatives), rounds from 0."""
    return roc_auc(staged_scores(model, rows), group="round")


def validate(predictions: DataFrame, label: str = TRANSACTION_LABEL) -> tuple[DataFrame, DataFrame]:
    """Classification report and ROC-AUC row of scored test rows."""
    return (classification_report(predictions, label, "predicted"),
            roc_auc(predictions, label, "score"))


def passes_gate(auc: float | None, gate: float = PROMOTION_AUC) -> bool:
    return auc is not None and auc >= gate


def render_report(report_rows: list, auc: float | None, digits: int = 4) -> str:
    """The report as text; ``report_rows`` are the few rows of a collected report."""
    def number(value):
        return "" if value is None else f"{value:.{digits}f}"

    lines = [f"{'':>12} {'precision':>9} {'recall':>9} {'f1-score':>9} {'support':>9}", ""]
    for row in report_rows:
        lines.append(f"{row['class']:>12} {number(row['precision']):>9} {number(row['recall']):>9} "
                     f"{number(row['f1']):>9} {row['support']:>9}")
    return "\n".join([*lines, "", f"ROC-AUC : {auc}"])
