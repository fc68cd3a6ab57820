"""Classification report and exact ROC-AUC as relational aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _ratio(top, bottom):
    """0 instead of a division by zero, as in the usual report."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def classification_report(predictions: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Rows ``(class, precision, recall, f1, support)`` per class and for the averages.

    The accuracy row holds the accuracy in ``f1``, its precision and recall are NULL.
    """
    confusion = predictions.groupBy(
        F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    marginal = confusion.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"),
                 F.col("n").alias("predicted"), none.alias("hits")))).alias("m")).select("m.*")
    totals = marginal.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"))
    scored = totals.withColumns({
        "precision": _ratio(F.col("hits"), F.col("predicted")),
        "recall": _ratio(F.col("hits"), F.col("support")),
        "f1": _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")),
    })
    per_class = scored.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")

    def weighted(measure):
        return _ratio(F.sum(F.col(measure) * F.col("support")), F.sum("support"))

    support = F.sum("support").alias("support")
    missing = F.lit(None).cast("double")
    overall = scored.agg(F.array(
        F.struct(F.lit("accuracy").alias("class"), missing.alias("precision"),
                 missing.alias("recall"), _ratio(F.sum("hits"), F.sum("support")).alias("f1"), support),
        F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), support),
        F.struct(F.lit("weighted avg").alias("class"), weighted("precision").alias("precision"),
                 weighted("recall").alias("recall"), weighted("f1").alias("f1"), support),
    ).alias("rows"))
    return per_class.unionByName(overall.select(F.explode("rows").alias("r")).select("r.*"))


def roc_auc(scores: DataFrame, label: str = "label", score: str = "score",
            group: str | None = None) -> DataFrame:
    """One row ``(auc, positives, negatives)``; ties count half, NULL if a class is absent.

    With ``group`` one row per value of that column, which comes first. Rows collapse to one
    per distinct score. Those are cut into score ranges, each ranked by itself, and every
    range adds the negatives of the ranges before it; only the totals per range (of a group)
    meet in one task.
    """
    by = [group] if group else []
    positive = (F.col(label) == 1).cast("long")
    per_score = scores.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    ranges = per_score.repartitionByRange(*by, "score").withColumn("range", F.spark_partition_id())

    before = Window.partitionBy(*by, "range").orderBy("score").rowsBetween(
        Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("neg").over(before), F.lit(0))
    twice = (2 * lower + F.col("neg")).cast("decimal(19,0)") * F.col("pos").cast("decimal(18,0)")
    totals = ranges.withColumn("twice", twice).groupBy(*by, "range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("twice").alias("twice"))

    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifted = totals.withColumn("lower", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    carried = 2 * F.col("lower").cast("decimal(18,0)") * F.col("pos").cast("decimal(18,0)")
    summed = shifted.groupBy(*by).agg(
        F.sum((F.col("twice") + carried).cast("decimal(38,0)")).alias("twice"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return summed.select(
        *by, F.when(pairs > 0, F.col("twice").cast("double") / (2 * pairs)).alias("auc"),
        "positives", "negatives")


def imbalance_ratio(rows: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive; NULL without positives."""
    negatives = F.count(F.when(F.col(label) == 0, 1))
    positives = F.count(F.when(F.col(label) == 1, 1))
    return rows.agg(negatives.alias("negatives"), positives.alias("positives"),
                    F.when(positives > 0, negatives / positives).alias("ratio"))
