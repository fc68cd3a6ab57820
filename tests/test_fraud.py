from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import model as M
from millrace.operators.metrics import classification_report, imbalance_ratio, roc_auc
from millrace.operators.split import hashed_order, stratified_split
from millrace.plans.fraud import (ModelStore, retrain_on_new_batches, score_transactions,
                                  train_and_promote, train_next)
from millrace.sources.batches import read_processed
from millrace.sources.messages import folder_stream, publish
from millrace.streaming.retrain import start_retraining, training_files
from millrace.streaming.scoring import fraud_alerts, start_following, start_scoring
from tests.helpers import rows, values

SMALL = M.BoostingParams(rounds=3, depth=3, learning_rate=0.5)


# --- split ---------------------------------------------------------------------------------

def check_split(given, flagged, label, share=0.2):
    assert rows(flagged.drop("is_test")) == rows(given)
    sizes = Counter(r[0] for r in given.select(label).collect())
    tests = Counter(r[0] for r in flagged.where("is_test").select(label).collect())
    for value, size in sizes.items():
        assert tests[value] == int(size * share + 0.5), (value, size, tests[value])


@pytest.fixture
def stored(spark, tmp_path):
    """Write and read back: a split needs a scan of files."""
    def write(df):
        df.repartition(5).write.parquet(str(tmp_path / "rows"))
        return spark.read.parquet(str(tmp_path / "rows"))
    return write


def test_split_is_complete_and_exact(spark, stored):
    given = stored(spark.range(4001).selectExpr("id", "CAST(id % 50 = 0 AS INT) AS y"))
    check_split(given, stratified_split(given, "y", hashed_order("id")), "y")


def test_split_of_copies(spark, stored):
    """A third of the rows are the same row; the share is exact all the same."""
    given = stored(spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 7, id) AS id", "CAST(id % 10 = 0 AS INT) AS y"))
    check_split(given, stratified_split(given, "y", hashed_order("id", "y")), "y")


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_with_tiny_and_null_classes(spark, stored, share):
    given = stored(spark.createDataFrame(
        [(i, "a" if i < 7 else "b" if i == 7 else None) for i in range(12)], "id long, y string"))
    flagged = stratified_split(given, "y", hashed_order("id"), share)
    assert flagged.count() == 12
    tests = Counter(r["y"] for r in flagged.where("is_test").collect())
    assert tests == Counter({k: n for k, n in (
        ("a", int(7 * share + 0.5)), ("b", int(share + 0.5)), (None, int(4 * share + 0.5))) if n})


def test_split_with_many_classes(spark, tmp_path):
    given = spark.range(60_000).select((F.col("id") % 12_000).alias("label"), "id")
    given.write.parquet(str(tmp_path / "many"))
    flagged = stratified_split(spark.read.parquet(str(tmp_path / "many")), "label", hashed_order("id"))
    per_class = flagged.groupBy("label").agg(F.count_if("is_test").alias("n"), F.count("*").alias("all"))
    assert per_class.where("n = 1 AND all = 5").count() == 12_000


def test_encoder_with_many_categories(spark):
    given = spark.range(24_000).select((F.col("id") % 12_000).cast("string").alias("type"))
    assert len(M.fit_encoder(given).stages[0].labels) == 12_000


def test_split_follows_the_order(spark, stored):
    given = stored(spark.range(100).selectExpr("id", "1 AS y"))
    flagged = stratified_split(given, "y", [F.shiftright("id", 4), F.col("id")], 0.3)
    assert sorted(r["id"] for r in flagged.where("is_test").collect()) == list(range(30))


def test_split_is_repeatable_and_seeded(spark, stored):
    given = stored(spark.range(500).selectExpr("id", "CAST(id % 2 AS INT) AS y"))
    same = [rows(stratified_split(given, "y", hashed_order("id", seed=s))) for s in (42, 42, 7)]
    assert same[0] == same[1] != same[2]


# --- metrics -------------------------------------------------------------------------------

def test_report_of_known_counts(spark):
    """9,985 negatives and 15 positives with 4 false alarms and 6 misses."""
    counts = spark.createDataFrame([(0, 0, 9981), (0, 1, 4), (1, 1, 9), (1, 0, 6)],
                                   "label int, prediction int, n int")
    predictions = counts.select("label", "prediction", F.explode(F.sequence(F.lit(1), "n")))
    report = {r["class"]: r for r in classification_report(predictions).collect()}
    rounded = {k: tuple(None if v is None else round(v, 4)
                        for v in (r["precision"], r["recall"], r["f1"])) + (r["support"],)
               for k, r in report.items()}
    assert rounded == {
        "0": (0.9994, 0.9996, 0.9995, 9985), "1": (0.6923, 0.6, 0.6429, 15),
        "accuracy": (None, None, 0.999, 10000),
        "macro avg": (0.8459, 0.7998, 0.8212, 10000),
        "weighted avg": (0.9989, 0.999, 0.999, 10000)}
    text = M.render_report(list(report.values()), 0.95)
    assert "weighted avg" in text and "0.6429" in text and "ROC-AUC : 0.95" in text


def test_report_with_a_class_never_predicted(spark):
    report = classification_report(spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int"))
    assert report.where("class = '1'").select("precision", "recall", "f1", "support").first() == (0, 0, 0, 1)


def brute_auc(scored):
    pos = [s for s, y in scored if y == 1]
    neg = [s for s, y in scored if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("distinct", [3, 40, 10_000])
def test_auc_against_brute_force(spark, distinct):
    rng = random.Random(distinct)
    scored = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.1)) for _ in range(800)]
    frame = spark.createDataFrame(scored, "score double, label int").repartition(7)
    auc = roc_auc(frame).first()
    assert auc["auc"] == pytest.approx(brute_auc(scored), abs=1e-12)
    assert auc["positives"] == sum(y for _, y in scored)
    mirrored = roc_auc(frame.withColumn("score", -F.col("score"))).first()["auc"]
    assert auc["auc"] + mirrored == pytest.approx(1, abs=1e-12)


def test_auc_with_one_hot_score(spark):
    scored = [(0.5, i % 7 == 0) for i in range(400)] + [(i / 800, i % 5 == 0) for i in range(800)]
    frame = spark.createDataFrame([(s, int(y)) for s, y in scored], "score double, label int")
    assert roc_auc(frame).first()["auc"] == pytest.approx(brute_auc(scored), abs=1e-12)


def test_auc_needs_both_classes(spark):
    only = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, label int")
    assert roc_auc(only).first() == (None, 0, 2)
    assert roc_auc(only.limit(0)).first() == (None, 0, 0)


def test_imbalance(spark):
    labels = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "label int")
    assert imbalance_ratio(labels).first() == (3, 1, 3.0)
    assert imbalance_ratio(labels.where("label = 0")).first() == (3, 0, None)


# --- features and model --------------------------------------------------------------------

def transactions(spark, count=600, start=0):
    """Fraud is a large TRANSFER; amounts, types and steps vary."""
    return spark.range(start, start + count).selectExpr(
        "CAST(id % 700 AS INT) AS step",
        "element_at(array('CASH_OUT','PAYMENT','TRANSFER'), CAST(id % 3 AS INT) + 1) AS type",
        "CAST((id * 7919) % 1000 AS DOUBLE) AS amount",
        "concat('C', id) AS nameOrig", "concat('M', id % 50) AS nameDest",
        "CAST(id % 3 = 2 AND (id * 7919) % 1000 > 600 AS INT) AS isFraud")


def test_unseen_category_is_all_zeros(spark):
    rows_ = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "type string")
    encoder = M.fit_encoder(rows_.where("type < 'c'"))
    slots = encoder.transform(rows_).select("type", vector_to_array("type_slots").alias("s"))
    assert {r["type"]: list(r["s"]) for r in slots.collect()} == {
        "a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0], None: [0.0, 0.0]}
    named = M.slot_columns(encoder.transform(rows_), encoder)
    assert {"type_a", "type_b"} <= set(named.columns)


def test_numeric_columns_keep_their_order(spark):
    assert M.numeric_columns(transactions(spark)) == ["step", "amount"]


def test_weights(spark):
    labels = spark.createDataFrame([(0,), (0,), (0,), (1,)], "isFraud int")
    assert Counter(r["weight"] for r in M.weighted(labels).collect()) == {1.0: 3, 3.0: 1}
    with pytest.raises(ValueError):
        M.weighted(labels.where("isFraud = 0"))


def test_gate():
    assert M.passes_gate(0.95) and not M.passes_gate(0.9499) and not M.passes_gate(None)


def test_train_validate_promote(spark, tmp_path, stored):
    store = ModelStore(spark, str(tmp_path / "models"))
    batch = stored(transactions(spark))
    assert store.production() is None and store.promoted_training_rows(batch.schema) is None
    rejected = train_and_promote(batch, store, "r0", params=SMALL, gate=1.1)
    assert not rejected.promoted and store.production() is None
    done = train_and_promote(batch, store, "r1", params=SMALL)
    assert done.promoted and done.auc >= 0.95
    assert store.production_path().endswith("r1")
    metrics = spark.read.parquet(f"{store.root}/metrics/run=r1")
    assert metrics.where("class = 'accuracy'").first()["support"] == 120
    report = "\n".join(r[0] for r in spark.read.text(f"{store.root}/reports/r1").collect())
    assert "weighted avg" in report and "ROC-AUC" in report
    train = store.promoted_training_rows(batch.schema)
    assert train.count() == 480 and train.columns == batch.columns

    # The encoder of production is kept, so a new type has no slot of its own.
    other = batch.withColumn("type", F.when(F.col("type") == "PAYMENT", "DEBIT").otherwise(F.col("type")))
    train_and_promote(other, store, "r2", params=SMALL)
    assert store.production_path().endswith("r2")
    assert store.production().encoder.stages[0].labels == ["CASH_OUT", "PAYMENT", "TRANSFER"]
    assert store.promoted_training_rows(batch.schema).count() == 960


def test_batches_are_used_once_in_order(spark, tmp_path):
    folder, done = str(tmp_path / "in"), str(tmp_path / "done")
    store = ModelStore(spark, str(tmp_path / "models"))
    for number in (10, 2):
        transactions(spark, 300, number * 1000).coalesce(1).write.parquet(
            f"{folder}/Training_data_{number}.parquet")
    used = str(tmp_path / "used")
    assert train_next(spark, folder, done, store, SMALL, gate=1.1).run.startswith("batch-2-")
    assert train_next(spark, folder, done, store, SMALL, gate=0.5).run.startswith("batch-10-")
    assert train_next(spark, folder, done, store, SMALL, archive=used) is None
    assert rows(read_processed(spark, done).select("batch_id", "status")) == [
        (10, "accepted"), (2, "rejected")]

    # All were used: they moved away, and a number may come again.
    assert len(list((tmp_path / "used").glob("*.parquet"))) == 2
    transactions(spark, 300, 5000).coalesce(1).write.parquet(f"{folder}/Training_data_2.parquet")
    assert train_next(spark, folder, done, store, SMALL, gate=0.5).run.startswith("batch-2-")


def test_new_files_start_training_once(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    archive, seen = str(tmp_path / "used"), []
    folder.mkdir()

    def put(number):
        transactions(spark, 30 + number).toPandas().to_parquet(folder / f"Training_data_{number}.parquet")

    def run():
        files = training_files(spark, str(folder), transactions(spark).schema, archive)
        start_retraining(files, lambda batch, number: seen.append((number, batch.count())),
                         checkpoint).awaitTermination(60)

    put(0), put(1)
    run()
    assert sorted(seen) == [(0, 30), (1, 31)]
    put(12)
    run()
    assert seen[2:] == [(12, 42)]

    # A folder of part files is one batch, a file without a number none.
    elsewhere = tmp_path / "elsewhere"
    transactions(spark, 40).repartition(3).write.parquet(str(elsewhere / "Training_data_3.parquet"))
    (elsewhere / "Training_data_3.parquet").rename(folder / "Training_data_3.parquet")
    transactions(spark, 5).toPandas().to_parquet(folder / "notes.parquet")
    run()
    assert seen[3:] == [(3, 40)]


def test_retraining_and_scoring_jobs(spark, tmp_path):
    store, schema = ModelStore(spark, str(tmp_path / "models")), transactions(spark).schema
    folder, alerts = tmp_path / "in", str(tmp_path / "alerts")
    with pytest.raises(ValueError):
        score_transactions(spark, store, schema, alerts=alerts, checkpoint="x", folder=str(folder))
    transactions(spark).repartition(2).write.parquet(str(folder / "Training_data_4.parquet"))

    def retrain():
        return retrain_on_new_batches(spark, str(folder), schema, store, str(tmp_path / "trained"),
                                      SMALL, gate=0.5, timeout=240)

    assert [(o.run, o.promoted) for o in retrain()] == [("batch-4", True)]
    assert retrain() == []
    unlabelled = transactions(spark).drop("isFraud")
    publish(unlabelled, str(tmp_path / "messages"))
    score_transactions(spark, store, unlabelled.schema, alerts=alerts, available_now=True, timeout=120,
                       checkpoint=str(tmp_path / "scored"), folder=str(tmp_path / "messages"))
    assert rows(spark.read.parquet(alerts)) == rows(fraud_alerts(unlabelled, store.production()))


def test_stream_alerts_equal_batch_alerts(spark, tmp_path):
    labelled = transactions(spark)
    train = M.drop_identifiers(labelled)
    model = M.train_model(train, M.numeric_columns(train), params=SMALL)
    unlabelled = labelled.drop("isFraud")
    expected = rows(fraud_alerts(unlabelled, model))
    assert expected and expected[0][0].startswith("txn_")

    root = str(tmp_path)
    publish(unlabelled, f"{root}/in")
    values(spark, ["garbage", '{"step":1}']).write.mode("append").text(f"{root}/in")
    for _ in range(2):
        start_scoring(folder_stream(spark, f"{root}/in", max_files=2), unlabelled.schema, model,
                      f"{root}/alerts", f"{root}/checkpoint",
                      {"availableNow": True}).awaitTermination(120)
        assert rows(spark.read.parquet(f"{root}/alerts")) == expected
    sample = spark.createDataFrame([(124, "C123456789", "C987654321")],
                                   "step int, nameOrig string, nameDest string")
    from millrace.streaming.scoring import with_transaction_id
    assert with_transaction_id(sample).first()["transaction_id"] == "txn_124C123456789C987654321"


@pytest.fixture
def two_models(spark, tmp_path):
    """Unlabelled transactions and a store with a first model; promote(n) adds another one."""
    store = ModelStore(spark, str(tmp_path / "models"))
    labelled = transactions(spark)
    train = M.drop_identifiers(labelled)

    def promote(run, flip=False):
        given = train.withColumn("isFraud", 1 - F.col("isFraud")) if flip else train
        model = M.train_model(given, M.numeric_columns(given), params=SMALL, run=run)
        store.promote(run, 1.0, store.save_candidate(run, model))
        return model

    return labelled.drop("isFraud"), store, promote


def test_messages_sent_again_raise_one_alert(spark, tmp_path, two_models):
    given, store, promote = two_models
    expected = rows(fraud_alerts(given, promote("one")))
    folder, alerts = str(tmp_path / "messages"), str(tmp_path / "alerts")
    for sent in (3, 1, 1):  # within a batch, across batches, over a restart
        for _ in range(sent):
            publish(given, folder)
        values(spark, ["garbage", "garbage"]).write.mode("append").text(folder)
        score_transactions(spark, store, given.schema, alerts=alerts, checkpoint=str(tmp_path / "c"),
                           folder=folder, max_files=3, available_now=True, once_within="2 hours")
        assert rows(spark.read.parquet(alerts)) == expected


def test_two_transactions_of_one_id_both_count(spark, tmp_path, two_models):
    """The id is not the message: one that is no fraud does not hide the one that is."""
    given, store, promote = two_models
    alert = fraud_alerts(given, promote("one")).first()["transaction_id"]
    row = given.where(F.concat(F.lit("txn_"), "step", "nameOrig", "nameDest") == alert)
    for follow in (False, True):
        folder, alerts = str(tmp_path / f"in{follow}"), str(tmp_path / f"alerts{follow}")
        for amount in (F.lit(0.0), F.col("amount")):
            publish(row.withColumn("amount", amount), folder)
        score_transactions(spark, store, given.schema, alerts=alerts, checkpoint=str(tmp_path / f"c{follow}"),
                           folder=folder, max_files=1, available_now=True, once_within="2 hours", follow=follow)
        found = spark.read.option("recursiveFileLookup", "true").parquet(alerts)
        assert alert in {r["transaction_id"] for r in found.collect()}


def test_a_promoted_model_scores_the_next_batch(spark, tmp_path, two_models):
    given, store, promote = two_models
    early, late = given.where("step % 2 = 0"), given.where("step % 2 = 1")
    folder, alerts, checkpoint = (str(tmp_path / n) for n in ("messages", "alerts", "checkpoint"))

    def found():
        rows_ = spark.read.option("recursiveFileLookup", "true").parquet(alerts)
        return rows(rows_.select("transaction_id", F.substring_index("model", "/", -1)))

    def of(batch, model, run):
        return [(r[0], run) for r in rows(fraud_alerts(batch, model))]

    one = promote("one")
    publish(early, folder)
    query = start_following(folder_stream(spark, folder), given.schema, store, alerts, checkpoint)
    try:
        query.processAllAvailable()
        assert found() == sorted(of(early, one, "one"), key=repr)
        two = promote("two", flip=True)
        publish(late, folder)
        query.processAllAvailable()
    finally:
        query.stop()
    expected = sorted(of(early, one, "one") + of(late, two, "two"), key=repr)
    assert found() == expected

    # The last batch runs again, as after a crash before its commit: it keeps its model.
    promote("three")
    commits = sorted((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()),
                     key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    start_following(folder_stream(spark, folder), given.schema, store, alerts, checkpoint,
                    {"availableNow": True}).awaitTermination(120)
    assert found() == expected


def test_following_wants_a_model_and_leaves_out_repeats(spark, tmp_path, two_models):
    given, store, promote = two_models
    folder, alerts = str(tmp_path / "messages"), str(tmp_path / "alerts")
    expected = rows(fraud_alerts(given, promote("one")))
    for _ in range(2):
        publish(given, folder), publish(given, folder)
        score_transactions(spark, store, given.schema, alerts=alerts, checkpoint=str(tmp_path / "c"), max_files=2,
                           folder=folder, available_now=True, follow=True, once_within="1 day")
        found = spark.read.option("recursiveFileLookup", "true").parquet(alerts)
        assert rows(found.select("transaction_id", "alert")) == expected
