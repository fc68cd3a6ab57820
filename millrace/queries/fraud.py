"""Fraud model operators on the given tables: ``orders`` stands in for transactions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import metrics, model
from millrace.operators.split import stratified_split
from millrace.plans.fraud import ModelStore, score_transactions, train_and_promote
from millrace.queries import table
from millrace.schemas import TRANSACTION_LABEL
from millrace.session import scratch_path, settle
from millrace.sources.batches import list_batches, next_batch
from millrace.sources.messages import folder_stream, publish
from millrace.streaming.scoring import ALERT_TEXT, start_following, with_transaction_id

# Labelled rows to fit on; every row is split, scored and reported.
FIT_ROWS = 20_000
MULTIPLIER = 2654435761
# A booster that SQL can state too: few rounds on all rows and columns, with fixed cuts.
PLAIN = model.BoostingParams(rounds=3, depth=2, learning_rate=0.3, row_share=1.0, column_share=1.0)
CUTS = [*[[0.5]] * 5, list(range(300, 2401, 300)), list(range(50_000, 450_001, 50_000)),
        list(range(1, 7)), list(range(25, 251, 25))]
PLAIN_GATE = 0.5


def transactions(spark, folder):
    """Orders as transactions; large ones of one type are the fraud."""
    fraud = (F.col("o_totalprice") > 400_000) & (F.col("o_orderpriority") == "1-URGENT")
    return table(spark, folder, "orders").select(
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).alias("step"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("nameOrig"),
        F.concat(F.lit("M"), F.col("o_orderkey")).alias("nameDest"),
        fraud.cast("int").alias(TRANSACTION_LABEL))


def _labelled(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def _order(key=None):
    """Integer arithmetic both engines agree on; the key settles equal hashes."""
    key = F.col("o_orderkey") if key is None else key
    mixed = key % 2 ** 31 * F.lit(MULTIPLIER) % 2 ** 32
    return [F.shiftright(mixed, 16), mixed, key]


def stratified_split_query(spark, folder):
    flagged = stratified_split(_labelled(spark, folder), "label", _order())
    return flagged.select("o_orderkey", "label",
                          F.when(F.col("is_test"), "test").otherwise("train").alias("part"))


def imbalance_ratio(spark, folder):
    train = stratified_split(_labelled(spark, folder), "label", _order()).where("NOT is_test")
    return metrics.imbalance_ratio(train)


def classification_report(spark, folder):
    predicted = _labelled(spark, folder).withColumn(
        "prediction", (F.col("o_totalprice") > 300_000).cast("int"))
    report = metrics.classification_report(predicted)
    return report.select("class", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")],
                         "support")


def roc_auc(spark, folder):
    scored = _labelled(spark, folder).withColumnRenamed("o_totalprice", "score")
    return metrics.roc_auc(scored).withColumn("auc", F.round("auc", 8))


def roc_auc_tied(spark, folder):
    """Few distinct scores, so most pairs are ties."""
    scored = _labelled(spark, folder).withColumn("score", F.floor(F.col("o_totalprice") / 100_000))
    return metrics.roc_auc(scored).withColumn("auc", F.round("auc", 8))


def one_hot_features(spark, folder):
    """Slots fitted without one category: its rows get zeros. Slots come first."""
    rows = transactions(spark, folder)
    seen = rows.where("type <> '5-LOW'")
    encoder = model.fit_encoder(seen)
    assembled = model.assembler(["step", "amount"]).transform(encoder.transform(rows))
    features = vector_to_array("features")
    width = len(encoder.stages[0].labels) + 2
    return assembled.select("nameDest", *[features[i].alias(f"f{i}") for i in range(width)])


def transaction_ids(spark, folder):
    return with_transaction_id(transactions(spark, folder)).select("transaction_id", "amount")


def next_training_batch(spark, folder):
    """One batch per order year, stored as a folder each; those up to 1997 were used."""
    root = scratch_path(spark, "batches")
    name = F.concat(F.lit("Training_data_"), F.year("o_orderdate") - 1990, F.lit(".parquet"))
    (table(spark, folder, "orders").withColumn("batch", name)
        .write.partitionBy("batch").parquet(f"{root}/in"))
    listed = list_batches(spark, f"{root}/in")
    used = listed.where("batch_id <= 1997 - 1990").withColumn("status", F.lit("accepted"))
    found = next_batch(listed, used.select("batch_id", "modified", "status"))
    rows = spark.read.parquet(found.first()["path"]).agg(F.count(F.lit(1)).alias("rows"))
    return found.select("batch_id").crossJoin(rows)


def order_transactions(spark, folder):
    """Orders with what their lines add up to.

    Most urgent orders of many lines are the fraud, and a few others: by a hash of the key
    that no feature tells, so classes overlap.
    """
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("lines"), F.sum("l_quantity").alias("quantity"))
    joined = transactions(spark, folder).drop(TRANSACTION_LABEL).join(
        lines, F.concat(F.lit("M"), F.col("l_orderkey")) == F.col("nameDest"), "left").drop("l_orderkey")
    filled = joined.fillna({"lines": 0, "quantity": 0.0})
    chance = _order(_key())[0] % 1000
    typical = (F.col("lines") >= 5) & (F.col("type") == "1-URGENT")
    fraud = (typical & (chance < 800)) | (chance >= 998)
    return filled.withColumn(TRANSACTION_LABEL, fraud.cast("int"))


def _key():
    return F.substring("nameDest", 2, 20).cast("bigint")


def _store(spark):
    return ModelStore(spark, scratch_path(spark, "models"))


def train_validate(spark, folder):
    """The default trainer: per class the parts and weight of the run, and the model it stored."""
    store = _store(spark)
    rows = settle(order_transactions(spark, folder))
    outcome = train_and_promote(rows, store, "first", order=_order(_key()), fit_rows=FIT_ROWS)
    parts = spark.read.parquet(f"{store.root}/splits/run=first")
    sizes = parts.groupBy(F.col(TRANSACTION_LABEL).alias("label")).agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows"))
    weights = spark.read.parquet(f"{store.root}/weights/run=first").select(
        F.col("label").alias("of"), F.round("weight", 8).alias("weight"))
    trees = spark.read.parquet(store.trees_path("first"))
    used = trees.where("feature >= 0").groupBy("tree").agg(F.count_distinct("feature").alias("n"))
    stored = trees.agg(F.count_distinct("tree").alias("trees"), F.max("node").alias("node")).select(
        "trees", F.floor(F.log2(F.col("node") + 1.0)).alias("depth"))
    report = spark.read.parquet(f"{store.root}/metrics/run=first").where("class = 'accuracy'")
    facts = stored.crossJoin(used.agg((F.max("n") <= 7).alias("columns_drawn"))).crossJoin(
        report.select(F.col("support").alias("scored"),
                      (F.col("auc") > 0.9).alias("ranks"),
                      ((F.col("auc") >= model.PROMOTION_AUC) == F.lit(outcome.promoted)).alias("gated")))
    # One row of facts.
    return sizes.join(weights, F.col("label") == F.col("of")).drop("of").crossJoin(F.broadcast(facts))


def _plain_run(spark, folder):
    """The plain booster on all orders, split by key so that SQL finds the same parts."""
    store = _store(spark)
    rows = settle(order_transactions(spark, folder))
    train_and_promote(rows, store, "first", order=_order(_key()), params=PLAIN, gate=PLAIN_GATE, edges=CUTS)
    return rows, store


def _shown(store, runs):
    """The trees of some runs as stored."""
    trees = [store.spark.read.parquet(store.trees_path(r)).withColumn("run", F.lit(r)) for r in runs]
    all_ = trees[0]
    for more in trees[1:]:
        all_ = all_.unionByName(more)
    return all_.select("run", "tree", "node", "feature", "threshold", F.round("value", 6).alias("value"),
                       F.round("cover", 3).alias("cover"))


def boosted_trees(spark, folder):
    """Second-order trees: split, cut, sum and value of every node."""
    _, store = _plain_run(spark, folder)
    return _shown(store, ["first"])


def model_report(spark, folder):
    """The stored report of a run: scores of the test rows, measured."""
    _, store = _plain_run(spark, folder)
    report = spark.read.parquet(f"{store.root}/metrics/run=first")
    return report.select("class", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")],
                         "support", F.round("auc", 8).alias("auc"))


def staged_auc(spark, folder):
    """ROC-AUC of the test rows after each round."""
    _, store = _plain_run(spark, folder)
    test = spark.read.parquet(f"{store.root}/splits/run=first/is_test=true")
    return model.staged_auc(store.production(), test).withColumn("auc", F.round("auc", 8))


def warm_start(spark, folder):
    """A second batch continues the model of the first; trees of both runs."""
    store = _store(spark)
    rows = settle(order_transactions(spark, folder))
    for run, batch in (("early", rows.where("step < 1200")), ("late", rows.where("step >= 1200"))):
        train_and_promote(settle(batch), store, run, order=_order(_key()), params=PLAIN,
                          gate=PLAIN_GATE, edges=CUTS)
    assert [p.run for p in store.production().parts] == ["early", "late"]
    return _shown(store, ["early", "late"])


def score_stream_alerts(spark, folder):
    """Train and promote, then stream the unlabelled transactions through the scoring job."""
    root = scratch_path(spark, "scoring")
    rows, store = _plain_run(spark, folder)
    unlabelled = rows.drop(TRANSACTION_LABEL)
    publish(unlabelled, f"{root}/messages")
    score_transactions(spark, store, unlabelled.schema, alerts=f"{root}/alerts",
                       checkpoint=f"{root}/checkpoint", folder=f"{root}/messages", available_now=True)
    return spark.read.schema("transaction_id string, alert string").parquet(f"{root}/alerts")


def score_repeated_messages(spark, folder):
    """Every transaction sent three times: twice before the first start of the stream, in
    other batches, and again before the second start. Each alert comes once."""
    root = scratch_path(spark, "repeated")
    rows, store = _plain_run(spark, folder)
    unlabelled = rows.drop(TRANSACTION_LABEL)
    for sent in (2, 1):
        for _ in range(sent):
            publish(unlabelled, f"{root}/messages")
        score_transactions(spark, store, unlabelled.schema, alerts=f"{root}/alerts", max_files=5,
                           checkpoint=f"{root}/checkpoint", folder=f"{root}/messages",
                           available_now=True, once_within="1 day")
    return spark.read.schema("transaction_id string, alert string").parquet(f"{root}/alerts")


def score_following_model(spark, folder):
    """A model is promoted while the stream runs: later messages are scored by it."""
    root, store = scratch_path(spark, "following"), _store(spark)
    rows = settle(order_transactions(spark, folder))
    schema, query = rows.drop(TRANSACTION_LABEL).schema, None
    try:
        for run, batch in (("early", rows.where("step < 1200")), ("late", rows.where("step >= 1200"))):
            train_and_promote(settle(batch), store, run, order=_order(_key()), params=PLAIN,
                              gate=PLAIN_GATE, edges=CUTS)
            publish(batch.drop(TRANSACTION_LABEL), f"{root}/messages")
            query = query or start_following(folder_stream(spark, f"{root}/messages"), schema, store,
                                             f"{root}/alerts", f"{root}/checkpoint")
            query.processAllAvailable()
    finally:
        if query:
            query.stop()
    found = spark.read.schema("transaction_id string, model string").option(
        "recursiveFileLookup", "true").parquet(f"{root}/alerts")
    return found.withColumn("model", F.substring_index("model", "/", -1))


QUERIES = {
    "stratified_split": stratified_split_query,
    "imbalance_ratio": imbalance_ratio,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "roc_auc_tied": roc_auc_tied,
    "one_hot_features": one_hot_features,
    "transaction_ids": transaction_ids,
    "next_training_batch": next_training_batch,
    "train_validate": train_validate,
    "boosted_trees": boosted_trees,
    "model_report": model_report,
    "staged_auc": staged_auc,
    "warm_start": warm_start,
    "score_stream_alerts": score_stream_alerts,
    "score_repeated_messages": score_repeated_messages,
    "score_following_model": score_following_model,
}

_LABELLED = "SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders"
_SPLIT = f"""
    SELECT o_orderkey, label,
           CASE WHEN row_number() OVER (
                    PARTITION BY label
                    ORDER BY (o_orderkey % 2147483648) * {MULTIPLIER} % 4294967296, o_orderkey)
                <= round(0.2 * count(*) OVER (PARTITION BY label))
                THEN 'test' ELSE 'train' END AS part
    FROM ({_LABELLED}) labelled"""
_TRANSACTIONS = """
    SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS step,
           o_orderpriority AS type, o_totalprice AS amount,
           'C' || o_custkey AS "nameOrig", 'M' || o_orderkey AS "nameDest"
    FROM orders"""

_MIXED = f"(CAST(substr(\"nameDest\", 2) AS BIGINT) % 2147483648) * {MULTIPLIER} % 4294967296"
_FRAUD = f"""
    SELECT *, CAST((type = '1-URGENT' AND lines >= 5 AND chance < 800) OR chance >= 998 AS INTEGER) AS label
    FROM (SELECT t.*, coalesce(lines, 0) AS lines, coalesce(quantity, 0) AS quantity,
                 ({_MIXED}) // 65536 % 1000 AS chance
          FROM ({_TRANSACTIONS}) t
          LEFT JOIN (SELECT 'M' || l_orderkey AS k, count(*) AS lines, sum(l_quantity) AS quantity
                     FROM lineitem GROUP BY 1) l
            ON l.k = t."nameDest") filled"""


def _parts_sql(where="true"):
    """Transactions with ``part``, the weight of their class in training, and features ``x``."""
    slots = ", ".join(f"CAST(type = '{t}' AS DOUBLE)" for t in
                      ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    return f"""
        SELECT *, CASE WHEN label = 1 THEN
                 CAST(count(*) FILTER (part = 'train' AND label = 0) OVER () AS DOUBLE)
                 / count(*) FILTER (part = 'train' AND label = 1) OVER () ELSE 1.0::DOUBLE END AS weight
        FROM (SELECT *, [{slots}, step, amount, lines, quantity]::DOUBLE[] AS x,
                     CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {_MIXED},
                                                  CAST(substr("nameDest", 2) AS BIGINT))
                          <= round(0.2 * count(*) OVER (PARTITION BY label))
                     THEN 'test' ELSE 'train' END AS part
              FROM ({_FRAUD}) fraud WHERE {where}) split"""


def _cuts_sql():
    rows = ", ".join(f"({f}, {i}, {float(e)}::DOUBLE)" for f, own in enumerate(CUTS)
                     for i, e in enumerate(own))
    return f"cuts AS (SELECT * FROM (VALUES {rows}) v(feature, cut, edge))"


def _rounds_sql(name, source, rounds, first=0):
    """CTEs of the plain booster: ``{name}_m{r}`` holds all rows with margin ``m`` after ``r``
    rounds, ``{name}_trees`` the nodes. ``source`` has x, label, weight, part and m."""
    out, eta, nodes = [f"{name}_m0 AS MATERIALIZED ({source})"], PLAIN.learning_rate, []
    for r in range(rounds):
        out.append(f"""{name}_{r}_0 AS MATERIALIZED (
            SELECT *, 0 AS node, round(weight * (p - label) * 1048576) AS g,
                   round(greatest(weight * p * (1 - p), 1e-16) * 1048576) AS h
            FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM {name}_m{r}) odds)""")
        for level in range(PLAIN.depth):
            at = f"{name}_{r}_{level}"
            out.append(f"""{at}_s AS MATERIALIZED (
                SELECT DISTINCT ON (node) * FROM (
                    SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain
                    FROM (SELECT node, feature, cut, edge, sum(g) / 1048576 AS g, sum(h) / 1048576 AS h,
                                 sum(CASE WHEN x[feature + 1] <= edge THEN g ELSE 0 END) / 1048576 AS gl,
                                 sum(CASE WHEN x[feature + 1] <= edge THEN h ELSE 0 END) / 1048576 AS hl
                          FROM {at}, cuts WHERE part = 'train' AND node >= {2 ** level - 1}
                          GROUP BY node, feature, cut, edge) sums)
                WHERE gain > 1e-6 AND hl >= 1 AND h - hl >= 1
                ORDER BY node, gain DESC, feature, cut)""")
            out.append(f"""{name}_{r}_{level + 1} AS MATERIALIZED (
                SELECT l.* EXCLUDE (node),
                       CASE WHEN s.node IS NULL THEN l.node
                            ELSE 2 * l.node + 2 - CAST(x[s.feature + 1] <= s.edge AS INTEGER) END AS node
                FROM {at} l LEFT JOIN {at}_s s ON l.node = s.node)""")
        values = [f"SELECT 0 AS node, sum(g) / 1048576 AS g, sum(h) / 1048576 AS h FROM {name}_{r}_0 WHERE part = 'train'"]
        splits = []
        for level in range(PLAIN.depth):
            at = f"{name}_{r}_{level}_s"
            values += [f"SELECT 2 * node + 1, gl, hl FROM {at}", f"SELECT 2 * node + 2, g - gl, h - hl FROM {at}"]
            splits.append(f"SELECT node, feature, edge FROM {at}")
        out.append(f"""{name}_{r}_t AS MATERIALIZED (
            SELECT {first + r} AS tree, v.node, coalesce(feature, -1) AS feature, coalesce(edge, 0) AS threshold,
                   -g / (h + 1) * {eta} AS value, h AS cover
            FROM ({" UNION ALL ".join(values)}) v LEFT JOIN ({" UNION ALL ".join(splits)}) s ON v.node = s.node)""")
        nodes.append(f"SELECT * FROM {name}_{r}_t")
        out.append(f"""{name}_m{r + 1} AS MATERIALIZED (
            SELECT l.* EXCLUDE (node, g, h, p, m), m + value AS m
            FROM {name}_{r}_{PLAIN.depth} l JOIN {name}_{r}_t t ON l.node = t.node)""")
    out.append(f"{name}_trees AS ({' UNION ALL '.join(nodes)})")
    return out


def _plain_sql(select):
    ctes = [_cuts_sql(), *_rounds_sql("first", f"SELECT *, 0.0::DOUBLE AS m FROM ({_parts_sql()}) p", PLAIN.rounds)]
    return "WITH " + ",\n".join(ctes) + select


def _trees_sql(name, first=0):
    return f"""
        SELECT '{name}' AS run, CAST(tree - {first} AS INTEGER) AS tree, CAST(node AS INTEGER) AS node,
               CAST(feature AS INTEGER) AS feature, CAST(threshold AS DOUBLE) AS threshold,
               round(value, 6) AS value, round(cover, 3) AS cover FROM {name}_trees"""


def _late_sql(select):
    """The second batch starts from the margin of the first one's trees."""
    early = _rounds_sql("early", f"SELECT *, 0.0::DOUBLE AS m FROM ({_parts_sql('step < 1200')}) p", PLAIN.rounds)
    ctes, last = [_cuts_sql(), *early, f"late_x0 AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS m FROM ({_parts_sql('step >= 1200')}) p)"], "late_x0"
    for r in range(PLAIN.rounds):
        at = f"SELECT *, 0 AS leaf FROM {last}"
        for _ in range(PLAIN.depth):
            at = f"""SELECT l.* EXCLUDE (leaf),
                            CASE WHEN feature < 0 THEN leaf
                                 ELSE 2 * leaf + 2 - CAST(x[feature + 1] <= threshold AS INTEGER) END AS leaf
                     FROM ({at}) l JOIN early_{r}_t t ON t.node = leaf"""
        ctes.append(f"""late_x{r + 1} AS MATERIALIZED (
            SELECT l.* EXCLUDE (leaf, m), m + value AS m FROM ({at}) l JOIN early_{r}_t t ON t.node = leaf)""")
        last = f"late_x{r + 1}"
    ctes += _rounds_sql("late", f"SELECT * FROM {last}", PLAIN.rounds, PLAIN.rounds)
    return "WITH " + ",\n".join(ctes) + select


def _report_sql(scored):
    """The classification report of rows (label, prediction)."""
    return f"""
        scored AS ({scored}),
        per_class AS (
            SELECT class,
                   CAST(count(*) FILTER (label = class) AS DOUBLE) AS support,
                   CAST(count(*) FILTER (prediction = class) AS DOUBLE) AS predicted,
                   CAST(count(*) FILTER (label = class AND prediction = class) AS DOUBLE) AS hits
            FROM scored, (VALUES (0), (1)) classes(class) GROUP BY class),
        measured AS (
            SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
                   CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
                   CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f1
            FROM per_class),
        report AS (
        SELECT CAST(class AS VARCHAR) AS class, round(precision, 4) AS precision,
               round(recall, 4) AS recall, round(f1, 4) AS f1, CAST(support AS BIGINT) AS support
        FROM measured
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 4),
               CAST(sum(support) AS BIGINT) FROM measured
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4),
               CAST(sum(support) AS BIGINT) FROM measured
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4),
               round(sum(recall * support) / sum(support), 4),
               round(sum(f1 * support) / sum(support), 4), CAST(sum(support) AS BIGINT)
        FROM measured)"""


def _margin_auc_sql(rows):
    return f"""
        SELECT round(CAST(sum(pos * (lower + 0.5 * neg)) AS DOUBLE)
                     / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 8) AS auc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
        FROM (SELECT pos, neg, coalesce(sum(neg) OVER (
                  ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
              FROM (SELECT m, sum(label) AS pos, sum(1 - label) AS neg FROM {rows}
                    WHERE part = 'test' GROUP BY m) per_score) ranked"""


def _auc_sql(score):
    return f"""
        WITH per_score AS (
            SELECT {score} AS score, sum(label) AS pos, sum(1 - label) AS neg
            FROM ({_LABELLED}) labelled GROUP BY 1),
        ranked AS (
            SELECT pos, neg, coalesce(sum(neg) OVER (
                ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
            FROM per_score)
        SELECT round(CAST(sum(pos * (lower + 0.5 * neg)) AS DOUBLE)
                     / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 8) AS auc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
        FROM ranked"""


_ALERTS = f"""
    SELECT 'txn_' || step || "nameOrig" || "nameDest" AS transaction_id,
           '{ALERT_TEXT}' || 'txn_' || step || "nameOrig" || "nameDest" AS alert
    FROM first_m{PLAIN.rounds} WHERE m > 0"""
ORACLE = {
    "stratified_split": _SPLIT,
    "imbalance_ratio": f"""
        SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives,
               CAST(count(*) FILTER (label = 0) AS DOUBLE) / count(*) FILTER (label = 1) AS ratio
        FROM ({_SPLIT}) split WHERE part = 'train'""",
    "classification_report": f"""
        WITH scored AS (
            SELECT label, CAST(o_totalprice > 300000 AS INTEGER) AS prediction
            FROM ({_LABELLED}) labelled),
        per_class AS (
            SELECT class,
                   CAST(count(*) FILTER (label = class) AS DOUBLE) AS support,
                   CAST(count(*) FILTER (prediction = class) AS DOUBLE) AS predicted,
                   CAST(count(*) FILTER (label = class AND prediction = class) AS DOUBLE) AS hits
            FROM scored, (VALUES (0), (1)) classes(class) GROUP BY class),
        measured AS (
            SELECT *, hits / predicted AS precision, hits / support AS recall,
                   2 * hits / (predicted + support) AS f1
            FROM per_class)
        SELECT CAST(class AS VARCHAR) AS class, round(precision, 4) AS precision,
               round(recall, 4) AS recall, round(f1, 4) AS f1, CAST(support AS BIGINT) AS support
        FROM measured
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 4),
               CAST(sum(support) AS BIGINT) FROM measured
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4),
               CAST(sum(support) AS BIGINT) FROM measured
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4),
               round(sum(recall * support) / sum(support), 4),
               round(sum(f1 * support) / sum(support), 4), CAST(sum(support) AS BIGINT)
        FROM measured""",
    "roc_auc": _auc_sql("o_totalprice"),
    "roc_auc_tied": _auc_sql("CAST(floor(o_totalprice / 100000) AS BIGINT)"),
    "one_hot_features": f"""
        SELECT "nameDest",
               CAST(type = '1-URGENT' AS DOUBLE) AS f0, CAST(type = '2-HIGH' AS DOUBLE) AS f1,
               CAST(type = '3-MEDIUM' AS DOUBLE) AS f2,
               CAST(type = '4-NOT SPECIFIED' AS DOUBLE) AS f3,
               CAST(step AS DOUBLE) AS f4, amount AS f5
        FROM ({_TRANSACTIONS}) transactions""",
    "transaction_ids": f"""
        SELECT 'txn_' || step || "nameOrig" || "nameDest" AS transaction_id, amount
        FROM ({_TRANSACTIONS}) transactions""",
    "next_training_batch": """
        SELECT CAST(year(o_orderdate) - 1990 AS INTEGER) AS batch_id, count(*) AS rows
        FROM orders WHERE year(o_orderdate) > 1997 GROUP BY 1 ORDER BY 1 LIMIT 1""",
    "train_validate": f"""
        SELECT label, count(*) FILTER (part = 'train') AS train_rows,
               count(*) FILTER (part = 'test') AS test_rows, round(any_value(weight), 8) AS weight,
               {model.BoostingParams.rounds}::BIGINT AS trees, {model.BoostingParams.depth}::BIGINT AS depth,
               true AS columns_drawn, CAST(sum(count(*) FILTER (part = 'test')) OVER () AS BIGINT) AS scored,
               true AS ranks, true AS gated
        FROM ({_parts_sql()}) parts GROUP BY label""",
    "boosted_trees": _plain_sql(_trees_sql("first")),
    "model_report": _plain_sql("," + _report_sql(
        f"SELECT label, CAST(m > 0 AS INTEGER) AS prediction FROM first_m{PLAIN.rounds} WHERE part = 'test'")
        + f" SELECT report.*, auc FROM report, ({_margin_auc_sql(f'first_m{PLAIN.rounds}')}) a"),
    "staged_auc": _plain_sql(" UNION ALL ".join(
        f" SELECT CAST({r} AS INTEGER) AS round, * FROM ({_margin_auc_sql(f'first_m{r + 1}')}) a{r}"
        for r in range(PLAIN.rounds))),
    "warm_start": _late_sql(_trees_sql("early") + " UNION ALL " + _trees_sql("late", PLAIN.rounds)),
    "score_stream_alerts": _plain_sql(_ALERTS),
    "score_repeated_messages": _plain_sql(_ALERTS),
    "score_following_model": _late_sql(" UNION ALL ".join(f"""
        SELECT 'txn_' || step || "nameOrig" || "nameDest" AS transaction_id, '{run}' AS model
        FROM {run}_m{PLAIN.rounds} WHERE m > 0""" for run in ("early", "late"))),
}
