"""Boosted trees against a plain recursive version, spread against in one task, continued
against in one go."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boosting as B
from millrace.operators import model as M
from millrace.operators.metrics import roc_auc
from millrace.plans.fraud import ModelStore, train_and_promote
from tests.test_fraud import brute_auc, transactions

ALL = dict(row_share=1.0, column_share=1.0)
EDGES = [[0.0, 0.5, 1.0], [-1.0, -0.5, 0.0, 0.3, 2.0], [0.5], []]


def overlapping(n, seed=1, missing=0.1):
    """Rows (features, label, weight) whose labels no tree can separate."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [rng.uniform(-1, 2), rng.gauss(0, 1), float(rng.random() < 0.4), 7.0]
        if rng.random() < missing:
            x[rng.randrange(2)] = math.nan
        odds = (0 if math.isnan(x[0]) else x[0]) + (-1 if math.isnan(x[1]) else x[1]) * x[2]
        y = int(rng.random() < 1 / (1 + math.exp(-odds)))
        out.append((x, y, 1.5 if y else 1.0))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "features array<double>, label int, weight double").repartition(parts).cache()


def plain_tree(rows, margin, params, columns):
    """A tree by recursion over lists of rows: a nested tuple, or a leaf's value."""
    g, h = [], []
    for (x, y, w), m in zip(rows, margin):
        p = 1 / (1 + math.exp(-m))
        g.append(round(w * (p - y) * B.SCALE) / B.SCALE)
        h.append(round(max(w * p * (1 - p), 1e-16) * B.SCALE) / B.SCALE)

    def node(own, depth):
        gs, hs = sum(g[i] for i in own), sum(h[i] for i in own)
        leaf = -gs / (hs + params.l2) * params.learning_rate
        best = (1e-6, None)
        for f in columns if depth else []:
            for missing in (False, True):
                for edge in EDGES[f]:
                    left = [i for i in own if (missing if math.isnan(rows[i][0][f]) else rows[i][0][f] <= edge)]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    gr, hr = gs - gl, hs - hl
                    if hl < params.min_child or hr < params.min_child:
                        continue
                    gain = (gl ** 2 / (hl + params.l2) + gr ** 2 / (hr + params.l2) - gs ** 2 / (hs + params.l2)) / 2
                    if gain > best[0]:
                        best = (gain, (f, edge, missing, left))
        if best[1] is None:
            return leaf
        f, edge, missing, left = best[1]
        inside = set(left)
        return (f, edge, missing, node(left, depth - 1), node([i for i in own if i not in inside], depth - 1))

    return node(list(range(len(rows))), params.depth)


def walk(tree, x):
    while isinstance(tree, tuple):
        f, edge, missing, left, right = tree
        tree = left if (missing if math.isnan(x[f]) else x[f] <= edge) else right
    return tree


def as_nested(tree, node=0):
    if tree.feature[node] < 0:
        return pytest.approx(tree.value[node], abs=1e-9)
    return (tree.feature[node], tree.threshold[node], bool(tree.missing_left[node]),
            as_nested(tree, 2 * node + 1), as_nested(tree, 2 * node + 2))


def same(a, b):
    return len(a) == len(b) and all(
        np.array_equal(getattr(x, n)[: len(y.feature)], getattr(y, n)[: len(x.feature)])
        for x, y in zip(a, b) for n in B._NODE)


@pytest.mark.parametrize("column_share", [1.0, 0.5])
def test_against_plain_trees(spark, column_share):
    params = B.BoostingParams(rounds=4, depth=3, learning_rate=0.4, row_share=1.0, column_share=column_share)
    rows = overlapping(400)
    found = B.boost(frame(spark, rows), 4, params, edges=EDGES)
    margin = [0.0] * len(rows)
    for number, tree in enumerate(found):
        expected = plain_tree(rows, margin, params, B.drawn_columns(number, 4, params).tolist())
        assert expected == as_nested(tree)
        margin = [m + walk(expected, x) for (x, _, _), m in zip(rows, margin)]
    assert np.allclose(sum(t.margin(np.array([x for x, _, _ in rows])) for t in found), margin)


def test_one_task_and_many_give_the_same_trees(spark):
    params = B.BoostingParams(rounds=12, depth=4, bins=16, learning_rate=0.3)
    rows = frame(spark, overlapping(3000, 4), 5)
    edges = B.quantile_edges(rows, 4, bins=16)
    one = B.boost(rows, 4, params, edges=edges)
    many = B.boost(rows, 4, params, edges=edges, one_task_rows=0)
    assert same(one, many) and len({int(t.feature[0]) for t in one}) > 1


def test_rows_and_columns_are_drawn_per_round(spark):
    params = B.BoostingParams(rounds=6, depth=2, row_share=0.5, column_share=0.5)
    found = B.boost(frame(spark, overlapping(2000)), 4, params, edges=EDGES)
    for number, tree in enumerate(found):
        drawn = B.drawn_columns(number, 4, params)
        assert len(drawn) == 2 and set(tree.feature[tree.feature >= 0]) <= set(drawn.tolist())
        assert 0.4 < tree.cover[0] / found[0].cover[0] < 1.7
    assert len({tuple(B.drawn_columns(i, 4, params)) for i in range(6)}) > 1
    assert 0.45 < found[0].cover[0] / (0.25 * sum(w for _, _, w in overlapping(2000))) < 0.55


def test_continuing_equals_one_go(spark):
    rows = frame(spark, overlapping(800, 7))
    params = B.BoostingParams(rounds=6, depth=3, learning_rate=0.3)
    whole = B.boost(rows, 4, params, edges=EDGES)
    half = B.BoostingParams(rounds=3, depth=3, learning_rate=0.3)
    first = B.boost(rows, 4, half, edges=EDGES)
    going = rows.withColumn("m", B.margins(F.col("features"), first))
    second = B.boost(going, 4, half, margin="m", first=3, edges=EDGES)
    assert same(whole, first + second)


def test_staged_margins_end_with_the_margin(spark):
    rows = frame(spark, overlapping(300))
    trees = B.boost(rows, 4, B.BoostingParams(rounds=5, depth=2), edges=EDGES)
    found = rows.select(B.staged_margins(F.col("features"), trees).alias("s"),
                        B.margins(F.col("features"), trees).alias("m")).collect()
    assert all(len(r.s) == 5 and r.s[-1] == pytest.approx(r.m, abs=1e-12) for r in found)


def test_quantile_edges(spark):
    rows = spark.createDataFrame([([float(i % 100), math.nan, 3.0, float(i % 2)], 0, 1.0) for i in range(1000)],
                                 "features array<double>, label int, weight double")
    a, b, c, d = B.quantile_edges(rows, 4, bins=10)
    assert len(a) == 9 and list(np.diff(a)) == [10.0] * 8
    assert [len(b), len(c), list(d)] == [0, 0, [0.0]]


def test_edge_tables(spark):
    empty = frame(spark, overlapping(5)).where("label > 1")
    assert B.boost(empty, 4, B.BoostingParams(rounds=2), edges=EDGES) == []
    one = B.boost(frame(spark, [([math.nan] * 4, 1, 1.0)] * 40), 4, B.BoostingParams(rounds=2, **ALL))
    assert [int(t.feature[0]) for t in one] == [-1, -1] and one[0].value[0] > 0
    stored = B.trees_of([r for i, t in enumerate(one) for r in t.rows(i)])
    assert [t.margin(np.zeros((1, 4)))[0] for t in stored] == [t.value[0] for t in one]


def test_staged_auc_against_brute_force(spark):
    rows = frame(spark, overlapping(500, 3)).withColumnRenamed("label", "isFraud")
    trees = B.boost(rows, 4, B.BoostingParams(rounds=4, depth=2), label="isFraud", edges=EDGES)
    staged = rows.select("isFraud", F.posexplode(B.staged_margins(F.col("features"), trees)).alias("round", "score"))
    curve = {r["round"]: r["auc"] for r in roc_auc(staged, "isFraud", group="round").collect()}
    scored = {}
    for r in staged.collect():
        scored.setdefault(r["round"], []).append((r.score, r.isFraud))
    assert curve == {k: pytest.approx(brute_auc(v), abs=1e-12) for k, v in scored.items()}


def test_model_continues_on_the_new_batch_alone(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    params = M.BoostingParams(rounds=3, depth=3, learning_rate=0.5)
    batches = []
    for i in range(2):
        transactions(spark, 600, i * 1000).repartition(2).write.parquet(str(tmp_path / f"batch{i}"))
        batches.append(spark.read.parquet(str(tmp_path / f"batch{i}")))
    assert train_and_promote(batches[0], store, "r0", params=params, gate=0.5).promoted
    before = store.production()
    # The rows of the first batch are gone: nothing may read them again.
    (tmp_path / "batch0").rename(tmp_path / "elsewhere")
    (tmp_path / "models" / "splits" / "run=r0").rename(tmp_path / "split0")
    assert train_and_promote(batches[1], store, "r1", params=params, gate=0.5).promoted
    after = store.production()
    assert [p.run for p in after.parts] == ["r0", "r1"] and after.numeric == before.numeric
    assert same(after.parts[0].trees, before.parts[0].trees) and len(after.trees) == 6
    rows = M.drop_identifiers(batches[1])
    old = {tuple(r)[:-1]: r.margin for r in before.with_margin(rows).collect()}
    kept = M.FraudModel(after.encoder, after.numeric, after.parts[:1])
    assert {tuple(r)[:-1]: r.margin for r in kept.with_margin(rows).collect()} == old

    # A repeated run continues what was there before it.
    train_and_promote(batches[1], store, "r1", params=params, gate=0.5)
    again = store.production()
    assert [p.run for p in again.parts] == ["r0", "r1"] and same(again.trees, after.trees)


def test_a_level_is_one_aggregate_of_sums(spark):
    rows = frame(spark, overlapping(200))
    layout = B.Layout([np.array(e) for e in EDGES])
    prepared = B._prepared(rows, layout, "features", "label", "weight", None)
    sums = B.level_sums(prepared, layout, B.BoostingParams(**ALL), 0, [], B.Tree.empty(2), 0, np.arange(4))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert {r.cell for r in sums.collect()} <= set(range(layout.cells))
