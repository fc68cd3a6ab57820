"""Hard negatives against a loop over all pairs, in whole numbers of any size."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, place int, anchor string, down int"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    def whole(x):
        return max(-1 << 63, min((1 << 63) - 1, math.floor(256 * float(np.float32(x)))))

    def score(a, b):
        return max(-1 << 63, min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))

    good = [(k, [whole(x) for x in v], lab) for k, v, lab in rows if lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    last = (1 << 63) - 1
    out = []
    for i, (anchor, a, label) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        pairs = [(-score(a, b), last if k is None else k, k, other) for j, (k, b, other) in enumerate(good)
                 if len(a) == len(b) and i != j]
        pairs.sort(key=lambda p: p[:2])
        best = [p for p in pairs if p[3] == label and p[2] != anchor][:positives]
        for p in best:
            inside = [n for n in pairs if n[3] != label and -low * p[0] <= -100 * n[0] <= -high * p[0]]
            out += [(anchor, p[2], r + 1, n[2], -p[0], -n[0]) for r, n in enumerate(inside[:negatives])]
    return sorted(out, key=repr)


def check(spark, rows, parts=3, **options):
    given = spark.createDataFrame([(k, v, lab, 1, "x", 2) for k, v, lab in rows], SCHEMA).repartition(parts)
    found = hard_negatives.mine(given, F.expr("vec_id % 100 = 0"), **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                             "negative_score"]
    expected = plain(rows, **options)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    return expected


def vectors(rng, n, size=4, spread=1.0):
    return [[rng.gauss(0.3, spread) for _ in range(size)] for _ in range(n)]


@pytest.mark.parametrize("spread", [0.1, 0.6])
def test_random_rows(spark, spread):
    rng = random.Random(int(spread * 10))
    rows = [(i * 10, v, rng.choice([0, 0, 0, 1, 2])) for i, v in enumerate(vectors(rng, 300, 4, spread))]
    assert check(spark, rows)


def test_ties_and_zero_scores(spark):
    rng = random.Random(5)
    rows = [(i * 20, [float(rng.choice([-1, 0, 0, 1])), float(rng.choice([0, 1]))], rng.choice([0, 1]))
            for i in range(160)]
    assert check(spark, rows)


def test_one_vector_in_most_rows(spark):
    rows = [(i, [0.5, 0.25], i % 3) for i in range(900)]
    rows += [(1000 + i, [0.3, 0.1 * (i % 4)], i % 2) for i in range(60)]
    assert check(spark, rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [1.0, nan], 1),
            (400, [inf, 1.0], 1), (500, [1.0, 1.0], None), (600, [], 2), (601, [], 3), (602, [], 2),
            (700, [1.0], 1), (701, [2.0], 1), (702, [1.0], 4), (1, [1.0, 0.5], 1), (2, [0.75, 0.5], 2),
            (None, [1.0, 0.5], 1), (None, [0.5, 0.5], 2), (None, [0.5, 0.5], 2), (0, [1.0, 0.0], 1),
            (0, [0.5, 0.0], 2), (3, [-1.0, 0.0], 1), (4, [-0.5, 0.0], 2), (-100, [-1.0, 0.5], 1)]
    assert check(spark, rows)


@pytest.mark.parametrize("scale", [200.0, 2e5, 1e7, 1e9])
def test_integers_of_any_size(spark, scale):
    """Wide components, scores beyond what floats hold exactly, and beyond a long."""
    rng = random.Random(9)
    rows = [(i * 4, [rng.uniform(0, 1) * scale for _ in range(3)], i % 3) for i in range(120)]
    rows += [(2, [3e30, -3e30, 1.0], 0), (3, [0.5, 0.5, 0.5], 1), (6, [-3e30, 0.0, 0.0], 2)]
    assert check(spark, rows) or scale == 1e9


def test_other_shares_and_numbers(spark):
    rng = random.Random(6)
    rows = [(i * 25, v, i % 2) for i, v in enumerate(vectors(rng, 120, 2, 0.5))]
    check(spark, rows, positives=2, negatives=3, low=0, high=100)
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int"),
                            F.lit(True), high=101)


def test_small_batches_change_nothing(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i * 10, v, i % 3) for i, v in enumerate(vectors(rng, 200, 3, 0.3))]
    for name, value in (("BATCH", 3), ("CHUNK", 7), ("BLOCKS", 5), ("BLOCK_BYTES", 100)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert check(spark, rows, parts=7)


def test_no_anchor_and_no_row(spark):
    check(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    check(spark, [])


def test_walk_holds_open_windows_only():
    stream = iter([(1, ~90, 1, 7), (1, ~50, 0, 8), (1, ~40, 2, 9), (1, ~36, 0, 3), (2, ~10, 0, 4)])
    assert list(hard_negatives.open_windows(stream, 10, 30, 90)) == [
        (1, 7, 1, 8, 90, 50), (1, 7, 2, 3, 90, 36), (1, 9, 1, 3, 40, 36)]


def test_exact_scores_choose_a_type_that_holds_them():
    rng = np.random.default_rng(1)
    for top, kind in ((100, "f"), (30_000, "f"), (1 << 40, "i")):
        values = rng.integers(-top, top, (6, 5))
        small = top < 1 << 15
        raw = [v.astype("<i2" if small else "<i8").tobytes() for v in values]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(6)), pa.array(range(6)), pa.array([1] * 6), pa.array(raw, pa.binary()),
             pa.array([not small] * 6)], ["place", "id", "label", "vector", "wide"])
        rows = hard_negatives.by_length([batch])[5]
        found = hard_negatives.scores(rows, slice(None), rows, slice(None))
        exact = values.astype(object) @ values.T.astype(object)
        assert found.dtype.kind == kind
        assert (found.astype(object) == np.clip(exact, -(1 << 63), (1 << 63) - 1)).all()
