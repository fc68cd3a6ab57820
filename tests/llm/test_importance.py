"""Resampling against a plain version over words, and ranks against a sort."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import importance

SCHEMA = "doc_id bigint, text string, id int, place string, h int, score string, rank int"


def plain_features(text, longest):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(docs, target, longest=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    own = [plain_features(t, longest) for _, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for counts, all_ in ((s, [f for _, f in own]), (t, [plain_features(x, longest)[1] for x in target])):
        for runs in all_:
            for f in runs:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
            for a, b in zip(s, t)]
    rows = []
    for (key, _), (words, runs) in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in runs)
        rows.append([key, len(runs), weight,
                     weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def check(spark, docs, target, parts=4, **options):
    given = spark.createDataFrame([(k, t, 1, "x", 2, "y", 3) for k, t in docs], SCHEMA).repartition(parts)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    found = importance.resample(given, aim, **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = plain(docs, target, **options)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    return expected


def texts(rng, n, most=60):
    words = ["Alpha", "beta", "über", "naïve", "x1", "42", "don't", "日本", "z" * 70, "Q_r", "the", "THE"]
    return [rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(words) for _ in range(rng.randint(0, most)))
            for _ in range(n)]


@pytest.mark.parametrize("longest", [1, 3])
def test_random_texts(spark, longest):
    rng = random.Random(longest)
    docs = [(i * 13 % 997 - 50, t) for i, t in enumerate(texts(rng, 400))]
    rows = check(spark, docs, texts(rng, 20), longest=longest, buckets=100, min_words=5, percent=40)
    assert sum(r[4] is not None for r in rows) > 100


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "--- \x00"), (None, "a b c"), (None, "a b c"), (4, "word " * 100_000),
            (5, "w" * 200_000), (6, "é" * 30 + " É"), (7, "a b c"), (7, "a b c"), (-8, "İ K"), (9, "\x7fa\x80b")]
    check(spark, docs, ["a b", None, ""], min_words=0, percent=100)
    check(spark, docs, [], min_words=3, percent=50)
    check(spark, [], ["a"])


def test_ties_by_id_and_many_copies(spark, monkeypatch):
    """Scores repeat when the noise does: here it is one number for all."""
    monkeypatch.setattr(importance, "SEGMENTS", 7)
    docs = [(i % 50, "same words in all of them") for i in range(900)] + [(None, "same words in all of them")] * 9
    rows = check(spark, docs, ["same"], parts=9, min_words=1, percent=77)
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 77 * 909 // 100 + 1))


@pytest.mark.parametrize("rows, parts, segments", [(5, 4, 16), (1000, 13, 16), (1000, 1, 3), (700, 5, 40)])
def test_ranks_are_those_of_a_sort(spark, monkeypatch, rows, parts, segments):
    monkeypatch.setattr(importance, "SEGMENTS", segments)
    monkeypatch.setattr(importance, "NOTES", 4)
    rng = random.Random(rows + parts)
    data = [(rng.choice([0, 0, 0, 1, 2, rng.randrange(9999)]), rng.randrange(30), i) for i in range(rows)]
    given = spark.createDataFrame(data, "down bigint, last_id bigint, place bigint").repartition(parts)
    for drawn in (0, 1, rows // 3, rows):
        found = {r.place: r.rank for r in importance.first_ranks(given, drawn).collect()}
        for i, (_, _, place) in enumerate(sorted(data)):
            assert found[place] == (i + 1 if i < drawn else None)


def test_segments_are_even_and_only_needed_ones_move(spark, monkeypatch):
    monkeypatch.setattr(importance, "SEGMENTS", 8)
    rows = spark.range(40_000, numPartitions=6).selectExpr(
        "pmod(xxhash64(id), 3) AS down", "7L AS last_id", "id AS place")
    cuts = []
    monkeypatch.setattr(importance, "with_segment", lambda r, s, f=importance.with_segment:
                        cuts.append(f(r, s)) or cuts[0])
    importance.first_ranks(rows, 100)
    sizes = [r["count"] for r in cuts[0].groupBy("segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * 5000


def test_checksums_of_words_of_any_length():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé日0") for _ in range(rng.choice([1, 2, 7, 16, 47, 48, 49, 90])))
             for _ in range(300)]
    _, n, _, bucket = importance.features(pa.array([" ".join(words)]), 1 << 32)
    assert bucket.tolist() == [zlib.crc32(w.encode()) for w in words] and n.tolist() == [300]
    assert np.array_equal(importance.features(pa.array([], pa.string()))[0], [])
