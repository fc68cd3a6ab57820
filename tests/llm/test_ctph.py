"""Piecewise hashing: likeness, edited texts and the order of documents, by brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import ctph


def text_of(rng, n):
    return "".join(rng.choice("abcdefghij klmnop éß\n") for _ in range(n))


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


def test_common_length():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 64))) for _ in range(2))
        assert ctph._common_length(a, b) == plain_common(a, b)


def test_form():
    rng = random.Random(2)
    for n in (0, 1, 6, 100, 5000, 300_000):
        size, one, two = ctph.fingerprint(text_of(rng, n)).split(":")
        assert int(size) % 3 == 0 and len(one) <= 64 and len(two) <= 32
        assert n < 200 or len(one) >= 32
    assert ctph.fingerprint(None) == ctph.fingerprint("") == "3::"


@pytest.mark.parametrize("n", [400, 4000, 60_000])
def test_likeness_falls_with_the_share_edited(n):
    rng = random.Random(n)
    for _ in range(5):
        text, other = text_of(rng, n), text_of(rng, n)
        own = ctph.fingerprint(text)
        assert ctph.likeness(own, own) == 1.0
        assert ctph.likeness(own, ctph.fingerprint(other)) < 0.3
        small = text[:n // 2] + "one word" + text[n // 2:]
        assert ctph.likeness(own, ctph.fingerprint(small)) > 0.8
        half = ctph.fingerprint(ctph.edited_text(text, other))
        assert 0.25 < ctph.likeness(own, half) < 0.85
        assert ctph.likeness(own, half) == ctph.likeness(half, own)


def test_block_sizes_a_factor_of_two_apart():
    rng = random.Random(4)
    text = text_of(rng, 3000)
    one, two = ctph.fingerprint(text), ctph.fingerprint(text + text_of(rng, 3500))
    assert int(two.split(":")[0]) == 2 * int(one.split(":")[0]) and ctph.likeness(one, two) > 0.25
    assert ctph.likeness(one, ctph.fingerprint(text * 40)) == 0.0


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        prints = [ctph.fingerprint(t) for t in (text, edited, following)]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1],
                    ctph.likeness(prints[0], prints[1]), ctph.likeness(prints[0], prints[2])))
    return sorted(out)


@pytest.mark.parametrize("range_bytes", [1 << 24, 2000, 300])
def test_order_over_ranges(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(ctph, "RANGE_BYTES", range_bytes)
    rng = random.Random(range_bytes)
    rows = [(k, text_of(rng, rng.choice([0, 1, 7, 90, 400]))) for k in rng.sample(range(-500, 5000), 60)]
    rows += [(9000, None), (9001, rows[3][1]), (9002, rows[3][1])]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows],
                                 "doc_id bigint, text string, part string, hash int")
    found = sorted(map(tuple, ctph.likeness_to_edits(docs.repartition(4)).collect()))
    assert found == expected(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sorted(map(tuple, ctph.likeness_to_edits(docs).collect()))
    assert found == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    def run(rows):
        return ctph.likeness_to_edits(spark.createDataFrame(rows, "doc_id bigint, text string"))

    assert run([]).count() == 0
    only = run([(5, "abc")]).first()
    assert only.near_next == 1.0 and only.n_chars == 3
    again = run([(5, "abc"), (5, "abc"), (5, "zz"), (None, "q"), (None, None)])
    assert sorted((r.doc_id, r.n_chars) for r in again.where("doc_id = 5").collect()) == [(5, 2), (5, 3), (5, 3)]
    assert again.where("doc_id IS NULL").count() == 2
    plain = ctph.fingerprints(spark.createDataFrame([(1, "t"), (1, "t"), (None, None)], "doc_id bigint, text string"))
    assert plain.count() == 3 and plain.distinct().count() == 2


@pytest.mark.parametrize("number", [1, 2, 7, 8, 9, 28, 200])
def test_search_among_heads(spark, number):
    rng = random.Random(number)
    heads = sorted(((rng.randint(-9, 9), rng.randint(-1 << 63, (1 << 63) - 1)) for _ in range(number)), reverse=True)
    rows = [r for r in [(k, rng.randint(-1 << 63, (1 << 63) - 1)) for k in range(-10, 9)] + heads if r <= heads[0]]
    placed = ctph._placed(spark.createDataFrame(rows, "key bigint, hash bigint"), heads)
    for r in placed.collect():
        part = sum(head >= (r.key, r.hash) for head in heads) - 1
        assert r.part == part and r.target == ((part - 1) % number if (r.key, r.hash) in heads else None)


def test_many_rows_without_an_id_fill_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ctph, "RANGE_BYTES", 1000)
    rng = random.Random(8)
    rows = [(None, f"{i} " + text_of(rng, 80)) for i in range(150)] + [(3, "a"), (4, f"b{text_of(rng, 90)}")]
    rows += [(-1 << 63, "lowest id"), (7, None), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    parts, follow = [], {}

    def work(key, text, following):
        return key, text, following

    found = ctph.with_next(docs, work, "doc_id bigint, text string, following string")
    for r in found.select("*", F.spark_partition_id().alias("at")).collect():
        parts.append(r["at"])
        assert follow.setdefault((r.doc_id, r.text), r.following) == r.following
    assert sorted(follow, key=repr) == sorted(((k, t or "") for k, t in rows), key=repr)
    assert len(set(parts)) > 3 and max(map(parts.count, parts)) < 100
    # One ring through all rows, in descending id, rows without one at its end.
    owner, text, ring = {t: k for k, t in follow}, rows[-1][1], []
    for _ in follow:
        ring.append(owner[text])
        text = follow[ring[-1], text]
    assert text == rows[-1][1]
    begin = next(i for i, k in enumerate(ring) if k is not None and ring[i - 1] is None)
    assert ring[begin:] + ring[:begin] == [7, 7, 4, 3, -1 << 63] + [None] * 150
