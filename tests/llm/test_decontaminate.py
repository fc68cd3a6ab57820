"""Benchmark decontamination against an exhaustive edit distance."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from millrace.llm import decontaminate, queries


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())


def plain(item, text):
    """Least number of edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        before, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (w != t))
    return min(row)


def check(spark, docs, items, **options):
    given = spark.createDataFrame([(i, t, None) for i, t in docs], "doc_id bigint, text string, item_id int")
    tests = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    found = sorted((r.doc_id, r.item_id, r.distance) for r in
                   decontaminate.contaminated(given.repartition(2), tests, **options).collect())
    rate = options.get("rate", decontaminate.ERROR_RATE)
    expected = []
    for key, text in docs:
        for item, passage in items:
            own = words(passage)
            if own:
                distance = plain(own, words(text))
                if distance <= decontaminate.budget(len(own), rate):
                    expected.append((key, item, distance))
    assert found == sorted(expected)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.2])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijkl"])
def test_random_edits(spark, letters, rate):
    rng = random.Random(len(letters))
    items = [(i, " ".join(rng.choice(letters) * rng.randint(1, 3) for _ in range(rng.randint(1, 30))))
             for i in range(12)]
    docs = []
    for key in range(60):
        text = [rng.choice(letters) * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        passage = list(rng.choice(items)[1].split())
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(passage) + 1)
            passage[at:at + rng.randint(0, 1)] = ["new"] * rng.randint(0, 1)
        at = rng.randint(0, len(text))
        docs.append((key + 1, " ".join(text[:at] + passage + text[at:])))
    check(spark, docs, items, rate=rate)


def test_edge_rows(spark):
    passage = "Ein Satz, der in Größe und Länge ganz besonders ist!"
    docs = [(1, None), (2, ""), (3, "?! --"), (4, passage.upper()), (4, passage), (5, "x " * 40000 + passage)]
    items = [(1, passage), (2, passage), (3, None), (4, ""), (5, "..."), (6, "unique")]
    check(spark, docs, items)


def test_blocks_of_items_and_empty_tables(spark):
    items = [(i, f"item number {i} of a longer list of passages") for i in range(9)]
    docs = [(i + 1, f"before {t} after") for i, t in items]
    check(spark, docs, items, block_words=20, rate=0.0)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontaminate.contaminated(empty, tests).count() == 0
    none = decontaminate.contaminated(empty.withColumnRenamed("doc_id", "d").withColumnRenamed("d", "doc_id"),
                                      tests.where("false"))
    assert none.columns == ["doc_id", "item_id", "distance", "first_word", "end_word", "item_words"]
    given = spark.createDataFrame(docs + [(99, "clean"), (98, None)], "doc_id bigint, text string")
    left = decontaminate.without_benchmark(given, tests, block_words=20)
    assert sorted(map(tuple, left.collect())) == [(98, None), (99, "clean")]


def test_place_of_a_match():
    block = decontaminate.block_of([7], ["one two three four five six seven eight nine ten"])
    names, begin = decontaminate.words_of(pa.array(["a b one two three FOUR, five x seven eight nine ten c"]))
    assert decontaminate.matches(block, names, begin) == [(0, 0, 1, 2, 12)]


def test_given_documents(spark):
    found = queries.op6_decontaminate(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert exact <= {(r.doc_id, r.item_id) for r in found.collect()}


def test_columns_of_clashing_names_stay(spark):
    tests = spark.createDataFrame([(1, "one two three four five six seven", 4)], "item_id bigint, text string, key int")
    docs = spark.createDataFrame([(1, "x one two three four five six seven", "a", 1), (2, "clean", "b", 2), (None, None, "c", 3)],
                                 "doc_id bigint, text string, __item string, `my key` int")
    left = decontaminate.without_benchmark(docs, tests)
    assert left.schema == docs.schema and sorted(r["my key"] for r in left.collect()) == [2, 3]
    found = decontaminate.contaminated(docs.withColumnRenamed("my key", "item_id"), tests).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in found] == [(1, 1, 0)]
