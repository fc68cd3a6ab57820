"""Removal of repeated passages against a plain search over all windows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import queries, substring_dedup


def words_of(text):
    """The words of the contract; ``str.split`` would also cut at U+00A0 and others."""
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window):
    """One dictionary of all windows. ``rows`` have unique ids, or
    repeat an id with its text."""
    first = {}
    for key, text in rows:
        words = words_of(text)
        for s in range(len(words) - window + 1):
            line = tuple(words[s:s + window])
            place = (-1 << 63 if key is None else key, s)
            first[line] = min(place, first.get(line, place))
    out = []
    for key, text in rows:
        words, gone = words_of(text), set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < (-1 << 63 if key is None else key, s):
                gone.update(range(s, s + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), kept))
    return sorted(out, key=repr)


def check(spark, rows, window=20):
    docs = spark.createDataFrame([(k, t, 1, "h") for k, t in rows],
                                 "doc_id bigint, text string, at int, h1 string")
    result = substring_dedup.without_repeats(docs.repartition(3), window=window)
    assert sorted(map(tuple, result.collect()), key=repr) == plain(rows, window)


@pytest.mark.parametrize("window", [5, 20])
@pytest.mark.parametrize("letters", [1, 2, 6])
def test_random_documents(spark, window, letters):
    rng = random.Random(letters * 100 + window)
    docs = [[rng.choice("abcdef"[:letters]) for _ in range(rng.randint(0, 70))] for _ in range(40)]
    passage = [rng.choice("uvwxyz") for _ in range(60)]
    for d in docs[::3]:
        a = rng.randint(0, 30)
        d[len(d) // 2:len(d) // 2] = passage[a:a + rng.randint(3, 30)]
    docs += [list(d) for d in docs[:8]]
    check(spark, [(i * 5 % 97, " ".join(d)) for i, d in enumerate(docs)], window)


def test_edge_rows(spark):
    line = " ".join(f"w{i}" for i in range(30))
    check(spark, [(3, None), (4, ""), (5, " \n\t"), (9, line), (2, "Z " + line + " end"),
                  (7, line.replace(" ", "\n\x0b ")), (7, line.replace(" ", "\n\x0b ")),
                  (None, line[:80]), (-4, "é " * 25), (11, "é  " * 25)])


def test_ids_too_large_to_pack(spark):
    line = " ".join(f"w{i}" for i in range(30))
    check(spark, [((1 << 62) + 5, line), ((1 << 62) + 4, line + " more"), (-5, "other " + line[:70])])


@pytest.mark.parametrize("count", [1, 50])
def test_nothing_repeats(spark, count):
    """Every anchor of every slice is the only one of its name."""
    check(spark, [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(count)])


def test_slices_without_a_repeat_beside_others(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE", 100)
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(6)]
    check(spark, list(enumerate([*texts, texts[2], texts[2][:150] + " end " * 30])))


def test_rows_without_ids(spark):
    """Each text is a document of its own: of all windows one copy stays, hidden by no other."""
    rng = random.Random(12)
    passage = " ".join(rng.choice("abcdef") for _ in range(30))
    texts = [f"a{i} {passage} " + " ".join(f"z{i}x{j}" for j in range(i % 40)) for i in range(120)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, passage), (5, "b " + passage), (5, passage)],
                                 "doc_id bigint, text string").repartition(5)
    rows = substring_dedup.without_repeats(docs).collect()
    gone = sorted(r.n_removed for r in rows)
    assert len(rows) == 123 and gone == [0] + [30] * 122


def test_carried_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", 3, [("x", 1)])],
                                 "doc_id bigint, text string, `my col` int, row array<struct<`a b`:string,n:int>>")
    kept = substring_dedup.without_repeats(docs, carry=True).select("row.*")
    assert kept.dtypes == docs.dtypes and kept.collect() == docs.collect()


def test_one_very_long_text(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(4000)) for _ in range(200_000)]
    words[150_000:150_500] = words[1000:1500]
    check(spark, [(1, " ".join(words)), (2, " ".join(words[77:140]))])


def test_long_texts_are_handled_in_parts(monkeypatch):
    rng = random.Random(4)
    words = [rng.choice("abc") for _ in range(900)]
    words[500:560] = words[100:160]
    texts = pa.array([" ".join(words), "a b", " ".join(words[40:130])])

    def windows():
        return {(int(r), int(s)): None for _, rows, _, _, first, last, _ in
                substring_dedup._anchors(texts, 20) for r, f, l in zip(rows, first, last)
                for s in range(f, l + 1)}
    whole = windows()
    monkeypatch.setattr(substring_dedup, "PART", 128)
    assert windows().keys() == whole.keys() and len(whole) == 881 + 71


def test_equal_windows_have_equal_anchors():
    rng = random.Random(8)
    for _ in range(60):
        letters = rng.choice([1, 2, 3, 8])
        docs = [[rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(0, 60))] for _ in range(6)]
        if rng.random() < .5:
            docs = [d[:9] + docs[0][5:40] + d[9:] for d in docs]
        names, bounds = substring_dedup._words(pa.array([" ".join(d) for d in docs]))
        words, seen = [w for d in docs for w in d], {}
        for name, _, first, last in zip(*substring_dedup.anchored(names, bounds)):
            for s in range(first, last + 1):
                assert seen.setdefault(tuple(words[s:s + 20]), name) == name


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring_dedup.without_repeats(docs).count() == 0


def test_kept_digest(spark):
    rows = queries.op10_substring_dedup(spark, "/root/testdata/sf0.001").where("n_words = 0").collect()
    assert all(r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)


def test_least_takes_the_first_of_equal_keys():
    keys = np.array([5, 3, 3, 9, 1, 1, 7], np.uint64)
    begin, end = np.array([0, 1, 3, 4, 6, 0]), np.array([3, 2, 6, 5, 6, 6])
    assert substring_dedup._least(keys, begin, end).tolist() == [1, 1, 4, 4, 6, 4]
