"""Language identification: the code, its decoding, held-out accuracy and edge rows."""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import language_id, queries


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 6, 12, 40])
def test_codewords_are_apart(languages):
    code = language_id.codewords(languages)
    assert code.shape[0] == languages and set(np.unique(code)) == {-1, 1}
    apart = min((a != b).sum() for a, b in combinations(code, 2))
    assert apart >= (code.shape[1] + 1) // 2 if languages <= 5 else apart >= 1
    assert len({c.tobytes() for c in code.T}) == code.shape[1]
    assert (np.abs(code.sum(axis=0)) < languages).all()


def test_a_wrong_bit_is_corrected():
    code = language_id.codewords(4)
    model = language_id.Model(["a", "b", "c", "d"], code, None, np.full(code.shape, 1 / 7))
    margins = []
    for row in range(4):
        for bit in range(7):
            margin = 5.0 * code[row]
            margin[bit] *= -1
            margins.append(margin)
    model.margins = lambda texts: np.array(margins)
    found, score = model.predict(["x"] * 28)
    assert found == [lang for lang in "abcd" for _ in range(7)] and (score > 0.25).all()


def test_held_out_accuracy(spark):
    found = queries.op2_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = found.join(docs, "doc_id").select("doc_id", "held_out", "lang", "lang_pred", "score", "text").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    told = [r for r in rows if r.held_out and len(r.text) > 40]
    assert sum(r.lang == r.lang_pred for r in told) >= 0.97 * len(told)


def test_texts_do_not_influence_each_other():
    texts = ["Der schnelle Fuchs", "", None, "x", "una canción española"]
    rng = np.random.default_rng(1)
    model = language_id.Model(["a", "b", "c"], language_id.codewords(3),
                              rng.normal(size=(2 << language_id.BITS, 3)).astype(np.float32), np.ones((3, 3)))
    together = model.predict(texts)
    alone = [model.predict([t]) for t in texts]
    assert together[0] == [a[0][0] for a in alone]
    assert np.allclose(together[1], [a[1][0] for a in alone])


def test_edge_rows(spark):
    rows = [(i, t, lang, 0.5) for i, (t, lang) in enumerate(
        [("der die das und nicht ein", "de")] * 5 + [("the of and that with", "en")] * 5
        + [("le la les des une que", None)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    model = language_id.fit(docs)
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "12 34 -"), (2, "nicht " * 40000), (3, "THE AND")],
                                "doc_id bigint, text string")
    found = sorted(map(tuple, language_id.identify(odd, model).collect()), key=repr)
    assert [(r[0], r[1]) for r in found] == [(1, "und"), (1, "und"), (2, "de"), (3, "en"), (None, "und")]
    assert [r[2] for r in found if r[1] == "und"] == [0.0] * 3
    assert language_id.identify(odd.where("false"), model).count() == 0
    assert sorted(r[0] for r in language_id.recognised(odd, model).collect()) == [2, 3]


@pytest.mark.parametrize("lang, expected", [(None, "und"), ("xx", "xx")])
def test_no_or_one_language(spark, lang, expected):
    docs = spark.createDataFrame([(1, "some text", lang)], "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert language_id.identify(docs, model).first()["lang_pred"] == expected


def test_bits_are_judged_on_rows_they_were_not_fitted_on(spark):
    # Languages 0 and 3 are one text each, 1 and 2 the same noise: bits that part 1 from 2
    # know the rows they were fitted on by heart and no others.
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("opqrstuvwxyz"), 40)) for _ in range(120)]
    rows = [(i, "aaab aab " * 4 if i % 2 else "cdcc dcd " * 4, "l0" if i % 2 else "l3") for i in range(120)]
    rows += [(200 + i, t, "l1" if i % 2 else "l2") for i, t in enumerate(noise)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    code, trust = model.code, model.trust
    even = np.abs(code.sum(axis=0)) == 0
    apart, other = even & (code[1] == code[2]), even & (code[1] != code[2])
    assert apart.sum() == 1 and other.sum() == 2 and np.allclose(trust.sum(axis=1), 1)
    assert (trust[1:3][:, apart] > 1.3 * trust[1:3][:, other]).all()
    right = model.margins(noise) * code[[1 if i % 2 else 2 for i in range(120)]] > 0
    assert right[:, other].mean() > 0.95  # so judged on the same rows they would be trusted


def test_too_many_languages_and_clashing_columns(spark, monkeypatch):
    rows = [(i, f"text {i}", f"l{i % 4}", 1, "x") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, fold int, lang_pred string")
    model = language_id.fit(docs)
    assert language_id.identify(docs, model).columns == ["doc_id", "lang_pred", "score", "ambiguous"]
    assert language_id.identify(docs, model).count() == 12
    assert set(language_id.recognised(docs, model).columns) == set(docs.columns)
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        language_id.fit(docs)
