"""Encoding with merge-dropout against the library, a plain segmentation and round trips."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from millrace.llm import merge_dropout

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a  b ", "\n\n x\ty", "héllo world", "漢字テスト 😀😀", "a" * 500, "x\u0000y", "  \n  ",
         "The quick brown fox, unbelievably, jumps over 12,345 lazy dogs.", "ciónmente " * 30]


@pytest.fixture(scope="module")
def vocabulary():
    return merge_dropout.load(PATH)


def words_of(folder="/root/testdata/sf0.001"):
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column(0).to_pylist()
    return texts, sorted({w for t in texts for w in t.split()})


def test_without_dropout_ids_are_the_library_s(vocabulary):
    texts = words_of()[0] + TEXTS
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = merge_dropout.Encoder(vocabulary, 0.0)
    found = encoder.encode(texts, list(range(len(texts))))
    assert [i.tolist() for i in found] == library.encode(texts)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_words_together_are_segmented_as_one_by_one(vocabulary, dropout):
    words = words_of()[1][:3000] + [" the", "  x", "é", "漢", "▁a", "w" * 40, "\n"]
    keys = merge_dropout.mix(np.arange(len(words)).astype(np.uint64))
    together = vocabulary.segment_all(words, keys, dropout)
    alone = [np.array(vocabulary.segment(w, int(k), dropout), np.int32).tobytes() for w, k in zip(words, keys)]
    assert together == alone


def test_full_dropout_leaves_characters(vocabulary):
    assert len(vocabulary.segment(" thing", 5, 1.0)) == 6


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_and_variety(vocabulary, seed):
    texts = TEXTS + ["▁ literal ▁▁", " ▁"] + words_of()[0][:50]
    encoder = merge_dropout.Encoder(vocabulary, 0.3, seed)
    for _ in range(2):
        ids = encoder.encode(texts, list(range(len(texts))))
        assert [merge_dropout.decode(vocabulary, i.tolist()) for i in ids] == texts
    line = encoder.encode(["unbelievable " * 40], [1])[0]
    spelt = {tuple(p) for p in np.split(line, np.flatnonzero(line == vocabulary.id["▁"]))}
    assert len(spelt) > 1


def test_cache_bound_changes_nothing(vocabulary, monkeypatch):
    texts = words_of()[0][:40]
    whole = merge_dropout.Encoder(vocabulary).encode(texts, list(range(40)))
    monkeypatch.setattr(merge_dropout, "KEPT", 50)
    small = merge_dropout.Encoder(vocabulary)
    again = [i for t in range(0, 40, 5) for i in small.encode(texts[t:t + 5], list(range(t, t + 5)))]
    assert [i.tolist() for i in whole] == [i.tolist() for i in again]


def test_operator(spark):
    long = " ".join(random.Random(1).choice(["alpha", "beta", "Gamma"]) for _ in range(60000))
    rows = [(1, None, 1), (2, "", 1), (3, "same text", 1), (3, "same text", 1), (None, "no id", 1),
            (4, long, 1), (5, "▁", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids int")
    found = merge_dropout.encode(docs.repartition(3), PATH)
    got = {(r.doc_id, r.n_tokens): r for r in found.collect()}
    assert found.count() == 7 and all(r.lossless for r in got.values())
    assert got[1, 0].token_ids is None and got[2, 0].token_ids == []
    assert found.where("doc_id = 3").distinct().count() == 1
    assert merge_dropout.encode(docs.where("false"), PATH).count() == 0


def test_every_occurrence_is_drawn_by_itself(vocabulary):
    texts = words_of()[0][:40] + TEXTS + ["▁ literal ▁▁"]
    encoder = merge_dropout.Encoder(vocabulary)
    found = encoder.encode(texts, list(range(len(texts))))
    for number in range(len(texts)):
        words = merge_dropout._WORD.findall(" " + texts[number]) if texts[number] else []
        alone = [vocabulary.segment(w, int(k), merge_dropout.DROPOUT)
                 for w, k in zip(words, encoder._keys(number, len(words)))]
        assert found[number].tolist() == sum(alone, [])
    # One merge, skipped with chance 0.1.
    _, counts, good = encoder._spell([" a"] * 20000, encoder._keys(2, 20000))
    merges, _ = encoder.merges.take(np.array([encoder.number[" a"]]))
    assert len(merges) == 1 and abs((counts == 1).mean() - 0.9) < 0.01 and good.all()


def test_pairs_are_found_where_they_are(vocabulary):
    ranks = sorted(vocabulary.rank, key=vocabulary.rank.get)
    rng = random.Random(3)
    a = np.array([rng.randrange(-1, len(ranks)) for _ in range(20000)])
    b = np.array([rng.randrange(-1, 300) for _ in range(20000)])
    found = vocabulary._lookup(a, b)
    assert found.tolist() == [
        vocabulary.rank.get(ranks[x] + ranks[y], merge_dropout._NEVER) if min(x, y) >= 0 else merge_dropout._NEVER
        for x, y in zip(a.tolist(), b.tolist())]
    assert (found < merge_dropout._NEVER).sum() > 10


def test_a_wrong_id_is_seen(vocabulary):
    encoder = merge_dropout.Encoder(vocabulary, 0.0)
    texts = ["some words here", "others", "some words here"]
    assert encoder.encode_flat(texts, [1, 2, 3])[2].all()
    at = encoder.number[" words"]
    encoder.good[at] = False
    assert encoder.encode_flat(texts, [1, 2, 3])[2].tolist() == [False, True, False]
    raw, lengths = encoder.raw.take(np.array([at]))
    ids, counts = encoder.ids.take(np.array([at]))
    assert encoder._decodes(ids, counts, raw, lengths).all()
    assert not encoder._decodes(ids, counts, raw[::-1].copy(), lengths).any()
    assert not encoder._decodes(ids[:0], counts * 0, raw, lengths).any()


def test_a_word_has_more_segmentations_than_a_few(vocabulary):
    line = merge_dropout.Encoder(vocabulary).encode([" unbelievable" * 20000], [1])[0]
    spaced = np.cumsum([len(vocabulary.bytes_of[i]) for i in line.tolist()])
    cuts = np.searchsorted(spaced, np.arange(1, 20001) * 13 + 1)
    assert len({tuple(p) for p in np.split(line, cuts + 1)}) > 30
