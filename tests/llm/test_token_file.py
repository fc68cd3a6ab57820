"""Token files: the tokenizer's ids, their places, and exact round trips."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import queries, token_file

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected(rows):
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for (key, _), ids in zip(order, ids_of([t for _, t in order])):
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("file_bytes", [1 << 25, 20_000])
def test_given_documents(spark, monkeypatch, file_bytes):
    monkeypatch.setattr(token_file, "FILE_BYTES", file_bytes)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sorted(map(tuple, queries.op8_token_file(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert found == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (9, "Words, don't 123 ÉCOLE école"), (-4, "<|endoftext|> x"),
            (9, "again"), (None, "no id"), (7, "long " * 30000), (8, "a b c\x1cd\x85e İ ΑΣ Σ")]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id bigint, text string, part int, start int")
    files = token_file.write(docs.repartition(3), PATH, length=16)
    assert sorted(map(tuple, token_file.digests(files).collect()), key=repr) == expected(rows)
    back = {(r.doc_id, len(r.ids)): r.ids for r in token_file.read(files).collect()}
    assert all(list(back[k, len(i)]) == i for (k, _), i in zip(rows, ids_of([t for _, t in rows])))
    empty = token_file.write(docs.where("false"), PATH)
    assert empty.count() == 0 and token_file.digests(empty).count() == 0


def test_files_are_mapped_sequences_with_masks(spark, tmp_path):
    writer = token_file.Writer(tmp_path.as_uri(), "part", np.uint16, 8)
    writer.add(1, np.arange(5, dtype=np.uint16))
    writer.add(2, np.arange(100, 114, dtype=np.uint16))
    writer.close()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["part.arrow", "part.index"]
    file = token_file.TokenFile(f"{tmp_path.as_uri()}/part")
    line = [0, 1, 2, 3, 4, *range(100, 114)]
    assert len(file) == 3 and [file.sequence(i)[0].tolist() for i in range(2)] == [line[:8], line[8:16]]
    ids, mask = file.sequence(2)
    assert ids.tolist() == line[16:] + [0] * 5 and mask.to_pylist() == [True] * 3 + [False] * 5
    assert file.tokens(5, 14).tolist() == line[5:] and file.index.column("start").to_pylist() == [0, 5]
    # A view of the mapped file, not a copy of it.
    assert not ids.flags.owndata and not file.tokens(0, 5).flags.owndata


def test_many_batches_are_reached_directly(tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "BATCH", 4)
    writer = token_file.Writer(tmp_path.as_uri(), "part", np.uint32, 8)
    rng, whole = np.random.default_rng(1), []
    for key in range(60):
        ids = rng.integers(0, 1 << 20, rng.integers(1, 90)).astype(np.uint32)
        writer.add(key, ids)
        whole.append(ids)
    writer.close()
    file, line = token_file.TokenFile(f"{tmp_path.as_uri()}/part"), np.concatenate(whole)
    starts = np.cumsum([0, *map(len, whole)])
    assert all((file.tokens(int(s), len(w)) == w).all() for s, w in zip(starts, whole))
    stream = np.concatenate([i[np.asarray(m)] for i, m in map(file.sequence, range(len(file)))])
    assert (stream == line).all()


def test_query_gives_the_library_s_ids_of_special_tokens(spark, tmp_path):
    texts = ["a <|endoftext|> b", "x.<|endoftext|>,Y <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> é<|endoftext|>́ z",
             "a\x1c<|endoftext|>\x85b <|endof text|>", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    library, start = Tokenizer.from_file(PATH), 0
    for row in sorted(map(tuple, queries.op8_token_file(spark, str(tmp_path)).collect())):
        ids = library.encode(texts[row[0]], add_special_tokens=False).ids + [1]
        assert row == (row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_rows_of_one_id_fill_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_file, "FILE_BYTES", 2000)
    monkeypatch.setattr(token_file, "BLOCK", 4)
    rows = [(None, f"{i % 3} word{i} " * 20) for i in range(200)] + [(5, None), (4, "x"), (4, "x")]
    rows += [(None, "same beginning of a text that is longer than what places a row, " + c) for c in "abc"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    files = token_file.write(docs.repartition(5), PATH, length=16)
    assert files.count() > 8 and files.agg({"n_docs": "max"}).first()[0] < 60
    found = sorted(map(tuple, token_file.read(files).collect()), key=lambda r: r[1])
    assert [r[1] for r in found] == np.cumsum([0, *(len(r[2]) for r in found)])[:-1].tolist()
    assert [r[0] for r in found] == [None] * 203 + [4, 4, 5]
    assert sorted(list(r[2]) for r in found) == sorted(ids_of([t for _, t in rows]))


def test_words_in_any_script(monkeypatch):
    monkeypatch.setattr(token_file, "LINE", 7)
    texts = ["İstanbul ΑΣ ΣΑΣ straße STRASSE ŒUVRE ﬁne Ǆ don't l'été x1y2 漢字 かな한국 ไทย नमस्ते",
             "étude É́ ́a   a b \x85 ªº 가 Ⅷ ²", " \t\nab  cd\x0b\x0cef ", "", None]
    words = token_file.WordTokens(open(PATH, encoding="utf-8").read(), spell_special=True)
    for _ in range(2):  # the second time from what is kept
        ids, at = words.encode(pa.array(texts))
        assert [ids[b:e].tolist() for b, e in zip(at, at[1:])] == ids_of(texts)
    words.ends[:] = False  # a vocabulary that does not mark the ends of words
    words._forget()
    ids, at = words.encode(pa.array(texts))
    assert [ids[b:e].tolist() for b, e in zip(at, at[1:])] == ids_of(texts)
    ids, at = words.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and at.tolist() == [0]
