"""WARC: records, monolithic gzip, the normaliser and reading by offset."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib

import pytest

from millrace.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1) for i, u, h in rows],
                                 "page_id bigint, url string, html string, size int")


def expected(rows):
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        last = max(k for k, _, h in rows if (h or "") == (html or ""))
        out.append((key, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "response" if key == last else "revisit", None if key == last else last))
    return sorted(out)


def found(spark, rows, **options):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(warc.archive(pages(spark, rows).repartition(3), **options).select(*columns)
                  .collect(), key=repr)


def test_archive(spark):
    rows = [(i, f"http://h/{i}?q=a b\r\nX: y", f"<p>page {i % 7} \r\n\r\n WARC/1.1 é</p>" * (i % 7))
            for i in range(40)] + [(77, None, None), (78, "http://x", ""), (79, "u", "x" * 3_000_000)]
    assert [tuple(r) for r in found(spark, rows)] == sorted(expected(rows), key=repr)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(5, "a", "same"), (5, "a", "same"), (5, "b", "same"), (3, "a", "same"), (None, "a", "same"),
            (None, None, "other")]
    got = [(r.page_id, r.record_type, r.refers_to) for r in found(spark, rows)]
    assert sorted(got, key=repr) == sorted([
        (5, "response", None), (5, "revisit", 5), (5, "revisit", 5), (3, "revisit", 5),
        (None, "revisit", 5), (None, "response", None)], key=repr)


def test_empty_table(spark):
    assert warc.archive(pages(spark, [])).count() == 0


def test_files(spark, tmp_path):
    rows = [(i, "http://h/", "text " * i) for i in range(30)]
    warc.archive(pages(spark, rows).repartition(1), tmp_path.as_uri()).collect()
    raw, normal = (sorted((tmp_path / d).glob("[!.]*.gz")) for d in ("raw", "records"))
    assert [p.name for p in raw] == [p.name for p in normal] and raw
    for one, many in zip(raw, normal):
        whole = gzip.decompress(one.read_bytes())
        assert gzip.decompress(many.read_bytes()) == whole
        inflate = zlib.decompressobj(31)
        assert inflate.decompress(one.read_bytes()) == whole and not inflate.unused_data
        data, index = many.read_bytes(), [json.loads(x) for x in many.with_name(many.name + ".idx").open()]
        for entry in index:
            member = zlib.decompress(data[entry["offset"]:entry["offset"] + entry["length"]], 31)
            assert member.startswith(b"WARC/1.1\r\nWARC-Type: " + entry["type"].encode())
            assert entry["id"].encode() in member
        assert sum(e["length"] for e in index) == len(data)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_streams_may_be_cut_anywhere(chunk):
    whole = [warc.record(i, "http://h", 3, "D", b"a\r\n\r\nWARC/1.1\r\n" * i) for i in range(5)]
    whole.append(warc.record(9, "http://h", 3, "D", None, 4))
    packed = gzip.compress(b"".join(whole[:2])) + gzip.compress(b"".join(whole[2:]))
    parts = (packed[i:i + chunk] for i in range(0, len(packed), chunk))
    assert [data for _, _, data in warc.records(warc.inflated(parts))] == whole


def test_broken_archives_are_told():
    whole = gzip.compress(warc.record(1, "u", 1, "D", b"x"))
    with pytest.raises((EOFError, zlib.error)):
        list(warc.records(warc.inflated(iter([whole[:-9]]))))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))


def test_archives_roll_over(spark, tmp_path):
    rows = [(i, "http://h/", f"{i} " * 2000) for i in range(40)]
    made = warc.write_monolithic(warc.as_records(pages(spark, rows).coalesce(1)), tmp_path.as_uri(), 20_000)
    assert made.count() > 3
    back = warc.read_back(warc.normalised(made, f"{tmp_path.as_uri()}/n"))
    assert sorted(r.page_id for r in back.collect()) == list(range(40))
