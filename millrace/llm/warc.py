"""WARC archives: writing, normalising monolithic gzip, reading back by offset.

Tasks write archives as one gzip stream each, the way careless tools do: nothing in
them can be reached without inflating all before it. The normaliser inflates such a
file once, as a stream, rewrites every record as a gzip member of its own and notes
each member's offset in a sidecar index. Any record can then be read by itself.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, release, renamed, slices
from millrace.session import scratch_path, settle

CHUNK = 1 << 20
LEVEL = 6
#: Inflated bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, size: int, digest: str,
           payload: bytes | None, refers_to: int | None = None) -> bytes:
    """A response with its payload, or without one a revisit of another record."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}",
            f"WARC-Record-ID: {_page_uri(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url or '', safe=_URL)}",
            f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if payload is None:
        head[3:3] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_page_uri(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL = "%/:?#[]@!$&'()*+,;=~-._"


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of one or more gzip members, as it comes."""
    inflate = None
    for chunk in chunks:
        while chunk:
            if inflate is None:
                inflate = zlib.decompressobj(31)
            yield inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof:
                inflate = None
            elif not chunk:
                break
    if inflate is not None:
        raise EOFError("a gzip member has no end")


def records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, block, whole record) one by one; only one record is held at a time."""
    held, at = bytearray(), 0

    def have(n):
        nonlocal held
        while len(held) < n:
            part = next(stream, None)
            if part is None:
                return False
            held += part
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(held) - 3)
            if not have(len(held) + 1):
                if bytes(held).strip():
                    raise EOFError("a record has no end")
                return
        lines = held[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin, size = end + 4, int(headers["Content-Length"])
        if not have(begin + size + 4):
            raise EOFError("a record has no end")
        yield headers, bytes(held[begin:begin + size]), bytes(held[:begin + size + 4])
        del held[:begin + size + 4]
        at = 0


def _chunks(file) -> Iterator[bytes]:
    while chunk := file.read(CHUNK):
        yield chunk


class _Whole:
    """A file that appears under its name only when it is complete."""

    def __init__(self, fs, path: str):
        self.fs, self.path = fs, path
        base, _, name = path.rpartition("/")
        self.open_path = f"{base}/.{name}-{uuid.uuid4().hex}"
        self.sink = fs.open_output_stream(self.open_path, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.sink.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.sink.close()
        self.fs.move(self.open_path, self.path)


def write_monolithic(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``rows`` (page_id, url, size, digest, payload, refers_to) as whole-file gzip.

    Returns the archives' paths. A task that is run again writes the same names anew.
    """
    def run(batches):
        number, part, archive, deflate, inside, paths = 0, None, None, None, 0, []

        def close():
            archive.write(deflate.flush())
            archive.close()
            paths.append(archive.path)

        for batch in slices(batches, "payload", 4_000_000):
            columns = (c.to_pylist() for c in batch.columns)
            for part, page_id, url, size, digest, payload, refers_to in zip(*columns):
                if archive is None:
                    fs, base = pafs.FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    archive = _Whole(fs, f"{base}/{part:06d}-{number:03d}.warc.gz")
                    deflate, inside = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                data = record(page_id, url, size, digest, payload, refers_to)
                archive.write(deflate.compress(data))
                inside += len(data)
                if inside >= archive_bytes:
                    close()
                    archive, number = None, number + 1
        if archive is not None:
            close()
        if paths:
            names = [f"{folder}/{p.rpartition('/')[2]}" for p in paths]
            yield pa.RecordBatch.from_pydict({"path": pa.array(names, pa.string())})

    numbered = rows.select(F.spark_partition_id().alias("part"), "page_id", "url", "size", "digest",
                           "payload", "refers_to")
    return settle(map_arrow(numbered, run, "path string"))


def normalise(archive: str, target: str, level: int = LEVEL) -> int:
    """Rewrite one archive record by record; returns how many there were.

    ``target`` gets the members and ``target`` + ``.idx`` a JSON line per record: offset,
    length, type, record id and target URI.
    """
    source, path = pafs.FileSystem.from_uri(archive)
    fs, to = pafs.FileSystem.from_uri(target)
    members, index, n = _Whole(fs, to), _Whole(fs, f"{to}.idx"), 0
    with source.open_input_stream(path, compression=None) as file:
        for headers, _, data in records(inflated(_chunks(file))):
            deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = deflate.compress(data) + deflate.flush()
            line = {"offset": members.size, "length": len(member), "type": headers["WARC-Type"],
                    "id": headers["WARC-Record-ID"], "uri": headers["WARC-Target-URI"]}
            index.write(json.dumps(line).encode() + b"\n")
            members.write(member)
            n += 1
    members.close()
    index.close()
    return n


def normalised(archives: DataFrame, folder: str) -> DataFrame:
    """``normalise`` every archive into ``folder``: a row (path, records) per result."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, base = pafs.FileSystem.from_uri(folder)
                fs.create_dir(base, recursive=True)
                target = f"{folder}/{path.rpartition('/')[2]}"
                yield pa.RecordBatch.from_pydict(
                    {"path": [target], "records": pa.array([normalise(path, target)], pa.int64())})

    spread = archives.select("path").repartition(archives.count() or 1, "path")
    return settle(map_arrow(spread, run, "path string, records bigint"))


def read_record(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record whose member stands at ``offset``."""
    file.seek(offset)
    headers, block, _ = next(records(iter([zlib.decompress(file.read(length), 31)])))
    return headers, block


def read_back(archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, each read by its offset.

    A response's size and digest are those of the payload found; a revisit has the full
    payload's in its headers. Rows (page_id, url, payload_bytes, payload_digest, record_type,
    refers_to).
    """
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _read(path)

    spread = archives.select("path").repartition(archives.count() or 1, "path")
    return map_arrow(spread, run, "page_id bigint, url string, payload_bytes bigint, "
                     "payload_digest string, record_type string, refers_to bigint")


def _read(path: str) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(path)
    rows: list[tuple] = []

    def made():
        columns = [list(c) for c in zip(*rows)]
        rows.clear()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    with (fs.open_input_file(base) as file,
          fs.open_input_stream(f"{base}.idx", compression=None) as index):
        rest = b""
        for chunk in _chunks(index):
            *lines, rest = (rest + chunk).split(b"\n")
            for line in lines:
                entry = json.loads(line)
                headers, block = read_record(file, entry["offset"], entry["length"])
                http, _, payload = block.partition(b"\r\n\r\n")
                revisit = headers["WARC-Type"] == "revisit"
                if revisit:
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                else:
                    size, digest = len(payload), payload_digest(payload)
                rows.append((_page_id(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], size, digest,
                             headers["WARC-Type"], _page_id(headers["WARC-Refers-To"]) if revisit else None))
                if len(rows) >= 4096:
                    yield made()
    if rows:
        yield made()


def as_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Rows for ``write_monolithic``: of equal payloads the largest id's is a response.

    Payloads meet by digest with a map-side maximum, so copies do not travel; a hot payload's
    revisits are small rows.
    """
    source = renamed(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    keyed = source.select("*", F.sha1("payload").alias("hex"),
                          F.octet_length("payload").cast("bigint").alias("size"))
    first = keyed.groupBy("hex", "size").agg(F.max(F.struct("page_id", "url", "payload")).alias("first"))
    responses = first.select("first.page_id", "first.url", "size", _base32("hex").alias("digest"),
                             "first.payload", F.lit(None).cast("bigint").alias("refers_to"))
    small = keyed.select("page_id", "url", "hex", "size")
    shared = (small.groupBy("hex", "size").agg(F.max(F.struct("page_id", "url")).alias("first"),
                                               F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("hex", "size", F.col("first.page_id").alias("to"),
                                     F.col("first.url").alias("to_url")))
    others = small.join(shared, ["hex", "size"])
    same = F.col("page_id").eqNullSafe(F.col("to")) & F.col("url").eqNullSafe(F.col("to_url"))
    again = (others.where(same).groupBy("page_id", "url", "hex", "size", "to").count()
             .where("count > 1").select("page_id", "url", "hex", "size", "to",
                                        F.explode(F.sequence(F.lit(2), F.col("count")))).drop("col"))
    revisits = (others.where(~same).select("page_id", "url", "hex", "size", "to").unionByName(again)
                .select("page_id", "url", "size", _base32("hex").alias("digest"),
                        F.lit(None).cast("binary").alias("payload"), F.col("to").alias("refers_to")))
    return responses.unionByName(revisits)


def _base32(column: str):
    """Base32 of 40 hexadecimal digits: each character is five bits of two digits."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    places = []
    for i in range(32):
        value = F.conv(F.substring(column, 5 * i // 4 + 1, 2), 16, 10).cast("int")
        five = F.shiftright(value, 3 - 5 * i % 4).bitwiseAND(31)
        places.append(F.substring(letters, five + 1, F.lit(1)))
    return F.concat(*places)


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per page, normalise the archives and read every record back.

    One row (page_id, url, payload_bytes, payload_digest, record_type, refers_to) per row of
    ``pages``. The payload is the html in UTF-8; NULL is an empty payload. Of equal
    payloads, empty ones too, that of the largest page_id is the response, the others are
    revisits. Rows that repeat an id and payload are revisits of their own id but for one. A
    NULL id counts as smallest. URLs are percent-encoded where a header demands it, a
    NULL one is empty. An empty table gives no rows; other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    raw = write_monolithic(as_records(pages, id_col, url_col, html_col), f"{folder}/raw")
    release(pages.sparkSession)
    return read_back(normalised(raw, f"{folder}/records"))
