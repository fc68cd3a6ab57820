"""Context-triggered piecewise hashing: fingerprints that survive local edits.

A rolling hash over the last seven bytes ends a chunk wherever it hits the block size, so
an edit moves the boundaries near it only. Each chunk gives one character of the
signature; a second signature has double the block size. Fingerprints whose block sizes
are equal or differ by a factor of two are compared by the edit distance of the
signatures that have the same block size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Powers, map_arrow, mix, renamed, slices

LENGTH = 64
ROLLING = 7
SMALLEST = 3
#: Length of a common piece without which signatures are not alike.
COMMON = 7
#: Text of a range of rows that one task walks through, and the ranges at most.
RANGE_BYTES = 4 << 20
RANGES = 32_768

_CHARS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = Powers(0x9E3779B97F4A7C15)
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}


def fingerprint(text: str | None) -> str:
    """``block size:signature:signature at double size`` of the text's UTF-8 bytes."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    if not n:
        return f"{SMALLEST}::"
    prefix = _ROLL.prefix(raw.astype(np.uint64) + np.uint64(1))
    end = np.arange(1, n + 1)
    rolled = mix(_ROLL.span(prefix, np.maximum(end - ROLLING, 0), end)) >> np.uint64(20)
    hit = np.flatnonzero(rolled % np.uint64(SMALLEST) == 0)
    value = rolled[hit] // np.uint64(SMALLEST)
    power = 0
    while SMALLEST * LENGTH << power < n:
        power += 1
    while True:
        first = _cuts(hit, value, power, n, LENGTH)
        if power == 0 or len(first) >= LENGTH // 2:
            break
        power -= 1
    second = _cuts(hit, value, power + 1, n, LENGTH // 2)
    return f"{SMALLEST << power}:{_signature(prefix, first)}:{_signature(prefix, second)}"


def _cuts(hit, value, power, n, most):
    """Ends of the chunks at a block size; the last chunk takes all that is left."""
    ends = hit[(value & np.uint64((1 << power) - 1)) == 0] + 1
    ends = ends[:most - 1]
    return ends if len(ends) and ends[-1] == n else np.append(ends, n)


def _signature(prefix, ends):
    begins = np.append(0, ends[:-1])
    names = mix(_ROLL.span(prefix, begins, ends) + (ends - begins).astype(np.uint64))
    return _CHARS[(names >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def _plain(signature: str) -> str:
    """Without more than three equal characters in a row: they say little."""
    return "".join(c for i, c in enumerate(signature) if signature[max(0, i - 3):i] != c * 3)


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, column by column in the bits of a number."""
    full = (1 << len(a)) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    a, b = _plain(a), _plain(b)
    need = min(COMMON, max(2, min(len(a), len(b)) // 2))
    pieces = {a[i:i + need] for i in range(len(a) - need + 1)}
    if not any(b[i:i + need] in pieces for i in range(len(b) - need + 1)):
        return 0.0
    return 2 * _common_length(a, b) / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """From 0 (nothing in common, or block sizes too far apart) to 1 (equal).

    One minus the share of insertions and deletions that turn one signature into the other.
    """
    if one == two:
        return 1.0
    (a, a1, a2), (b, b1, b2) = one.split(":"), two.split(":")
    a, b = int(a), int(b)
    if a == b:
        return max(_alike(a1, b1), _alike(a2, b2))
    if a == 2 * b:
        return _alike(a1, b2)
    if b == 2 * a:
        return _alike(a2, b1)
    return 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, fingerprint) per row of ``docs``; a NULL text counts as empty.

    Equal texts have equal fingerprints. Ids are only carried, NULL or repeated or not;
    other columns are not read; an empty table gives no rows.
    """
    source = renamed(docs, doc_id=id_col, text=text_col)

    def run(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([fingerprint(t) for t in batch.column(1).to_pylist()])],
                ["doc_id", "fingerprint"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_arrow(source, run, f"doc_id {kind}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _placed(rows: DataFrame, heads: list[tuple]) -> DataFrame:
    """``part``: which of ``heads``, in descending order, is the last not below (key, hash).

    ``target`` is set on rows equal to a head: the range before, which the row follows. Heads are
    one constant of 16 bytes each, in which every row takes a binary search.
    """
    lowest, width = -1 << 63, 16
    ordered = F.lit(b"".join((k - lowest << 64 | h - lowest).to_bytes(width, "big") for k, h in heads))
    row = F.unhex(F.concat(*[F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(lowest))), width, "0")
                             for c in ("key", "hash")]))

    def head(place):
        return F.substring(ordered, place * width + 1, F.lit(width))

    steps = [1 << i for i in reversed(range(len(heads).bit_length()))]
    part = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        head(at + step) >= F.col("row"), at + step).otherwise(at))
    return (rows.withColumn("row", row).withColumn("part", part)
            .withColumn("target", F.when(head(F.col("part")) == F.col("row"),
                                         F.pmod(F.col("part") - 1, F.lit(len(heads))))).drop("row"))


def with_next(docs: DataFrame, work, schema: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``work(id, text, next text)`` for every row, next in descending id, wrapping around.

    Texts are shuffled once, into ranges of (id, hash of the text). The only row that a range
    needs from outside, the first of the next lower one, is found beforehand from ids and hashes
    and dealt to both. Rows that repeat an id follow each other by a hash of their text;
    rows without an id come last, in the same way, so either may fill many ranges; rows equal
    in both share one. ``work`` returns a tuple for ``schema``.
    """
    lowest = -1 << 63
    missing, raw = F.col(f"`{id_col}`").isNull(), F.xxhash64("text")
    # Rows without an id share their key with the lowest id; the sign of the hash parts them.
    source = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(lowest)).alias("key"),
        missing.alias("missing"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn(
        "hash", F.when(F.col("missing"), raw.bitwiseOR(F.lit(lowest)))
        .when(F.col("key") == lowest, raw.bitwiseAND(F.lit(~lowest))).otherwise(raw))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0]
    ranges = max(1, min(RANGES, (size or 0) // RANGE_BYTES))
    spread = source.select("key", "hash").repartitionByRange(ranges, F.desc("key"), F.desc("hash"))
    heads = (spread.groupBy(F.spark_partition_id().alias("part"))
             .agg(F.max(F.struct("key", "hash")).alias("head")).collect())
    heads = sorted((tuple(r.head) for r in heads), reverse=True)
    # The first row of each range, as many as there are ranges. Without rows any one will do.
    source = _placed(source, heads or [(0, 0)])
    own = F.struct(F.col("part"), F.lit(0).alias("copy"))
    copied = F.struct(F.col("target").alias("part"), F.lit(1).alias("copy"))
    dealt = (source
             .select("key", "missing", "text", "hash", F.explode(
                 F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, copied))).alias("at"))
             .select("at.part", "at.copy", "key", "missing", "text", "hash"))
    ordered = (dealt.repartition(ranges, "part")
               .sortWithinPartitions("part", "copy", F.desc("key"), F.desc("hash")))

    def run(batches):
        waiting, now, closed = None, None, False
        for batch in slices(batches, "text"):
            out = []
            for part, copy, key, missing, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if part != now:
                    waiting, now, closed = None, part, False
                if closed:
                    continue
                if waiting is not None:
                    out.append(work(*waiting, text))
                waiting, closed = (None if missing else key, text), bool(copy)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)

    fields = docs.sparkSession.createDataFrame([], schema).schema.fields
    names, types = [f.name for f in fields], [_ARROW[f.dataType.simpleString()] for f in fields]
    return map_arrow(ordered.drop("hash"), run, schema)


def likeness_to_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next: how like the fingerprint of the whole text is to that of the
    edited text (its last half replaced by the first of the next document's) and to the next
    document's.

    A NULL text counts as empty. Rows that repeat an id or have none: see ``with_next``.
    The only row of a table is its own next. An empty table gives no rows; other columns
    are not read.
    """
    kept: dict[str, str] = {}

    def own(text):
        """A text is met as itself and as the next one: its fingerprint is made once."""
        found = kept.get(text)
        if found is None:
            found = fingerprint(text)
            if len(kept) >= 4:
                kept.pop(next(iter(kept)))
            kept[text] = found
        return found

    def work(key, text, following):
        edited = edited_text(text, following)
        one, two, other = own(text), fingerprint(edited), own(following)
        return (key, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                one, two, likeness(one, two), likeness(one, other))

    return with_next(docs, work, "doc_id bigint, n_chars bigint, edited_sha256 string, "
                     "fingerprint string, edited_fingerprint string, near_edited double, "
                     "near_next double", id_col, text_col)
