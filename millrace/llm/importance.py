"""Importance resampling towards a target distribution, ranked by regular sampling.

Features are runs of words, hashed into buckets. How often each bucket occurs in all
documents and in all target texts gives one array of gains; a document's weight is the sum
of the gains of its features. With seeded noise on the weight (Gumbel's distribution) the
highest scores are a sample without replacement.

Exact ranks come from parallel sorting by regular sampling. Each partition sorts its rows, a
run. Every so many rows of a run one is noted; from all of these, splitters are taken at
regular steps. They cut all runs into segments. Counts per segment, added up in order, say
where a segment's ranks begin and which segments are needed at all; only those are
exchanged, and each is merged by itself.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import (joined, map_arrow, map_slices, per_text, release, slices, stored,
                                 word_bounds)
from millrace.session import settle

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST = 1
SEED = 2024
#: Documents of fewer words are not drawn; of the others this share is, in per cent.
MIN_WORDS, PERCENT = 20, 10
#: Segments of about SEGMENT_ROWS, within these bounds, and notes per segment or run.
SEGMENT_ROWS, SEGMENTS, MOST_SEGMENTS, NOTES = 1 << 20, 16, 4096, 32

#: A-Z as a-z; all bytes but digits, letters and those of other characters separate words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BREAK = np.ones(256, bool)
_BREAK[0x30:0x3A] = _BREAK[0x61:0x7B] = _BREAK[0x80:] = False

#: Words of more bytes are taken one by one.
_LONG = 48
_ALL = 0xFFFFFFFF
_NO_ID = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    """The step of CRC-32 for each byte: eight divisions by its reversed polynomial."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    return step


_STEP = _crc_table()


def absorb(state: np.ndarray, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 states (not yet inverted) after the bytes begin..end of ``raw``, all at once."""
    state, size = state.copy(), end - begin
    for i in np.flatnonzero(size > _LONG).tolist():
        state[i] = zlib.crc32(raw[begin[i]:end[i]].tobytes(), int(state[i]) ^ _ALL) ^ _ALL
    short = np.flatnonzero(size <= _LONG)
    short = short[np.argsort(-size[short], kind="stable")]
    own, at, left = state[short], begin[short], size[short]
    for place in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -place, "left"))
        own[:n] = _STEP[(own[:n] ^ raw[at[:n] + place]) & 255] ^ (own[:n] >> np.uint32(8))
    state[short] = own
    return state


def features(texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST):
    """Words per text, features per text, and arrays (text, bucket) of all features."""
    raw, offsets = joined(texts)
    raw = _LOWER[raw]
    begin, end = word_bounds(raw, _BREAK)
    first = per_text(begin, offsets)
    words = np.diff(first)
    owner = np.repeat(np.arange(len(words)), words)
    state = absorb(np.full(len(begin), _ALL, np.uint32), raw, begin, end)
    found, open_ = [(owner, state)], np.arange(len(begin))
    for run in range(2, longest + 1):
        fits = open_ + run <= first[1:][owner[open_]]
        open_, state = open_[fits], state[fits]
        state = _STEP[(state ^ np.uint32(0x20)) & 255] ^ (state >> np.uint32(8))
        state = absorb(state, raw, begin[open_ + run - 1], end[open_ + run - 1])
        found.append((owner[open_], state))
    owner = np.concatenate([o for o, _ in found])
    bucket = (np.concatenate([s for _, s in found]) ^ np.uint32(_ALL)).astype(np.int64) % buckets
    return words, np.bincount(owner, minlength=len(words)), owner, bucket


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket occurs in column ``text``; ``buckets`` rows reach the driver."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            total += np.bincount(features(part.column(0), buckets, longest)[3], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = map_arrow(texts, count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the log of its smoothed share in the target over that in the
    source, rounded down."""
    buckets = len(source)
    top, bottom = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(t + 1) * top) / (float(s + 1) * bottom)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int,
           seed: int) -> DataFrame:
    """Rows (id, place, n_words, n_features, weight, score)."""
    key = F.col(f"`{id_col}`").cast("bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    given = docs.select(key.alias("id"), F.monotonically_increasing_id().alias("place"),
                        F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").alias("h"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    columns = ["id", "place", "n_words", "n_features", "weight", "score"]

    def weigh(part):
        words, n, owner, bucket = features(part.column(3), len(gain), longest)
        weight = np.zeros(len(words), np.int64)
        np.add.at(weight, owner, gain[bucket])
        score = weight + np.array([noise(h) for h in part.column(2).to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(words, pa.int64()), pa.array(n, pa.int64()),
             pa.array(weight), pa.array(score)], columns)

    return map_slices(given, "text", ", ".join(f"{c} bigint" for c in columns), weigh)


#: The order of ranks: descending score, then id (none last), then place.
_ORDER = ["down", "last_id", "place"]


def _and(rows: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*rows.schema.fields, StructField(name, kind)])


def _keys(batch: pa.RecordBatch):
    down, last, place = (np.asarray(batch.column(c)) for c in _ORDER)
    return lambda i: (int(down[i]), int(last[i]), int(place[i]))


def regular_notes(runs: DataFrame, stride: int) -> list[tuple]:
    """The keys of every ``stride``-th row of each run, in order."""
    def note(batches):
        seen = 0
        for batch in batches:
            at = np.arange((-seen - 1) % stride, batch.num_rows, stride)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    schema = ", ".join(f"{c} bigint" for c in _ORDER)
    return sorted(map(tuple, map_arrow(runs.select(*_ORDER), note, schema).collect()))


def with_segment(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Add ``segment``: how many splitters come before the row. Runs are sorted, so each
    splitter cuts a batch in two."""
    def cut(batches):
        for batch in batches:
            n, key = batch.num_rows, _keys(batch)
            segment = np.zeros(n, np.int32)
            if n:
                low, high = bisect_left(splitters, key(0)), bisect_left(splitters, key(n - 1))
                segment += low
                for s in splitters[low:high]:
                    segment[bisect_right(range(n), s, key=key):] += 1
            yield batch.append_column("segment", pa.array(segment))

    return map_arrow(runs, cut, _and(runs, "segment", IntegerType()))


def first_ranks(rows: DataFrame, drawn: int) -> DataFrame:
    """Add ``rank`` 1 to ``drawn`` in the order of the keys, NULL beyond."""
    unranked = F.lit(None).cast("bigint").alias("rank")
    if not drawn:
        return rows.select("*", unranked)
    runs = settle(rows.sortWithinPartitions(*_ORDER))
    parts, total = (runs.groupBy(F.spark_partition_id()).count()
                    .agg(F.count(F.lit(1)), F.sum("count")).first())
    if not total:
        return rows.select("*", unranked)
    pieces = min(MOST_SEGMENTS, max(SEGMENTS, total // SEGMENT_ROWS))
    # At most NOTES * (segments + runs) keys, three integers each, reach the driver.
    notes = regular_notes(runs, max(1, total // (NOTES * max(pieces, parts))))
    splitters = [notes[i * len(notes) // pieces] for i in range(1, pieces)] if notes else []
    segments = with_segment(runs, splitters)
    counts = dict(segments.groupBy("segment").count().collect())
    before, needed = {}, 0
    for segment in sorted(counts):
        before[segment], needed = needed, needed + counts[segment]
    last = max(s for s in before if before[s] < drawn)

    def number(batches):
        segment, done = None, 0
        for batch in batches:
            own = np.asarray(batch.column("segment"))
            rank = np.arange(len(own)) - np.searchsorted(own, own)
            if segment is not None:
                rank[own == segment] += done
            if len(own):
                segment, done = int(own[-1]), int(rank[-1]) + 1
            base = np.array([before[s] for s in own.tolist()], np.int64)
            rank = rank + base + 1
            yield batch.append_column("rank", pa.array(rank, mask=rank > drawn))

    exchanged = (segments.where(F.col("segment") <= last).repartition("segment")
                 .sortWithinPartitions("segment", *_ORDER))
    ranked = map_arrow(exchanged, number, _and(exchanged, "rank", LongType()))
    return (ranked.unionByName(segments.where(F.col("segment") > last).select("*", unranked))
            .drop("segment"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row (doc_id, n_features, weight, score, rank) per row of ``docs``.

    Words are stretches of digits, letters and characters beyond ASCII, after A-Z became a-z;
    features are runs of up to ``longest`` words joined by a space, repeats counted, in
    bucket CRC-32 modulo ``buckets``. Counts are those of all documents and all ``target``
    texts. ``weight`` is the sum of the gains of a document's features, ``score`` adds noise
    from SHA-256 of "``seed``:id". Of the documents of at least ``min_words`` words, ``percent``
    per cent (rounded down) are drawn: highest scores first, ties by smaller id. ``rank`` is
    their place in that order, NULL for all others.

    NULL and empty texts have no words, weight 0, and are not drawn unless ``min_words`` is 0. Rows
    without an id have noise of the empty id and come last of a tie. Rows that repeat an id
    count, and are drawn, one by one. Without target texts all gains follow the documents
    alone. An empty table gives no rows; columns other than those named are not read.
    """
    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    wanted = target.select(F.col(f"`{target_col}`").cast("string").alias("text"))
    gain = gains(bucket_counts(source, buckets, longest), bucket_counts(wanted, buckets, longest))
    rows, _ = stored(scored(docs, gain, id_col, text_col, longest, seed), "scores")
    release(docs.sparkSession)
    rows = rows.withColumns({"down": F.expr("~score"), "last_id": F.coalesce("id", F.lit(_NO_ID))})
    able = F.col("n_words") >= min_words
    drawn = percent * rows.where(able).count() // 100
    found = first_ranks(rows.where(able), drawn).unionByName(
        rows.where(~able).withColumn("rank", F.lit(None).cast("bigint")))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
