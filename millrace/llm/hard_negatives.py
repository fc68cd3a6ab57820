"""Hard negatives by a secondary sort.

Scores of (anchor, row) pairs are shuffled by anchor and sorted by (anchor, descending score,
id): ``repartition`` and ``sortWithinPartitions`` over three key columns. A streaming
iterator walks each anchor once: a positive opens a window of scores, negatives after it
that fall into an open window are emitted. It holds the open windows, never an anchor's rows.

Two rounds keep most pairs out of the shuffle without losing one that could be returned. Rows
are dealt over blocks of equal size and all anchors visit every block, in small batches.
First each block returns an anchor's best positives there; of these the sort finds the best
ones of all. Then, with the windows known, each block returns the first negatives of each
window there. So an anchor gets at most (windows x negatives) rows per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, release, stored

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these shares of the positive's, in per cent.
LOW, HIGH = 30, 90
#: Components become floor(SCALE * x).
SCALE = 256
#: Blocks that rows are dealt over, at least; more only where one would pass BLOCK_BYTES.
BLOCKS = 32
BLOCK_BYTES = 128 << 20
#: Anchors and rows that are multiplied at a time.
BATCH, CHUNK = 256, 4096

_NO_ID = (1 << 63) - 1
_LEAST = -(1 << 63)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as long; what does not fit is the nearest long."""
    scaled = np.floor(values.astype(np.float64) * scale)
    # 2**63 - 1024 is the greatest double that is a long.
    whole = np.clip(scaled, -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)
    return np.where(scaled >= 2.0 ** 63, _NO_ID, whole)


def _pack(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    """Rows that take part, their vector as little-endian integers of 2 bytes, or 8 if wide."""
    vectors = batch.column(3)
    usable = np.asarray(pc.and_(vectors.is_valid(), batch.column(2).is_valid()))
    sizes = np.asarray(pc.list_value_length(vectors).fill_null(0)).astype(np.int64)
    flat = vectors.flatten()
    bad = ~np.isfinite(np.asarray(flat.cast(pa.float64()).fill_null(float("nan"))))
    ends = np.cumsum(sizes)
    sums = np.append(0, np.cumsum(bad))
    usable &= sums[ends] == sums[ends - sizes]
    whole = _whole(np.where(bad, 0, np.asarray(flat.cast(pa.float64()).fill_null(0))), scale)
    at = np.flatnonzero(usable)
    packed, wide = [], []
    for i in at.tolist():
        own = whole[ends[i] - sizes[i]:ends[i]]
        small = not len(own) or (own.min() >= -32768 and own.max() <= 32767)
        packed.append(own.astype("<i2" if small else "<i8").tobytes())
        wide.append(not small)
    rows = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(rows), batch.column(1).take(rows).fill_null(_NO_ID),
         batch.column(2).take(rows), pa.array(packed, pa.binary()), pa.array(wide, pa.bool_()),
         batch.column(4).take(rows)], ["place", "id", "label", "vector", "wide", "anchor"])


class Rows:
    """Rows of a block or a batch of anchors with vectors of one length, by id."""

    def __init__(self, table: pa.Table, at: np.ndarray, size: int):
        def column(name):
            return np.asarray(table.column(name).combine_chunks())[at]

        wide = column("wide")
        vectors = table.column("vector").take(pa.array(at)).to_pylist()
        if wide.any():
            flat = [np.frombuffer(v, "<i8" if w else "<i2").astype(np.int64)
                    for v, w in zip(vectors, wide)]
            self.matrix = np.concatenate(flat).reshape(len(at), size)
        else:
            self.matrix = np.frombuffer(b"".join(vectors), "<i2").reshape(len(at), size)
        self.place, self.id, self.label = column("place"), column("id"), column("label")
        self.scores = (table.column("scores").take(pa.array(at)).to_pylist()
                       if "scores" in table.column_names else None)
        self.longest = float(np.sqrt((self.matrix.astype(np.float64) ** 2).sum(1).max(initial=0)))

    def sorted_by(self, *keys: np.ndarray) -> "Rows":
        order = np.lexsort(keys[::-1])
        out = object.__new__(Rows)
        out.longest, out.scores = self.longest, None
        for name in ("matrix", "place", "id", "label"):
            setattr(out, name, getattr(self, name)[order])
        return out


def by_length(parts: list[pa.RecordBatch]) -> dict[int, Rows]:
    table = pa.Table.from_batches(parts)
    width = np.where(np.asarray(table.column("wide").combine_chunks()), 8, 2)
    sizes = np.asarray(pc.binary_length(table.column("vector")).combine_chunks()) // width
    return {int(n): Rows(table, np.flatnonzero(sizes == n), int(n)) for n in np.unique(sizes)}


def scores(a: Rows, a_at, b: Rows, b_at) -> np.ndarray:
    """Exact integer inner products, as floats where these hold them exactly.

    A sum of products is at most the product of the lengths, on any way to it. Scores that
    do not fit a long are the nearest long.
    """
    most = a.longest * b.longest
    left, right = a.matrix[a_at], b.matrix[b_at]
    for kind, limit in ((np.float32, 1 << 23), (np.float64, 1 << 52)):
        if most < limit:
            return left.astype(kind) @ right.astype(kind).T
    exact = left.astype(object) @ right.astype(object).T if left.shape[1] else np.zeros(
        (len(left), len(right)), object)
    return np.clip(exact, _LEAST, _NO_ID).astype(np.int64)


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int):
    """Of each group the first ``n`` by descending score, then id."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    start = np.searchsorted(group, group)
    order = order[np.arange(len(group)) - start < n]
    return order


def positives_in(block: Rows, anchors: Rows, n: int):
    """Rows (index of anchor, score, id): the best ``n`` of the anchor's label in the block.

    ``block`` is sorted by label, then id.
    """
    found = []
    for label in np.unique(anchors.label):
        own = np.flatnonzero(anchors.label == label)
        begin, end = (int(np.searchsorted(block.label, label, side)) for side in ("left", "right"))
        kept = [np.zeros(0, np.int64)] * 3
        for at in range(begin, end, CHUNK):
            rows = slice(at, min(at + CHUNK, end))
            score = scores(anchors, own, block, rows)
            other = (anchors.place[own, None] != block.place[None, rows]) & (
                (anchors.id[own, None] != block.id[None, rows]) | (anchors.id[own, None] == _NO_ID))
            if score.shape[1] > n:
                least = np.where(other, score, _least_of(score))
                other &= score >= np.partition(least, -n, axis=1)[:, -n, None]
            a, b = np.nonzero(other)
            now = [np.concatenate(x) for x in zip(kept, (
                own[a], score[a, b].astype(np.int64), block.id[rows][b]))]
            keep = first_of(*now, n)
            kept = [x[keep] for x in now]
        found.append(kept)
    return [np.concatenate(x) for x in zip(*found)]


def _least_of(score: np.ndarray):
    return -np.inf if score.dtype.kind == "f" else _LEAST


def windows(lists: list, low: int, high: int, n: int):
    """Per anchor and positive the least and the greatest score of a negative.

    ``low`` * p <= 100 * x <= ``high`` * p, in whole numbers. Missing ones are empty.
    """
    least, most = np.ones((len(lists), n), np.int64), np.zeros((len(lists), n), np.int64)
    for i, own in enumerate(lists):
        for j, p in enumerate(own):
            least[i, j], most[i, j] = -(-low * p // 100), high * p // 100
    return least, most


def negatives_in(block: Rows, anchors: Rows, least: np.ndarray, most: np.ndarray, n: int):
    """Rows (index of anchor, score, id) of other labels: the first ``n`` of each window."""
    kept = [np.zeros(0, np.int64)] * 3
    some = least <= most
    top = np.where(some, most, _LEAST).max(1)
    floor = np.where(some, least, _NO_ID)
    for at in range(0, len(block.id), CHUNK):
        rows = slice(at, at + CHUNK)
        score = scores(anchors, slice(None), block, rows)
        bounds = [floor.min(1), top]
        if score.dtype.kind == "f":
            edge = 1 << (23 if score.dtype == np.float32 else 52)
            bounds = [np.clip(x, -edge, edge).astype(score.dtype) for x in bounds]
        a, b = np.nonzero((score >= bounds[0][:, None]) & (score <= bounds[1][:, None])
                          & (anchors.label[:, None] != block.label[None, rows]))
        group, value, ids = (np.concatenate(x) for x in zip(kept, (
            a, score[a, b].astype(np.int64), block.id[rows][b])))
        order = np.lexsort((ids, -value, group))
        group, value, ids = group[order], value[order], ids[order]
        start, used = np.searchsorted(group, group), np.zeros(len(group), bool)
        for w in range(least.shape[1]):
            inside = (value >= least[group, w]) & (value <= most[group, w])
            before = np.append(0, np.cumsum(inside))
            number = before[1:] - before[start]
            used |= inside & (number <= n)
            last = np.flatnonzero(inside & (number == n))
            floor[group[last], w] = value[last]
        kept = [group[used], value[used], ids[used]]
    return kept


def _cells(batches: Iterator[pa.RecordBatch]):
    """Pairs (block, batch of anchors) of a stream sorted by cell: a block's rows come first.

    A cell is twice the block's number, plus one for its anchors.
    """
    held: list[pa.RecordBatch] = []
    block, number = None, None
    for batch in batches:
        cell = np.asarray(batch.column(0))
        starts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1 if len(cell) else 0))
        for begin, end in zip(starts.tolist(), np.append(starts[1:], len(cell)).tolist()):
            part, now = batch.slice(begin, end - begin), int(cell[begin])
            if now >> 1 != number:
                held, block, number = [], None, now >> 1
            if not now & 1:
                held.append(part)
            elif held or block:
                if block is None:
                    block, held = by_length(held), []
                for at in range(0, part.num_rows, BATCH):
                    yield block, part.slice(at, BATCH)


def _visits(packed: DataFrame, anchors: DataFrame, blocks: int, extra: str | None = None) -> DataFrame:
    """All rows dealt over the blocks, and all anchors in every block, as cells in order."""
    columns = ["place", "id", "label", "vector", "wide"]
    more = [extra] if extra else []
    rows = packed.select(F.expr(f"pmod(place, {blocks}) * 2").alias("cell"), *columns,
                         *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in more])
    visitors = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), *columns, *more).select(
        F.expr("cast(block AS bigint) * 2 + 1").alias("cell"), *columns, *more)
    return (rows.unionByName(visitors).repartition(blocks, F.expr("cell div 2"))
            .sortWithinPartitions("cell"))


_PAIR = "anchor bigint, down bigint, id bigint"


def _pairs(place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Keys of the secondary sort; ~score is its descending order without overflow."""
    return pa.RecordBatch.from_arrays([pa.array(place), pa.array(~score), pa.array(ids)],
                                      ["anchor", "down", "id"])


def best_positives(packed: DataFrame, anchors: DataFrame, blocks: int, n: int) -> DataFrame:
    """Rows (anchor, number, id, down): each anchor's first ``n`` other rows of its label."""
    def compare(batches):
        last, block = None, None
        for now, part in _cells(batches):
            if now is not last:
                last, block = now, {k: v.sorted_by(v.label, v.id) for k, v in now.items()}
            for size, own in by_length([part]).items():
                if size in block:
                    a, score, ids = positives_in(block[size], own, n)
                    yield _pairs(own.place[a], score, ids)

    def first(batches):
        number, anchor = 0, None
        for batch in batches:
            own = np.asarray(batch.column(0))
            start = np.searchsorted(own, own)
            rank = np.arange(len(own)) - start
            if anchor is not None:
                rank[own == anchor] += number
            if len(own):
                anchor, number = own[-1], rank[-1] + 1
            keep = pa.array(np.flatnonzero(rank < n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), pa.array(rank[np.asarray(keep)].astype(np.int32) + 1),
                 batch.column(2).take(keep), batch.column(1).take(keep)],
                ["anchor", "number", "id", "down"])

    pairs = map_arrow(_visits(packed, anchors, blocks), compare, _PAIR)
    order = pairs.repartition("anchor").sortWithinPartitions("anchor", "down", "id")
    return map_arrow(order, first, "anchor bigint, number int, id bigint, down bigint")


def window_negatives(packed: DataFrame, anchors: DataFrame, blocks: int, positives: int, n: int,
                     low: int, high: int) -> DataFrame:
    """Rows (anchor, down, id): per block the first ``n`` negatives of each window.

    ``anchors`` have a further column, the scores of their positives.
    """
    def compare(batches):
        last, block = None, None
        for now, part in _cells(batches):
            if now is not last:
                last, block = now, {k: v.sorted_by(v.id) for k, v in now.items()}
            for size, own in by_length([part]).items():
                if size in block:
                    least, most = windows(own.scores or [[]] * len(own.id), low, high, positives)
                    a, score, ids = negatives_in(block[size], own, least, most, n)
                    yield _pairs(own.place[a], score, ids)

    return map_arrow(_visits(packed, anchors, blocks, "scores"), compare, _PAIR)


def open_windows(stream: Iterator[tuple], n: int, low: int, high: int):
    """Walk (anchor, down, number, id) in order; ``number`` is 0 for a negative.

    Yields (anchor, id of the positive, rank, id of the negative, both scores). A positive
    comes before negatives of its score, so its window is open when they come.
    """
    anchor, opened = None, []
    for own, down, number, key in stream:
        if own != anchor:
            anchor, opened = own, []
        score = ~down
        if number:
            opened.append([key, score, 0])
            continue
        for window in opened:
            if window[2] < n and low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], key, window[1], score


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x becomes floor(``scale`` * x); a score is the inner product with the anchor,
    higher ones come first, ties by smaller id. Anchors are the rows where ``is_anchor``. An
    anchor's positives are its first ``positives`` other rows of the same label; per positive
    the first ``negatives`` rows of another label come back whose score lies between ``low``
    and ``high`` per cent of the positive's, ``rank`` from 1.

    Rows with a NULL label or vector, or with a NULL or non-finite component, take no part.
    Vectors of different lengths make no pair; empty ones score 0. A row without an id comes
    last of a tie and is named NULL. Rows that repeat an id count one by one, but a row with
    the anchor's id is no positive of it; of rows equal in label, score and id either is meant.
    Labels are integers. Integers beyond a long become the nearest long. An empty table, or
    one without anchors, gives no rows; columns other than the three named (and those of
    ``is_anchor``) are not read.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high must be shares of the positive's score, in per cent")
    spark = rows.sparkSession
    given = rows.select(
        F.monotonically_increasing_id().alias("place"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{label_col}`").cast("bigint").alias("label"), F.col(f"`{vector_col}`").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))

    def pack(batches):
        for batch in batches:
            yield _pack(batch, scale)

    packed, _ = stored(map_arrow(given, pack, "place bigint, id bigint, label bigint, vector binary, "
                                              "wide boolean, anchor boolean"), "vectors")
    size = packed.agg(F.sum(F.octet_length("vector") + 24)).first()[0] or 0
    blocks = max(BLOCKS, -(-size // BLOCK_BYTES))
    anchors = packed.where("anchor")
    best, _ = stored(best_positives(packed, anchors, blocks, positives), "positives")
    release(spark)

    lists = best.groupBy("anchor").agg(F.expr("collect_list(~down)").alias("scores"))
    asking = (anchors.drop("anchor").join(lists, F.col("place") == F.col("anchor")).drop("anchor"))
    pairs = (window_negatives(packed, asking, blocks, positives, negatives, low, high)
             .select("anchor", "down", F.lit(0).alias("number"), "id")
             .unionByName(best.select("anchor", "down", "number", "id")))
    # Positives (number above 0) before negatives of the same score.
    order = (pairs.repartition("anchor")
             .sortWithinPartitions("anchor", "down", F.expr("number = 0"), "id", "number"))

    def walk(batches):
        def stream():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []
        for row in open_windows(stream(), negatives, low, high):
            out.append(row)
            if len(out) == 1 << 14:
                yield _emitted(out)
                out = []
        if out:
            yield _emitted(out)

    found = map_arrow(order, walk, "place bigint, positive_id bigint, rank int, negative_id bigint, "
                                   "positive_score bigint, negative_score bigint")
    named = found.join(anchors.select("place", F.col("id").alias("anchor_id")), "place")

    def shown(name):
        return F.nullif(F.col(name), F.lit(_NO_ID)).alias(name)

    return named.select(shown("anchor_id"), shown("positive_id"), "rank", shown("negative_id"),
                        "positive_score", "negative_score")


def _emitted(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        ["place", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
