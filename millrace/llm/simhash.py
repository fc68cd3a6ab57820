"""SimHash near-duplicates found at the anchor points of a covering code.

The 64 bits are cut into segments. Two fingerprints that differ in at most ``max_bits``
differ in at most ``max_bits // segments`` bits of some segment. The anchors of a segment
are the words of a covering code: a perfect Hamming code on 15 of its bits (every word
is within one bit of an anchor) and the rest as it is. A fingerprint goes to every anchor
within covering radius plus threshold, and is *at home* at its nearest one. Of a near
pair the second reaches the first one's home, so at an anchor only pairs with a member at
home are compared. Equal fingerprints are one node, however many documents share them.

An anchor that is home to many is dealt into a square of cells: its home members over the
rows, all its members over the columns. A member goes to every cell of its row or column,
so each pair that has to be compared meets in one cell, and no task gets the whole anchor.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, map_slices, renamed
from millrace.llm.components import Forest, components
from millrace.session import settle

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Bits of each segment: 15 coded ones and the free rest.
SEGMENTS = (21, 21, 22)
CODED = 15
#: Pairs compared at a time, of anchors with few; above ``SMALL`` pairs an anchor's
#: fingerprints are linked one by one.
PAIRS = 1 << 20
SMALL = 256
#: Fingerprints at home at one anchor, above which it is dealt into cells.
HOT_HOMES = 1 << 14
#: Copies of fingerprints made at a time.
COPIES = 1 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(lengths + 1) - 1
    begin = (end - lengths)[:len(words) - width + 1].tolist()
    value = xxhash.xxh64_intdigest
    hashes = np.array([value(line[i:j], 42) for i, j in zip(begin, end[width - 1:].tolist())],
                      ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(key, bits bigint) for every row; NULL texts have the fingerprint zero."""
    def work(batch):
        bits = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()],
                        np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["key", "bits"])

    return map_slices(renamed(docs, key=id_col, text=text_col).withColumn(
        "key", F.col("key").cast("bigint")), "text", "key bigint, bits bigint", work)


@cache
def _code(reach: int):
    """Of every 15-bit word: the code words within ``reach`` bits and how far they are.

    The nearest comes first. Unused places have the distance 99.
    """
    words = np.arange(1 << CODED)
    syndrome = np.zeros(1 << CODED, np.int64)
    for bit in range(CODED):
        syndrome ^= np.where(words >> bit & 1, bit + 1, 0)
    found, far = [], []
    for weight in range(reach + 1):
        for bits in combinations(range(CODED), weight):
            other = words ^ sum(1 << b for b in bits)
            found.append(other)
            far.append(np.where(syndrome[other] == 0, weight, 99))
    found, far = np.stack(found, 1), np.stack(far, 1)
    order = np.argsort(far, axis=1, kind="stable")
    width = int((far < 99).sum(axis=1).max())
    order = order[:, :width]
    return np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)


@cache
def _flips(bits: int, weight: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)])


def anchors(bits: np.ndarray, max_bits: int = MAX_BITS):
    """Rows (index into ``bits``, anchor, at home) for unsigned fingerprints."""
    near = max_bits // len(SEGMENTS)
    reach = near + 1
    rows, keys, home, shift = [], [], [], 0
    for number, size in enumerate(SEGMENTS):
        part = (bits >> np.uint64(shift)).astype(np.int64) & ((1 << size) - 1)
        shift += size
        coded, free = part & ((1 << CODED) - 1), part >> CODED
        words, far = _code(reach)
        for place in range(words.shape[1]):
            for weight in range(reach + 1):
                at = np.flatnonzero(far[coded, place] + weight <= reach)
                if not len(at):
                    continue
                for flip in _flips(size - CODED, weight):
                    key = words[coded[at], place] << 7 | (free[at] ^ flip)
                    rows.append(at)
                    keys.append(key | number << 22)
                    home.append(np.full(len(at), place == 0 and weight == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(home)


def home_anchors(bits: np.ndarray) -> np.ndarray:
    """The anchors at which unsigned fingerprints are at home, one of each segment."""
    nearest, keys, shift = _code(1)[0][:, 0], [], 0
    for number, size in enumerate(SEGMENTS):
        part = (bits >> np.uint64(shift)).astype(np.int64) & ((1 << size) - 1)
        shift += size
        keys.append(nearest[part & ((1 << CODED) - 1)] << 7 | part >> CODED | number << 22)
    return np.concatenate(keys)


def _hot_anchors(points, hot_homes):
    """(anchors, sides of their squares) of the anchors above ``hot_homes``, in order.

    There are 2^19 anchors at all, whatever the input: that bounds what comes to the driver.
    """
    def count(batch):
        keys, homes = np.unique(home_anchors(np.asarray(batch.column(0)).view(np.uint64)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(homes)], ["anchor", "homes"])

    def work(batches):
        return (count(b.slice(at, 1 << 16)) for b in batches for at in range(0, b.num_rows, 1 << 16))

    counts = map_arrow(points.select("bits"), work, "anchor bigint, homes bigint")
    hot = (counts.groupBy("anchor").agg(F.sum("homes").alias("homes"))
           .where(F.col("homes") > hot_homes).collect())
    hot = sorted((r["anchor"], -(-r["homes"] // hot_homes)) for r in hot)
    return np.array([a for a, _ in hot], np.int64), np.array([n for _, n in hot], np.int64)


def _scatter(bits):
    mixed = bits * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ mixed >> np.uint64(32)).astype(np.int64) & ((1 << 62) - 1)


def cells(bits, rows, keys, home, hot):
    """Yield (rows, cells, home) for the output of ``anchors``: an anchor is one cell unless
    it is ``hot``."""
    hot_keys, sides = hot
    if not len(hot_keys):
        yield rows, keys << 32, home
        return
    at = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
    is_hot = hot_keys[at] == keys
    yield rows[~is_hot], keys[~is_hot] << 32, home[~is_hot]
    rows, keys, home, side = rows[is_hot], keys[is_hot], home[is_hot], sides[at[is_hot]]
    place = _scatter(bits[rows])
    row, column = (place >> 31) % side, (place & ((1 << 31) - 1)) % side
    part = np.cumsum(2 * side) // COPIES
    for number in np.unique(part):
        own = np.flatnonzero(part == number)
        copy = np.repeat(own, side[own])
        step = np.arange(len(copy)) - np.repeat(np.cumsum(side[own]) - side[own], side[own])
        # Down its column as one of all; along its row too if at home.
        down = ~(home[copy] & (step == row[copy]))
        member = copy[down]
        yield rows[member], keys[member] << 32 | step[down] * side[member] + column[member], np.zeros(len(member), bool)
        along = home[copy]
        member = copy[along]
        yield rows[member], keys[member] << 32 | row[member] * side[member] + step[along], np.ones(len(member), bool)


def _link_large(bits, home, nodes, limit, link):
    """Walk a large anchor's fingerprints outwards; each one is reached once."""
    open_ = np.arange(len(bits))
    while len(open_):
        front, open_ = [open_[0]], open_[1:]
        while front and len(open_):
            x = front.pop()
            near = np.bitwise_count(bits[open_] ^ bits[x]) <= limit
            if not home[x]:
                near &= home[open_]
            found = open_[near]
            open_ = open_[~near]
            for y in found.tolist():
                link(int(nodes[x]), int(nodes[y]))
            front.extend(found.tolist())


def _link_small(bits, home, nodes, starts, sizes, limit, link):
    """All pairs (at home, any) of many small anchors in one go."""
    group = np.repeat(np.arange(len(starts)), sizes)
    at = np.flatnonzero(home)
    count = sizes[group[at]]
    left = np.repeat(at, count)
    offset = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
    right = starts[group[left]] + offset
    near = (np.bitwise_count(bits[left] ^ bits[right]) <= limit) & (left != right)
    for a, b in zip(nodes[left[near]].tolist(), nodes[right[near]].tolist()):
        link(a, b)


def near_links(points: DataFrame, max_bits: int = MAX_BITS, hot_homes: int = HOT_HOMES) -> DataFrame:
    """Links (a, b) that connect the nodes of ``points`` (node, bits) as far as they are near.

    A task returns only links that connect something new to it, a forest.

    ``bits`` must be distinct. Not every near pair is returned, but its ends are connected.
    ``points`` is read twice: anchors that are home to more than ``hot_homes`` are found first.
    """
    hot = _hot_anchors(points, hot_homes)

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                bits = np.asarray(part.column(1)).view(np.uint64)
                for rows, cell, home in cells(bits, *anchors(bits, max_bits), hot):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell * 2 + ~home), pa.array(bits.view(np.int64)[rows]),
                         part.column(0).take(pa.array(rows))], ["anchor", "bits", "node"])

    def compare(batches):
        seen, made, rest = Forest(), [], None

        def link(a, b):
            if seen.join(a, b):
                made.append((a, b))

        def close(anchor, bits, home, nodes):
            starts = np.flatnonzero(np.diff(anchor, prepend=-1))
            sizes = np.diff(np.append(starts, len(anchor)))
            homes = np.add.reduceat(home.astype(np.int64), starts)
            for g in np.flatnonzero((homes * sizes > SMALL) & (sizes > 1)).tolist():
                own = slice(starts[g], starts[g] + sizes[g])
                _link_large(bits[own], home[own], nodes[own], max_bits, link)
            few = (homes * sizes <= SMALL) & (homes > 0) & (sizes > 1)
            keep = np.repeat(few, sizes)
            cut = np.cumsum((homes * sizes)[few]) // PAIRS
            bits, home, nodes, sizes = bits[keep], home[keep], nodes[keep], sizes[few]
            for part in np.unique(cut):
                own = np.flatnonzero(cut == part)
                first = int(sizes[:own[0]].sum())
                span = slice(first, first + int(sizes[own].sum()))
                starts = np.cumsum(sizes[own]) - sizes[own]
                _link_small(bits[span], home[span], nodes[span], starts, sizes[own],
                            max_bits, link)

        def out():
            pairs = np.array(made, np.int64).reshape(-1, 2)
            made.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            code = np.asarray(batch.column(0))
            now = [code >> 1, np.asarray(batch.column(1)).view(np.uint64), code & 1 == 0,
                   np.asarray(batch.column(2))]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            rest = [x[last:].copy() for x in now]
            if last:
                close(*[x[:last] for x in now])
                yield out()
        if rest is not None:
            close(*rest)
            yield out()

    rows = map_arrow(points.select("node", "bits"), spread, "anchor bigint, bits bigint, node bigint")
    gathered = rows.repartition(F.expr("anchor div 2")).sortWithinPartitions("anchor")
    return map_arrow(gathered, compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of ``docs``.

    Words are stretches without space or 0x09-0x0D, after A-Z became a-z; ``shingle`` of
    them, joined by a space, are hashed (XXH64, seed 42), repeats included. A bit is set
    if over half of the hashes set it. Fingerprints link at ``max_bits`` or fewer
    differing bits; ``component_id`` is the smallest id reachable over links.

    NULL and empty texts have the fingerprint zero, which links like any other. Rows
    that repeat an id keep one row each. A row without an id gets the component of its
    fingerprint, NULL if no row in it has an id. An empty table gives no rows; columns
    other than the two named are not read.
    """
    if not 0 <= max_bits < 3 * len(SEGMENTS):
        raise ValueError("max_bits must be from 0 to 8")
    prints = settle(fingerprints(docs, id_col, text_col, shingle))
    points = settle(prints.where("key IS NOT NULL").groupBy("bits")
                     .agg(F.min("key").alias("node")))
    found = components(near_links(points, max_bits))
    of_bits = (points.join(found, "node", "left")
               .select("bits", F.coalesce("component", "node").alias("component_id")))
    return (prints.join(of_bits, "bits", "left")
            .select(F.col("key").alias("doc_id"),
                    F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
                    "component_id"))
