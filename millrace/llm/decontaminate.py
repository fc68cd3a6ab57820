"""Benchmark decontamination: exact pieces first, then an edit distance in bits.

A test item of m words may differ from a passage by k word edits. Cut into k + 1
pieces, one of them must occur exactly. All pieces of a block of items are looked up in
every document by their hash; around each hit Myers' bit-parallel distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import (Powers, joined, map_slices, mix, per_text, renamed, word_bounds,
                                 word_hashes)

#: Word edits allowed per word of an item.
ERROR_RATE = 0.2
#: Words of items that are broadcast together; more items make more blocks.
BLOCK_WORDS = 500_000

_SPAN = Powers(0xA0761D6478BD642F)
_SIEVE = 20

#: ASCII other than letters and digits parts words.
_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(texts: pa.Array):
    """Names of the lower-cased words of all texts, and where each text's words begin."""
    raw, offsets = joined(texts, lower=True)
    begin, end = word_bounds(raw, _APART)
    return word_hashes(raw, begin, end), per_text(begin, offsets)


def budget(words: int, rate: float = ERROR_RATE) -> int:
    return int(words * rate + 1e-9)


def masks(pattern: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for i, word in enumerate(pattern):
        found[word] = found.get(word, 0) | 1 << i
    return found


def closest(pattern: dict[int, int], size: int, text: list[int]) -> tuple[int, int]:
    """The least distance of the pattern to a stretch of ``text`` and its first end."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, at = full, 0, size, size, 0
    for i, word in enumerate(text):
        equal = pattern.get(word, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        plus, minus = down | ~(across | up) & full, up & across
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(vertical | plus) & full, plus & vertical
        if score < best:
            best, at = score, i + 1
    return best, at


@dataclass
class Pieces:
    """The pieces of one length: sorted names, and for each the items and offsets."""
    size: int
    names: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    sieve: np.ndarray


@dataclass
class Block:
    ids: list
    words: list[list[int]]
    masks: list[dict[int, int]]
    budgets: list[int]
    pieces: list[Pieces]


def block_of(ids: list, texts: list[str | None], rate: float = ERROR_RATE) -> Block:
    names, begin = words_of(pa.array(texts, pa.string()))
    prefix = _SPAN.prefix(names)
    rows = []
    for item in range(len(ids)):
        size = int(begin[item + 1] - begin[item])
        parts = budget(size, rate) + 1
        cuts = begin[item] + np.arange(parts + 1) * size // parts
        rows += [(int(b - a), item, int(a - begin[item]), int(a)) for a, b in zip(cuts, cuts[1:]) if b > a]
    words = [names[a:b].tolist() for a, b in zip(begin, begin[1:])]
    made = []
    table = np.array(rows, np.int64).reshape(-1, 4)
    for size in np.unique(table[:, 0]):
        own = table[table[:, 0] == size]
        name = mix(_SPAN.span(prefix, own[:, 3], own[:, 3] + size))
        order = np.argsort(name, kind="stable")
        unique, first = np.unique(name[order], return_index=True)
        sieve = np.zeros(1 << _SIEVE, bool)
        sieve[unique >> np.uint64(64 - _SIEVE)] = True
        made.append(Pieces(int(size), unique, np.append(first, len(own)), own[order, 1],
                           own[order, 2], sieve))
    return Block(ids, words, [masks(w) for w in words], [budget(len(w), rate) for w in words], made)


def _blocks(items: DataFrame, rate: float, block_words: int) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        if not row.text:
            continue
        words = len(row.text.split()) + 1
        if ids and size + words > block_words:
            yield block_of(ids, texts, rate)
            ids, texts, size = [], [], 0
        ids.append(row.item)
        texts.append(row.text)
        size += words
    if ids:
        yield block_of(ids, texts, rate)


def hits(block: Block, names: np.ndarray, begin: np.ndarray):
    """(row, item, first word) that each exact piece hit puts its item at, distinct and sorted."""
    prefix, found = _SPAN.prefix(names), []
    for pieces in block.pieces:
        at = np.arange(max(0, len(names) - pieces.size + 1))
        name = mix(_SPAN.span(prefix, at, at + pieces.size))
        at = np.flatnonzero(pieces.sieve[name >> np.uint64(64 - _SIEVE)])
        place = np.minimum(np.searchsorted(pieces.names, name[at]), len(pieces.names) - 1)
        right = pieces.names[place] == name[at]
        at, place = at[right], place[right]
        row = np.searchsorted(begin, at, "right") - 1
        inside = at + pieces.size <= begin[row + 1]
        at, place, row = at[inside], place[inside], row[inside]
        count = pieces.first[place + 1] - pieces.first[place]
        which = np.repeat(np.arange(len(at)), count)
        within = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        entry = pieces.first[place][which] + within
        found.append(np.stack([row[which], pieces.item[entry], at[which] - pieces.offset[entry]], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def matches(block: Block, names: np.ndarray, begin: np.ndarray):
    """Best match (row, item, distance, first word, end) of each text and item in budget."""
    out, found = [], hits(block, names, begin)
    heads = []
    if len(found):
        heads = np.flatnonzero(np.append(True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1)))
    for a, b in zip(heads, [*heads[1:], len(found)]):
        row, item = int(found[a, 0]), int(found[a, 1])
        k, size = block.budgets[item], len(block.words[item])
        first, end, best = int(begin[row]), int(begin[row + 1]), None
        stretches: list[list[int]] = []
        for start in found[a:b, 2].tolist():
            low, high = max(first, start - k), min(end, start + size + k)
            if stretches and low <= stretches[-1][1]:
                stretches[-1][1] = high
            else:
                stretches.append([low, high])
        for low, high in stretches:
            distance, stop = closest(block.masks[item], size, names[low:high].tolist())
            if distance <= k and (best is None or distance < best[0]):
                best = distance, low, low + stop
        if best:
            distance, low, stop = best
            back = masks(block.words[item][::-1])
            _, length = closest(back, size, names[low:stop][::-1].tolist())
            out.append((row, item, distance, stop - length - first, stop - first))
    return out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text",
                 rate: float = ERROR_RATE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row (doc_id, item_id, distance, first_word, end_word, item_words) per row of
    ``docs`` and item that it holds within the item's budget of ``rate`` edits a word.

    Words are runs of letters, digits and characters beyond ASCII, lower-cased. The row tells the
    closest place, the first of equal ones. Items are the query set: they are broadcast in blocks
    of ``block_words`` words, and every document is searched for every block.

    NULL and empty texts and items match nothing. Rows or items that repeat give a row each.
    Ids are only carried. No items or no documents give no rows; other columns are not read.
    """
    source = renamed(docs, key=id_col, text=text_col)
    queries = renamed(items, item=item_id, text=item_text)
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((source, "key"), (queries, "item"))]
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, first_word int, "
              "end_word int, item_words int")
    spark, result = docs.sparkSession, None
    for block in _blocks(queries, rate, block_words):
        shared = spark.sparkContext.broadcast(block)

        def work(batch, shared=shared):
            block = shared.value
            found = matches(block, *words_of(batch.column(1)))
            if found:
                rows, item, distance, first, end = (list(c) for c in zip(*found))
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)),
                     pa.array([block.ids[i] for i in item]).cast(item_type),
                     *[pa.array(c, pa.int32()) for c in (distance, first, end)],
                     pa.array([len(block.words[i]) for i in item], pa.int32())],
                    ["doc_id", "item_id", "distance", "first_word", "end_word", "item_words"])

        item_type = pa.int64() if kinds[1] == "bigint" else pa.array(block.ids).type
        part = map_slices(source, "text", schema, work)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], schema) if result is None else result


def without_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      item_text: str = "text", rate: float = ERROR_RATE,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item within its budget.

    NULL and empty texts hold none. Rows are judged one by one by their text, so rows that repeat
    are judged alike; ids are not read. Without items all rows stay, and an empty table gives
    no rows.
    """
    place = docs.columns.index(text_col)
    queries = renamed(items.withColumn("__item", items[item_text]), item="__item", text=item_text)
    for block in _blocks(queries, rate, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(batch, shared=shared):
            found = matches(shared.value, *words_of(batch.column(place)))
            keep = np.ones(batch.num_rows, bool)
            keep[[m[0] for m in found]] = False
            return batch.filter(pa.array(keep))

        docs = map_slices(docs, text_col, docs.schema, work)
    return docs
