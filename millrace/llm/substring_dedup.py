"""Exact removal of long repeated passages by recompression.

Each round rewrites the sequence of symbols: runs of one symbol become a symbol named by
symbol and length, then neighbouring pairs of a left-class and a right-class symbol
become one named by both. Names and classes are keyed 64-bit hashes, so the rounds agree
on every name over the whole corpus without exchanging a dictionary. A symbol knows the
words it depends on; inside equal passages all symbols that depend on nothing outside
are equal. Every window of words takes one of them, the highest, as its anchor:
equal windows have equal anchors at equal places.

Spark then works on anchors, a seventh of the words or so. An anchor whose name occurs
once has no repeated window. Of anchors equal in name and in all words of their windows
the first one stays. Only windows whose anchor occurs in different surroundings,
at the ends of repeats, are verified one by one, by a 128-bit hash of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import (Powers, joined, map_slices, mix, per_text, release, renamed, stored,
                                 word_bounds, word_hashes)
from millrace.session import delete_path

WINDOW = 20
ROUNDS = 2
#: Words handled at a time; longer texts are handled in overlapping parts.
PART = 1 << 19
#: Bytes of text handled at a time.
SLICE = 1_500_000

_A, _B = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)
_U = np.uint64


def _extent(symbol_doc, low, high, first, last, doc_begin, doc_end):
    """Dependence on both neighbours of the stretch first..last of symbols."""
    n = len(symbol_doc)
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    left = (first > 0) & (symbol_doc[before] == symbol_doc[first])
    right = (last < n - 1) & (symbol_doc[after] == symbol_doc[last])
    return (np.where(left, low[before], doc_begin[symbol_doc[first]] - 1),
            np.where(right, high[after], doc_end[symbol_doc[last]] + 1))


def recompress(names: np.ndarray, doc: np.ndarray, doc_begin: np.ndarray,
               doc_end: np.ndarray, rounds: int = ROUNDS):
    """Per level (symbol, low, high): each symbol's name and the words it depends on.

    ``low`` and ``high`` leave the document where a symbol depends on its end.
    """
    low = np.arange(len(names))
    symbol, high = names, low + 1
    levels = [(symbol, low, high)]
    for number in range(1, rounds + 1):
        if not len(symbol):
            break
        same = doc[1:] == doc[:-1]
        head = np.flatnonzero(np.append(True, ~((symbol[1:] == symbol[:-1]) & same)))
        run = np.diff(np.append(head, len(symbol)))
        low, high = _extent(doc, low, high, head, head + run - 1, doc_begin, doc_end)
        symbol = symbol[head]
        symbol = np.where(run > 1, mix(symbol + run.astype(_U) * _U(0x9FB21C651E98DF25)), symbol)
        doc = doc[head]

        left = mix(symbol ^ _U(0xC2B2AE3D27D4EB4F * number % (1 << 64))) >> _U(63) == 0
        pair = np.append(left[:-1] & ~left[1:] & (doc[1:] == doc[:-1]), False)
        second = np.append(False, pair[:-1])
        own = np.arange(len(symbol))
        around_low, around_high = _extent(doc, low, high, own, own, doc_begin, doc_end)
        high = np.where(pair, np.append(high[1:], 0), np.where(left, around_high, high))
        low = np.where(left, low, around_low)
        both = mix(symbol * _U(0x9E3779B97F4A7C15) + np.append(symbol[1:], _U(0)) + _U(number))
        symbol = np.where(pair, both, symbol)[~second]
        low, high, doc = low[~second], high[~second], doc[~second]
        levels.append((symbol, low, high))
    return levels


def _least(keys: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the first least key in each begin..end (inclusive)."""
    out, width = np.zeros(len(begin), np.int64), end - begin + 1
    power = np.frexp(width)[1] - 1
    best, level = np.arange(len(keys)), 0
    while level <= (int(power.max()) if len(power) else -1):
        step = 1 << level
        at = np.flatnonzero(power == level)
        a, b = best[begin[at]], best[end[at] - step + 1]
        out[at] = np.where(keys[b] < keys[a], b, a)
        a, b = best[:-step], best[step:]
        best, level = np.where(keys[b] < keys[a], b, a), level + 1
    return out


def anchored(names: np.ndarray, doc_begin: np.ndarray, window: int = WINDOW,
             rounds: int = ROUNDS):
    """Anchors of all windows: (name, context, first window, last window).

    ``names`` are the words of all documents in a row, ``doc_begin`` their beginnings
    and the total. A window belongs to one anchor.
    """
    count, n = np.diff(doc_begin), len(names)
    doc = np.repeat(np.arange(len(count)), count)
    levels = recompress(names, doc, doc_begin[:-1], doc_begin[1:], rounds)
    todo = np.flatnonzero(np.arange(n) + window <= doc_begin[1:][doc]) if n else doc
    prefix, other = _A.prefix(names), _B.prefix(names)
    chosen, place, extent = np.zeros(n, _U), np.full(n, -1), np.zeros(n, np.int64)
    for number in range(len(levels) - 1, -1, -1):
        symbol, low, high = levels[number]
        fit = np.flatnonzero(high - low <= window)
        symbol, low, high = symbol[fit], low[fit], high[fit]
        inside = (low >= 0) & (high <= n)
        low, high, symbol = low[inside], high[inside], symbol[inside]
        if not len(todo) or not len(low):
            continue
        name = mix(_A.span(prefix, low, high) + mix(symbol + _U(number)))
        begin = np.cumsum(np.bincount(low + 1, minlength=n + 2))[todo]
        end = np.cumsum(np.bincount(high, minlength=n + 2))[todo + window] - 1
        seen = end >= begin
        best = _least(name, begin[seen], end[seen])
        at = todo[seen]
        chosen[at], place[at], extent[at] = name[best], low[best], high[best]
        todo = todo[~seen]
    start = np.flatnonzero(place >= 0)
    if not len(start):
        nothing = np.zeros(0, np.int64)
        return nothing.astype(_U), nothing.astype(_U), nothing, nothing
    name, low, high = chosen[start], place[start], extent[start]
    head = np.flatnonzero(np.append(True, (np.diff(low) != 0) | (np.diff(high) != 0)
                                    | (name[1:] != name[:-1]) | (np.diff(start) != 1)))
    first, last = start[head], start[np.append(head[1:], len(start)) - 1]
    name, low = name[head], low[head]
    shape = ((low - first) * 64 + (last - first)).astype(_U)
    context = mix(_B.span(other, first, last + window) + mix(shape))
    return name, context, first, last


def _words(texts: pa.Array):
    raw, offsets = joined(texts)
    begin, end = word_bounds(raw)
    return word_hashes(raw, begin, end), per_text(begin, offsets)


def _parts(doc_begin: np.ndarray, window: int):
    """Stretches of whole documents of ``PART`` words; longer ones overlap by a window."""
    at, n = 0, len(doc_begin) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(doc_begin, doc_begin[at] + PART, "right")) - 1)
        if stop == at + 1 and doc_begin[stop] - doc_begin[at] > PART:
            for begin in range(int(doc_begin[at]), int(doc_begin[stop]), PART):
                end = min(begin + PART + window - 1, int(doc_begin[stop]))
                yield at, begin, end, np.array([0, end - begin])
        else:
            yield (at, int(doc_begin[at]), int(doc_begin[stop]),
                   doc_begin[at:stop + 1] - doc_begin[at])
        at = stop


def _anchors(texts: pa.Array, window: int):
    """Per part of the texts: names of its words, row of each anchor, anchors, row offsets."""
    names, doc_begin = _words(texts)
    for row, begin, end, bounds in _parts(doc_begin, window):
        part = names[begin:end]
        name, context, first, last = anchored(part, bounds, window)
        rows = row + np.searchsorted(bounds, first, "right") - 1
        base = doc_begin[rows] - begin
        yield part, rows, name, context, first - base, last - base, base


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _place_type(docs: DataFrame) -> int:
    """Bits for a word's number if an id tells its document and fits one bigint with the number.

    Else 0: ids that are missing, repeated, negative or large need the text's digest too.
    """
    low, high, most = docs.agg(F.min("key"), F.max("key"), F.max(F.octet_length("text"))).first()
    bits = max(1, ((most or 0) // 2 + 1).bit_length())
    if low is None or low < 0 or high >= 1 << (63 - bits):
        return 0
    return 0 if docs.groupBy("key").count().where("count > 1").head(1) else bits


def _document(bits: int) -> list[str]:
    """The columns that tell documents apart."""
    return ["key"] if bits else ["key", "digest"]


def _place(bits: int):
    """A place in the corpus that sorts by document, then by word."""
    return F.expr(f"shiftleft(key, {bits}) | at" if bits else "struct(key, digest, at)").alias("place")


def _of_place(bits: int):
    if bits:
        return (F.expr(f"shiftright(place, {bits})").alias("key"),
                F.expr(f"cast(place & {(1 << bits) - 1} AS int)").alias("at"))
    return (F.col("place.key").alias("key"), F.col("place.digest").alias("digest"),
            F.expr("cast(place.at AS int)").alias("at"))


def _by_document(places: DataFrame, bits: int, mark: str) -> DataFrame:
    """One row per document with the words noted for it, at most all of its own."""
    return (places.select(*_of_place(bits), F.expr(mark).alias("mark"))
            .groupBy(*_document(bits)).agg(F.collect_list(F.expr("at * 2 + mark")).alias("marks")))


def _first_anchors(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """Per document: 2 * word for anchors that are the first of their context, with 1
    added for those whose name is the only one of its kind in the corpus."""
    own = _document(bits)

    def work(batch):
        out = [[] for _ in range(len(own) + 3)]
        for _, rows, name, context, at, _, _ in _anchors(batch.column(0), window):
            rows = pa.array(rows)
            for column, values in zip(out, (*[c.take(rows) for c in batch.columns[1:]], _signed(name),
                                            _signed(context), pa.array(at, pa.int64()))):
                column.append(values)
        if out[0]:
            return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in out],
                                              [*own, "name", "context", "at"])

    schema = ", ".join(f"{c} bigint" for c in [*own, "name", "context", "at"])
    rows = map_slices(docs.select("text", *own), "text", schema, work, SLICE)
    first = (rows.select("name", "context", _place(bits))
             .groupBy("name", "context").agg(F.min("place").alias("place")))
    only = (first.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
            .where("n = 1").select("place", F.lit(1).alias("mark")))
    return _by_document(first.select("place", F.lit(0).alias("mark")).unionByName(only),
                        bits, mark="mark")


_FOUND = "kind tinyint, key bigint, digest bigint, spans array<int>, h1 bigint, h2 bigint, at bigint"


def _verify(docs: DataFrame, marks: DataFrame, window: int, bits: int) -> DataFrame:
    """Kind 0: per row the windows known as repeats (positive spans) and those to be
    verified (negative ones); kind 1: each window to verify. The digest is that of the text,
    NULL at windows of documents that their id tells apart."""
    def work(batch):
        keys, noted, digests = batch.column(0), batch.column(2), batch.column(3)
        lengths = np.asarray(pc.list_value_length(noted).fill_null(0))
        flat = np.asarray(noted.flatten())
        row_of = np.repeat(np.arange(batch.num_rows), lengths)
        spans: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        windows: list[list] = [[], [], [], [], []]
        for part, rows, _, _, first, last, base in _anchors(batch.column(1), window):
            if not len(rows):
                continue
            wide = 1 << 33
            codes = rows * wide + first
            both = np.sort(row_of[(flat & 1) == 0] * wide + (flat[(flat & 1) == 0] >> 1))
            single = np.sort(row_of[(flat & 1) == 1] * wide + (flat[(flat & 1) == 1] >> 1))
            is_first, is_only = np.isin(codes, both), np.isin(codes, single)
            for sign, chosen in ((1, ~is_first), (-1, is_first & ~is_only)):
                for i in np.flatnonzero(chosen).tolist():
                    spans[rows[i]].append((sign * (first[i] + 1), last[i] + 1))
            open_ = np.flatnonzero(is_first & ~is_only)
            if not len(open_):
                continue
            count = last[open_] - first[open_] + 1
            which = np.repeat(open_, count)
            start = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            place = start + base[which]
            one, two = _A.prefix(mix(part)), _B.prefix(part)
            owner = pa.array(rows[which])
            for column, values in zip(windows, (
                    keys.take(owner),
                    pa.nulls(len(owner), pa.int64()) if bits else digests.take(owner),
                    _signed(mix(_A.span(one, place, place + window))),
                    _signed(mix(_B.span(two, place, place + window))),
                    pa.array(start, pa.int64()))):
                column.append(values)
        has = [i for i, s in enumerate(spans) if s]
        made, names = [], ["kind", "key", "digest", "spans", "h1", "h2", "at"]
        if has:
            made.append(pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(has), np.int8)), keys.take(pa.array(has)),
                 digests.take(pa.array(has)),
                 pa.array([[int(x) for s in spans[i] for x in s] for i in has], pa.list_(pa.int32())),
                 *[pa.nulls(len(has), pa.int64())] * 3], names))
        if windows[0]:
            key, digest, h1, h2, at = (pa.concat_arrays(c) for c in windows)
            made.append(pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(key), np.int8)), key, digest,
                 pa.nulls(len(key), pa.list_(pa.int32())), h1, h2, at], names))
        if made:
            return pa.Table.from_batches(made).combine_chunks().to_batches()[0]

    noted = docs.join(marks, _document(bits), "left").select("key", "text", "marks", "digest")
    return map_slices(noted, "text", _FOUND, work, SLICE)


def kept_words(text: str | None, spans, firsts, window: int) -> tuple[list[bytes], int]:
    """The words that stay and how many there were."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not spans:
        return words, len(words)
    step = np.zeros(len(words) + 1, np.int64)
    spans = np.asarray(spans, np.int64).reshape(-1, 2)
    first, last, known = np.abs(spans[:, 0]) - 1, spans[:, 1] - 1, spans[:, 0] > 0
    np.add.at(step, first[known], 1)
    np.add.at(step, last[known] + window, -1)
    first, count = first[~known], (last - first + 1)[~known]
    starts = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    starts = starts[~np.isin(starts, np.asarray(firsts if firsts is not None else [], np.int64))]
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    stays = np.cumsum(step[:-1]) == 0
    return [w for w, s in zip(words, stays.tolist()) if s], len(words)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, carry: bool = False) -> DataFrame:
    """One row (doc_id, n_words, n_removed, kept) per row of ``docs``.

    With ``carry`` a further column ``row`` holds all columns of the input row.

    Words are stretches without space or 0x09-0x0D. A word is removed if a window of
    ``window`` words over it, within its document, also starts at an earlier place of the
    corpus (smaller id, or the same id and an earlier word). All windows are judged on
    the input. ``kept`` are the words that stay, joined by one space.

    NULL and empty texts have no words; texts shorter than a window stay whole. A document is
    an id with a text: rows that repeat both are one, none of them removes words from another,
    and all get the same result. Different texts under one id are ordered by a hash of the
    text. Rows without an id come before all others, as if they shared the least id. An
    empty table gives no rows; without ``carry`` other columns are not read.
    """
    source = renamed(docs, key=id_col, text=text_col)
    key, digest = F.coalesce(F.col("key").cast("bigint"), F.lit(-1 << 63)), F.xxhash64("text")
    own = source.select(key.alias("key"), "text", digest.alias("digest"))
    bits = _place_type(own)
    marks, path = stored(_first_anchors(own, window, bits), "anchors")
    release(docs.sparkSession)
    found, _ = stored(_verify(own, marks, window, bits), "windows")
    delete_path(docs.sparkSession, path)
    release(docs.sparkSession)
    firsts = _by_document(
        found.where("kind = 1").select("h1", "h2", _place(bits))
        .groupBy("h1", "h2").agg(F.min("place").alias("place")), bits, mark="0")
    spans = (found.where("kind = 0").select("key", "digest", "spans")
             .dropDuplicates(["key", "digest"]))
    if carry:
        source = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text_col}`").alias("text"),
                             F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rest = ["row"] if carry else []
    rows = (source.select(F.col("key").cast("bigint").alias("doc_id"), "text", *rest,
                          key.alias("key"), digest.alias("digest"))
            .join(spans, ["key", "digest"], "left").join(firsts, _document(bits), "left")
            .select("doc_id", "text", "spans", "marks", *rest))

    def work(batch):
        kept, total, removed = [], [], []
        for text, flat, marks in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            firsts = np.asarray(marks, np.int64) >> 1 if marks else None
            words, n = kept_words(text, flat, firsts, window)
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            total.append(n)
            removed.append(n - len(words))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string()), *batch.columns[4:]],
            ["doc_id", "n_words", "n_removed", "kept", *rest])

    schema = (StructType().add("doc_id", "long").add("n_words", "long")
              .add("n_removed", "long").add("kept", "string"))
    if carry:
        schema = schema.add(rows.schema["row"])
    return map_slices(rows, "text", schema, work)
