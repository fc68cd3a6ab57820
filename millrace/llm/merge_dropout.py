"""SentencePiece (BPE) encoding with seeded merge-dropout, and lossless decoding.

Merges are taken from an agenda, best score first and leftmost among equals. With
``dropout`` a candidate is skipped when it is taken if a keyed hash of the seed, the
document, the word's place in it, the place in the word and the merged piece says so. Every
occurrence of a word is thus drawn by itself; all its segmentations decode to the same
text, and any task that repeats the work makes the same ones. Merges never cross a
space that follows another character, so texts are cut there. What is kept of a word is its
segmentation without dropout and the merges that led to it: it stands wherever
the hash skips none of them, the other occurrences are segmented anew.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, mix, renamed

DROPOUT = 0.1
SEED = 2024
#: Words a task keeps the undropped merges of; beyond it, it starts to keep anew.
KEPT = 300_000
#: Words of a text looked at together.
TOGETHER = 1 << 17
#: Bytes of text handled at a time.
SLICE = 1_000_000

_WORD = re.compile(r" +[^ \n]*|\n|[^ \n]+")
#: Words up to this length are segmented together, step by step.
SHORT = 32
_NEVER = np.int32(1 << 30)
_NORMAL, _BYTE = 1, 6
_M1, _M2, _MASK = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1


def _skipped(h: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Which candidates are dropped, from the key of the occurrence and :func:`_candidate`."""
    h = (h ^ h >> np.uint64(31)) * np.uint64(_M1)
    h = (h ^ h >> np.uint64(29)) * np.uint64(_M2)
    return h >> np.uint64(32) < limit


def _candidate(place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return place.astype(np.uint64) * np.uint64(_M1) ^ rank.astype(np.uint64) * np.uint64(_M2)


def _slot(key: np.ndarray, mask: np.int64) -> np.ndarray:
    h = key.astype(np.uint64) * np.uint64(_M1)
    return (h >> np.uint64(40)).astype(np.int64) & mask


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and how many each has."""
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32), np.fromiter(map(len, words), np.int64, len(words))


def _stretches(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, … of each stretch, in a row."""
    total = int(counts.sum())
    return np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(total)


class Ragged:
    """Lists of numbers in a row that grows at its end."""

    def __init__(self, kind):
        self.kind, self.n, self.used = kind, 0, 0
        self.flat, self.begin, self.counts = (np.zeros(1024, kind), np.zeros(64, np.int64), np.zeros(64, np.int64))

    def append(self, flat: np.ndarray, counts: np.ndarray) -> None:
        for name, used, more in (("flat", self.used, len(flat)), ("begin", self.n, len(counts)),
                                 ("counts", self.n, len(counts))):
            own = getattr(self, name)
            if used + more > len(own):
                wider = np.zeros(max(used + more, 2 * len(own)), own.dtype)
                wider[:used] = own[:used]
                setattr(self, name, wider)
        self.flat[self.used:self.used + len(flat)] = flat
        self.counts[self.n:self.n + len(counts)] = counts
        self.begin[self.n:self.n + len(counts)] = self.used + np.cumsum(counts) - counts
        self.used, self.n = self.used + len(flat), self.n + len(counts)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[at]
        return self.flat[_stretches(self.begin[at], counts)], counts


class _Gathered:
    """Lists for ``n`` places, found in any order."""

    def __init__(self, n: int, kind):
        self.kind, self.counts, self.parts = kind, np.zeros(n, np.int64), []

    def add(self, at, flat, counts) -> None:
        self.counts[at] = counts
        self.parts.append((at, flat, counts))

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        begin = np.cumsum(self.counts) - self.counts
        out = np.zeros(int(self.counts.sum()), self.kind)
        for at, flat, counts in self.parts:
            out[_stretches(begin[at], counts)] = flat
        return out, self.counts


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        self.rank: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        self.id: dict[str, int] = {}
        order = sorted((i for i, p in enumerate(spec.pieces) if p.type == _NORMAL),
                       key=lambda i: -spec.pieces[i].score)
        self.id_of_rank = order
        for rank, i in enumerate(order):
            piece = spec.pieces[i].piece
            self.rank[piece], self.id[piece] = rank, i
        for i, p in enumerate(spec.pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            else:
                self.bytes_of.append(p.piece.replace("▁", " ").encode() if p.type == _NORMAL else b"")

        self._tables()

    def _tables(self):
        """Arrays for :meth:`segment_all`: ranks by code point and by pair of ranks."""
        single = np.full(0x110000, -1, np.int64)
        for piece, rank in self.rank.items():
            if len(piece) == 1:
                single[ord(piece)] = rank
        # The space symbol stands for a space; written out, it is spelt in bytes.
        single[0x20], single[0x2581] = single[0x2581], -1
        pairs = {}
        for piece, rank in self.rank.items():
            for cut in range(1, len(piece)):
                a, b = self.rank.get(piece[:cut]), self.rank.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * len(self.rank) + b] = rank
        self._single = single
        self._ids = np.array(self.id_of_rank, np.int32)
        self._table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32))
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self._spelt = Ragged(np.uint8)
        self._spelt.append(np.frombuffer(b"".join(self.bytes_of), np.uint8), lengths)

    def _table(self, keys, merged):
        """Open addressing: a pair stands in the first slot from its own that was free."""
        size = 1 << max(4, int(len(keys) * 8).bit_length())
        self._mask, self._slots = np.int64(size - 1), np.full(size, -1, np.int64)
        self._merged = np.full(size, _NEVER, np.int32)
        at = _slot(keys, self._mask)
        while len(keys):
            free = self._slots[at] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self._slots[at[put]], self._merged[at[put]] = keys[put], merged[put]
            keys, merged, at = keys[~put], merged[~put], (at[~put] + 1) & self._mask

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that two neighbouring ranks merge to; negative ones never do."""
        key = a * len(self.rank) + b
        key[(a < 0) | (b < 0)] = -2
        at = _slot(key, self._mask)
        found = self._slots[at]
        out = np.where(found == key, self._merged[at], _NEVER)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            found = self._slots[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self._merged[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def segment_flat(self, points: np.ndarray, sizes: np.ndarray, keys: np.ndarray, dropout: float,
                     steps: bool = False):
        """:meth:`segment` of many words at once, given as code points in a row.

        Returns all ids in a row and how many each word has, and likewise with ``steps`` the
        merges of each word as their candidates.
        """
        begin = np.cumsum(sizes) - sizes
        ids, merges, rest = _Gathered(len(sizes), np.int32), _Gathered(len(sizes), np.uint64), []
        for low, high in ((0, 8), (8, 16), (16, SHORT), (SHORT, None)):
            at = np.flatnonzero((sizes > low) & (sizes <= high) if high else sizes > low)
            if not len(at) or high is None:
                rest.append(at)
                continue
            place = np.arange(high)
            inside = place < sizes[at, None]
            symbols = np.full(inside.shape, -1, np.int64)
            symbols[inside] = self._single[points[(begin[at, None] + place)[inside]]]
            known = (symbols >= 0).sum(axis=1) == sizes[at]
            rest.append(at[~known])
            at, symbols = at[known], symbols[known]
            taken = [] if steps else None
            ids.add(at, *self._segment_rows(symbols, sizes[at], keys[at], dropout, taken))
            if taken:
                rows = np.concatenate([r for r, _ in taken])
                order = np.argsort(rows, kind="stable")
                merges.add(at, np.concatenate([c for _, c in taken])[order],
                           np.bincount(rows, minlength=len(at)))
        for i in np.concatenate(rest).tolist():
            word = points[begin[i]:begin[i] + sizes[i]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            taken = []
            own = np.array(self.segment(word, int(keys[i]), dropout, taken), np.int32)
            ids.add(np.array([i]), own, np.array([len(own)]))
            if steps and taken:
                merges.add(np.array([i]), _candidate(*np.array(taken, np.int64).T), np.array([len(taken)]))
        return (*ids.all(), *(merges.all() if steps else ()))

    def segment_all(self, words: list[str], keys: np.ndarray, dropout: float) -> list[bytes]:
        """:meth:`segment` of many words, each as bytes of 32-bit ids."""
        flat, counts = self.segment_flat(*_code_points(words), keys, dropout)
        raw, ends = flat.tobytes(), (np.cumsum(counts) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def spelt(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many ids in a row, and how many each has."""
        return self._spelt.take(ids)

    def _segment_rows(self, symbols, sizes, keys, dropout, steps=None):
        rows, width = symbols.shape
        place = np.arange(width)
        symbol = symbols.ravel().copy()
        after = np.tile(place + 1, rows)
        before = np.tile(place - 1, rows)
        alive = place[None, :] < sizes[:, None]
        rank = np.full((rows, width), _NEVER)
        pair = place[None, :] < sizes[:, None] - 1
        r, c = np.nonzero(pair)
        rank[r, c] = self._lookup(symbols[r, c], symbols[r, c + 1])
        flat_rank, flat_alive = rank.ravel(), alive.ravel()
        active, limit = np.arange(rows), np.uint64(int(dropout * (1 << 32)))
        while True:
            view = rank if len(active) == rows else rank[active]
            i = view.argmin(axis=1)
            best = view[np.arange(len(active)), i]
            going = best < _NEVER
            active, i, best = active[going], i[going], best[going]
            if not len(active):
                break
            at = active * width + i
            if limit:
                skipped = _skipped(keys[active] ^ _candidate(i, best), limit)
                flat_rank[at[skipped]] = _NEVER
                rows_now, at, i, best = active[~skipped], at[~skipped], i[~skipped], best[~skipped]
            else:
                rows_now = active
            if not len(at):
                continue
            if steps is not None:
                steps.append((rows_now, _candidate(i, best)))
            base, size = rows_now * width, sizes[rows_now]
            gone = base + after[at]
            symbol[at] = best
            flat_alive[gone] = False
            flat_rank[gone] = _NEVER
            k = after[gone]
            after[at] = k
            inside = k < size
            before[(base + k)[inside]] = i[inside]
            flat_rank[at] = _NEVER
            flat_rank[at[inside]] = self._lookup(symbol[at[inside]], symbol[(base + k)[inside]])
            h = before[at]
            left = h >= 0
            flat_rank[(base + h)[left]] = self._lookup(symbol[(base + h)[left]], symbol[at[left]])
        return self._ids[symbol[flat_alive]], alive.sum(axis=1)

    def segment(self, word: str, key: int, dropout: float, steps: list | None = None) -> list[int]:
        """Ids of one word, in which spaces stand for the space symbol.

        ``steps`` receives place and rank of each merge.
        """
        # A literal space symbol would decode to a space: it is spelt in bytes.
        parts: list[str | None] = ["▁" if c == " " else "\0" if c == "▁" else c for c in word]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        agenda = []
        for i in range(n - 1):
            r = rank.get(parts[i] + parts[i + 1])
            if r is not None:
                agenda.append((r, i, len(parts[i]) + len(parts[i + 1])))
        heapq.heapify(agenda)
        limit = int(dropout * (1 << 32))
        while agenda:
            r, i, size = heapq.heappop(agenda)
            j = after[i] if parts[i] is not None else n
            if j >= n or len(parts[i]) + len(parts[j]) != size or rank.get(parts[i] + parts[j]) != r:
                continue
            if limit:
                h = (key ^ (i * _M1) ^ (r * _M2)) & _MASK
                h = (h ^ h >> 31) * _M1 & _MASK
                h = (h ^ h >> 29) * _M2 & _MASK
                if h >> 32 < limit:
                    continue
            if steps is not None:
                steps.append((i, r))
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(parts[i] + parts[k])
                if r is not None:
                    heapq.heappush(agenda, (r, i, len(parts[i]) + len(parts[k])))
            h = before[i]
            if h >= 0:
                r = rank.get(parts[h] + parts[i])
                if r is not None:
                    heapq.heappush(agenda, (r, h, len(parts[h]) + len(parts[i])))
        ids, at = [], 0
        while at < n:
            piece = parts[at]
            if piece in self.id:
                ids.append(self.id[piece])
            else:
                spelt = "▁" if piece == "\0" and word[at] == "▁" else piece
                ids += [self.byte_id[b] for b in spelt.encode("utf-8", "surrogatepass")]
            at = after[at]
        return ids


class Encoder:
    """Encodes texts, keeping the undropped merges of words it has met.

    A kept word has a number; number 0 stands for all that are not kept.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.vocabulary, self.dropout, self.seed = vocabulary, dropout, seed
        self._forget()

    def _forget(self):
        self.number: dict[str, int] = {}
        self.points, self.ids, self.merges, self.raw = (
            Ragged(np.uint32), Ragged(np.int32), Ragged(np.uint64), Ragged(np.uint8))
        self.good = np.zeros(0, bool)
        for store in (self.points, self.ids, self.merges, self.raw):
            store.append(np.zeros(0, store.kind), np.zeros(1, np.int64))
        self.good = np.zeros(1, bool)

    def encode(self, texts: list[str | None], keys: list[int]) -> list[np.ndarray]:
        """Ids of each text; ``keys`` vary the segmentations between texts."""
        flat, counts, _ = self.encode_flat(texts, keys)
        return np.split(flat, np.cumsum(counts)[:-1]) if texts else []

    def encode_flat(self, texts: list[str | None], keys: list[int]):
        """All ids in a row, how many each text has, and whether they decode to it."""
        words, own_keys, counts, whole = [], [], [], []
        for text, key in zip(texts, keys):
            own = _WORD.findall(" " + text) if text else []
            words += own
            counts.append(len(own))
            whole.append(not text or sum(map(len, own)) == len(text) + 1)
            own_keys.append(self._keys(key, len(own)))
        every = np.concatenate(own_keys) if own_keys else np.zeros(0, np.uint64)
        parts = [self._spell(words[at:at + TOGETHER], every[at:at + TOGETHER])
                 for at in range(0, len(words), TOGETHER)]
        flat, sizes, good = ((np.concatenate(x) for x in zip(*parts)) if parts else
                             (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)))
        ends = np.cumsum(counts, dtype=np.int64)
        total, bad = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(~good))
        begin = ends - counts
        return (flat, total[ends] - total[begin],
                np.array(whole, bool) & (bad[ends] == bad[begin]))

    def _keys(self, key: int, n: int) -> np.ndarray:
        """A key for each of the ``n`` words of the text with ``key``."""
        places = np.arange(n).astype(np.uint64) * np.uint64(_M1)
        return mix(places + np.uint64((key * _M2 + self.seed) & _MASK))

    def _learn(self, new: list[str]) -> None:
        points, sizes = _code_points(new)
        ids, counts, merges, steps = self.vocabulary.segment_flat(
            points, sizes, np.zeros(len(new), np.uint64), 0.0, True)
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        self.number.update(zip(new, range(len(self.good), len(self.good) + len(new))))
        for store, *values in ((self.points, points, sizes), (self.ids, ids, counts),
                               (self.merges, merges, steps), (self.raw, flat, lengths)):
            store.append(*values)
        self.good = np.append(self.good, self._decodes(ids, counts, flat, lengths))

    def _decodes(self, ids, counts, raw, lengths) -> np.ndarray:
        """Whether the ids of each word are spelt as its bytes."""
        spelt, sizes = self.vocabulary.spelt(ids)
        total = np.append(0, np.cumsum(sizes))
        ends = np.cumsum(counts)
        same = total[ends] - total[ends - counts] == lengths
        if same.all():
            differs = np.append(0, np.cumsum(spelt != raw))
            ends = np.cumsum(lengths)
            return differs[ends] == differs[ends - lengths]
        # Never for this kind of model; word by word, so that one fault is one fault.
        at, by = np.cumsum(lengths) - lengths, total[np.cumsum(counts) - counts]
        return np.array([s and bytes(spelt[b:b + n]) == bytes(raw[a:a + n])
                         for s, a, b, n in zip(same, at, by, lengths)], bool)

    def _spell(self, words: list[str], keys: np.ndarray):
        """Ids of the words in a row, how many each has, and whether they decode to it."""
        if len(self.number) > KEPT:
            self._forget()
        new = [w for w in set(words).difference(self.number) if len(w) <= SHORT]
        if new:
            self._learn(new)
        get = self.number.get
        number = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
        again = number == 0
        if self.dropout:
            candidates, counts = self.merges.take(number)
            at = np.repeat(np.arange(len(words)), counts)
            limit = np.uint64(int(self.dropout * (1 << 32)))
            again[at[_skipped(keys[at] ^ candidates, limit)]] = True
        good = self.good[number]
        usual = np.flatnonzero(~again)
        found = _Gathered(len(words), np.int32)
        found.add(usual, *self.ids.take(number[usual]))
        for at, points, raw in self._others(words, number, np.flatnonzero(again)):
            ids, counts = self.vocabulary.segment_flat(*points, keys[at], self.dropout)
            found.add(at, ids, counts)
            good[at] = self._decodes(ids, counts, *raw)
        return (*found.all(), good)

    def _others(self, words, number, again):
        """Words to segment anew: (places, code points, bytes) of kept ones and of the rest."""
        at = again[number[again] > 0]
        if len(at):
            yield at, self.points.take(number[at]), self.raw.take(number[at])
        at = again[number[again] == 0]
        if len(at):
            own = [words[i] for i in at.tolist()]
            raw = [w.encode("utf-8", "surrogatepass") for w in own]
            yield at, _code_points(own), (np.frombuffer(b"".join(raw), np.uint8),
                                          np.fromiter(map(len, raw), np.int64, len(raw)))


def decode(vocabulary: Vocabulary, ids) -> str:
    """The text that was encoded, whatever merges were dropped."""
    table = vocabulary.bytes_of
    return b"".join([table[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def load(path: str) -> Vocabulary:
    with open(path, "rb") as file:
        return Vocabulary(file.read())


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """One row (doc_id, token_ids, n_tokens, lossless) per row of ``docs``.

    ``model_path`` is read by the driver and sent along; the model has byte fallback.
    The dropout is keyed by seed, id and place in the text, so rows that repeat an id and text are
    equal, and without dropout ids are the library's. ``lossless`` tells that
    decoding ``token_ids`` gives the text again: every word of it was decoded and compared.

    A NULL text has NULL ids and no tokens, an empty one an empty list; both count as
    lossless. A NULL id keys like 0. A literal space symbol (U+2581) is spelt in bytes,
    as it would decode to a space. An empty table gives no rows; other columns are not read.
    """
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    encoders = {}

    def work(batch):
        if not encoders:
            encoders[0] = Encoder(Vocabulary(shared.value), dropout, seed)
        encoder = encoders[0]
        texts, keys = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        ids, counts, good = encoder.encode_flat(texts, keys)
        offsets = np.zeros(len(texts) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        missing = pa.array([t is None for t in texts])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids), mask=missing)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), lists, pa.array(np.diff(offsets)), pa.array(good)],
            ["doc_id", "token_ids", "n_tokens", "lossless"])

    source = renamed(docs, doc_id=id_col, text=text_col).withColumn(
        "hash", F.coalesce(F.xxhash64("doc_id"), F.lit(0)))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, "text",
                      f"doc_id {kind}, token_ids array<int>, n_tokens int, lossless boolean", work, SLICE)
