"""Token ids as Arrow files of equal-length sequences with masks, read without copying.

The ids of all documents, in ascending id order, form one stream. Every task writes a
stretch of it as an Arrow IPC file whose rows are ``ids`` and ``mask``, both
fixed-size lists: row i holds the tokens from i * length on, and the mask is
false only on the padding of a file's last row. Beside it an index file tells where
each document begins. Mapped into memory, a sequence or a document is a view of the file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, renamed, slices
from millrace.session import scratch_path, settle

LENGTH = 1024
#: Sequences per record batch of a file.
BATCH = 512
#: Text that goes into one file, about.
FILE_BYTES = 32 << 20
END = 1
#: Characters of a text that place it among rows of one id.
HEAD = 64
#: Parts of words a task keeps the ids of.
KEPT = 1_000_000
#: Text encoded at a time.
SLICE = 4_000_000
#: Words in one call of the tokenizer, and in one line of it.
CALL, LINE = 64_000, 2_000
#: Tasks that read files, at most, and files whose sizes are added up in one task.
READERS, BLOCK = 20_000, 4096

#: A word of letters that are lower-cased one by one and never composed, with at most one
#: mark after it. The tokenizer takes the letters and the mark apart anyway.
_SIMPLE = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[.,;:!?]?)$"


def _gathered(flat: np.ndarray, begin: np.ndarray, order: np.ndarray):
    """Stretches of ``flat`` in the given order, one after the other, and where each begins."""
    first = begin[order]
    count = begin[order + 1] - first
    at = np.zeros(len(order) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    return flat[np.repeat(first - at[:-1], count) + np.arange(at[-1])], at


class WordTokens:
    """Ids of texts from a tokenizer that drops white space and never joins across it.

    Texts are cut at white space of ASCII, in Arrow. The tokenizer meets every new word once, and
    words that differ in case or in a mark at the end only once together. With ``spell_special``
    the name of a special token in a text is spelt like other text, else it is that token;
    names hold no white space, so words are enough either way.
    """

    def __init__(self, spec: str, spell_special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = spell_special
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: Ids that end a word; None if the vocabulary does not tell.
        self.ends = np.zeros(size, bool) if suffix else None
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {"": 0}
        self.flat, self.begin = np.zeros(0, self.kind), np.zeros(2, np.int64)

    def _each(self, words: list[str]):
        """Ids of words met one by one, and how many each has."""
        made = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(made), self.kind), np.fromiter(map(len, made), np.int64)

    def _together(self, words: list[str]):
        """As ``_each``, for words of letters: whole lines of them, cut where words end.

        Every word has at least one id that ends it. So if a call gives as many of these as there
        are words, each has one; else they are met one by one.
        """
        if self.ends is not None:
            lines = [" ".join(words[at:at + LINE]) for at in range(0, len(words), LINE)]
            flat, _ = self._each(lines)
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(words):
                return flat, np.diff(last, prepend=-1)
        return self._each(words)

    def _known(self, parts: list[str]) -> np.ndarray:
        """The numbers of distinct parts; new ones get theirs, and their ids."""
        known = self.numbers
        number = np.fromiter(map(known.get, parts, repeat(-1)), np.int64, len(parts))
        places = np.flatnonzero(number < 0)
        letters = np.array([parts[i].isalpha() for i in places.tolist()], bool)
        flat, counts = [self.flat], []
        for some, meet in ((places[letters], self._together), (places[~letters], self._each)):
            for at in range(0, len(some), CALL):
                call = some[at:at + CALL]
                words = [parts[i] for i in call.tolist()]
                ids, count = meet(words)
                flat.append(ids)
                counts.append(count)
                number[call] = np.arange(len(known), len(known) + len(call))
                known.update(zip(words, number[call].tolist()))
        if counts:
            more = self.begin[-1] + np.cumsum(np.concatenate(counts))
            self.flat, self.begin = np.concatenate(flat), np.concatenate([self.begin, more])
        return number

    def encode(self, texts: pa.Array, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` after each, and where each text begins."""
        if len(self.numbers) > KEPT:
            self._forget()
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        words = lists.flatten().dictionary_encode()
        own = words.dictionary
        simple = pc.extract_regex(own, pattern=_SIMPLE)
        found = simple.is_valid()
        letters = pc.if_else(found, pc.utf8_lower(pc.struct_field(simple, "letters")), own)
        marks = pc.if_else(found, pc.struct_field(simple, "mark"), "")
        parts = pa.concat_arrays([letters, marks]).dictionary_encode()
        number = self._known(parts.dictionary.to_pylist())
        pairs = number[np.asarray(parts.indices)].reshape(2, len(own)).T.reshape(-1)
        # Ids per distinct word, those of its two parts, and as one word more the end.
        flat, at = _gathered(self.flat, self.begin, pairs)
        flat, at = np.append(flat, self.kind(end)), np.append(at[::2], at[-1] + 1)
        after = np.cumsum(np.asarray(pc.list_value_length(lists)))
        order = np.insert(np.asarray(words.indices).astype(np.int64), after, len(own))
        ids, at = _gathered(flat, at, order)
        return ids, np.append(0, at[after + np.arange(1, len(after) + 1)])


def _schema(kind, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)),
                      ("mask", pa.list_(pa.bool_(), length))], {"length": str(length)})


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class Writer:
    """Writes one file and its index; both appear under their names only when complete."""

    def __init__(self, folder: str, name: str, kind, length: int = LENGTH):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.final = f"{base}/{name}"
        self.open_name = f"{base}/.{name}-{uuid.uuid4().hex}"
        self.length, self.kind, self.total = length, kind, 0
        self.schema = _schema(kind, length)
        self.sink = self.fs.open_output_stream(f"{self.open_name}.arrow")
        self.file = ipc.new_file(self.sink, self.schema)
        self.rest: list[np.ndarray] = []
        self.held = 0
        self.index: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id, self.total, len(ids)))
        self.rest.append(ids)
        self.total += len(ids)
        self.held += len(ids)
        if self.held >= BATCH * self.length:
            self._flush(self.held // self.length * self.length)

    def _flush(self, tokens: int) -> None:
        line = np.concatenate(self.rest) if self.rest else np.zeros(0, self.kind)
        self.rest, self.held = [line[tokens:].copy()], max(0, len(line) - tokens)
        rows = -(-tokens // self.length)
        ids = np.zeros(rows * self.length, self.kind)
        ids[:min(tokens, len(line))] = line[:tokens]
        mask = np.arange(len(ids)) < len(line[:tokens])
        batch = pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema)
        for at in range(0, rows, BATCH):
            # A full batch each, so that a sequence's batch is known from its number.
            self.file.write_batch(batch.slice(at, BATCH))

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        self.file.close()
        self.sink.close()
        with self.fs.open_output_stream(f"{self.open_name}.index") as sink:
            with ipc.new_file(sink, _INDEX) as index:
                columns = list(zip(*self.index)) or [[], [], []]
                index.write_batch(pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in columns], schema=_INDEX))
        for kind in ("arrow", "index"):
            self.fs.move(f"{self.open_name}.{kind}", f"{self.final}.{kind}")


class TokenFile:
    """Random access to a file. On a local file system nothing is copied."""

    def __init__(self, uri: str):
        self.fs, path = pafs.FileSystem.from_uri(uri)
        local = isinstance(self.fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(f"{path}.arrow") if local else self.fs.open_input_file(f"{path}.arrow")
        self.file = ipc.open_file(self.source)
        self.length = int(self.file.schema.metadata[b"length"])
        with self.fs.open_input_file(f"{path}.index") as index:
            self.index = ipc.open_file(index).read_all()
        self._starts = np.cumsum([0, *(self.file.get_batch(i).num_rows
                                       for i in range(self.file.num_record_batches))])

    def __len__(self) -> int:
        return int(self._starts[-1])

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one row."""
        at = int(np.searchsorted(self._starts, number, "right")) - 1
        batch, row = self.file.get_batch(at), number - int(self._starts[at])
        ids = batch.column(0).values.slice(row * self.length, self.length)
        return ids.to_numpy(), batch.column(1).values.slice(row * self.length, self.length)

    def tokens(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` of this file's stream."""
        parts, at = [], start
        while at < start + count:
            number = int(np.searchsorted(self._starts * self.length, at, "right")) - 1
            low, high = (int(x) * self.length for x in self._starts[number:number + 2])
            stop = min(start + count, high)
            parts.append(self.file.get_batch(number).column(0).values
                         .slice(at - low, stop - at).to_numpy())
            at = stop
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          end: int = END, spell_special: bool = True) -> DataFrame:
    """Encode and write; returns the files written (part, path, n_docs, n_tokens), by part.

    A task that is run again writes the same file under the same name. A NULL or empty
    text is its end id alone. Rows without an id come first; rows that repeat an id, or have
    none, follow each other by the first ``HEAD`` characters of their text, then by a hash of it,
    and fill as many files as they need; equal rows share one. No rows, no files. Without
    ``spell_special`` ids are those of the library's own settings, in which a text may hold
    special tokens by name.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    source = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0]
    order = ["doc_id", F.substring("text", 1, HEAD), F.xxhash64("text")]
    ordered = (source.repartitionByRange(max(1, (size or 0) // FILE_BYTES), *order)
               .sortWithinPartitions(*order)
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def run(batches):
        words, writer, part, n = None, None, 0, 0
        for batch in slices(batches, "text", SLICE):
            if writer is None:
                words, part = WordTokens(shared.value, spell_special), batch.column(0)[0].as_py()
                writer = Writer(folder, f"part-{part:06d}", words.kind, length)
            ids, at = words.encode(batch.column(2), end)
            for key, begin, stop in zip(batch.column(1).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                writer.add(key, ids[begin:stop])
            n += batch.num_rows
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [f"{folder}/part-{part:06d}"],
                 "n_docs": pa.array([n], pa.int64()), "n_tokens": pa.array([writer.total], pa.int64())})

    return settle(map_arrow(ordered, run, "part int, path string, n_docs bigint, n_tokens bigint"))


def read(files: DataFrame, per_file=None, schema: str = "doc_id bigint, start bigint, ids array<int>"):
    """Every document in the files that ``write`` returned: its id, place and ids.

    Where a file begins is the sum of those before it: within its block of files, and of the
    blocks before. ``per_file`` may make other rows.
    """
    def before(*part):
        return Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, -1)

    def run(batches):
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                yield from (per_file or _documents)(TokenFile(path), start)

    sized = files.select("path", "part", "n_tokens", F.expr(f"part DIV {BLOCK}").alias("block"))
    # One row per block: few, however many files there are.
    blocks = (sized.groupBy("block").agg(F.sum("n_tokens").alias("sum"))
              .select("block", F.coalesce(F.sum("sum").over(before().orderBy("block")), F.lit(0)).alias("base")))
    own = F.coalesce(F.sum("n_tokens").over(before("block").orderBy("part")), F.lit(0))
    placed = (sized.withColumn("own", own).join(blocks, "block")
              .select("path", (F.col("base") + F.col("own")).alias("base")))
    return map_arrow(placed.repartition(max(1, min(READERS, files.count()))), run, schema)


def _documents(file: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
    for batch in file.index.to_batches(max_chunksize=1024):
        ids = [file.tokens(s, n) for s, n in zip(*(batch.column(i).to_pylist() for i in (1, 2)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.add(batch.column(1), base), pa.array(ids, pa.list_(pa.int32()))],
            ["doc_id", "start", "ids"])


def _digests(file: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
    for batch in file.index.to_batches(max_chunksize=8192):
        crc = [zlib.crc32(file.tokens(s, n).astype("<u4").tobytes())
               for s, n in zip(*(batch.column(i).to_pylist() for i in (1, 2)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.asarray(batch.column(1)) + base), batch.column(2),
             pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(files: DataFrame) -> DataFrame:
    """Per document read back from the files: doc_id, start, n_tokens and ids_crc32, the
    CRC-32 of its ids as little-endian unsigned 32-bit integers."""
    return read(files, _digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
