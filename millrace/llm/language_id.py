"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary n-gram classifier per bit predicts it:
the log-odds of a text's hashed character n-grams under the languages whose bit is set
against the others. Decoding takes the codeword with the least weighted logistic loss;
a bit weighs as much for a language as its classifier was right on rows of that language
that it was not fitted on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, mix, renamed

#: Each of the two n-gram lengths is hashed into 2**BITS bins.
BITS = 16
#: Labelled documents taken per language to fit on, about; the bound of the sample.
DOCS_PER_LANGUAGE = 3000
#: Parts of the sample; a bit is judged on each by a classifier fitted on the others.
FOLDS = 2
#: Languages at most. The model and what it is made of grow with them.
LANGUAGES = 500
#: Languages up to which every split of them is a bit.
EXHAUSTIVE = 6
#: n-grams from which a longer text is no surer than a shorter one.
FULL_GRAMS = 64
#: Scores below it are flagged as ambiguous.
AMBIGUOUS = 0.6
UNKNOWN = "und"
SLICE = 1_000_000

_LETTER = re.compile(r"[^\W\d_]")
#: Multipliers that spread the code points of an n-gram.
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def codewords(languages: int, seed: int = 17) -> np.ndarray:
    """A matrix of +1 and -1, a row per language.

    Few languages get the exhaustive code (any two rows differ in over half the bits),
    more a random one of balanced, distinct columns.
    """
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        columns = np.arange(1, 1 << (languages - 1))
        bits = columns[None, :] >> np.arange(languages)[:, None] & 1
        return (2 * bits[::-1] - 1).astype(np.int8)
    rng, wanted = np.random.default_rng(seed), 15 + 4 * languages.bit_length()
    half = np.array([1] * (languages // 2) + [-1] * (languages - languages // 2), np.int8)
    found: dict[bytes, np.ndarray] = {}
    while len(found) < wanted:
        column = rng.permutation(half)
        column = column * column[0]
        found.setdefault(column.tobytes(), column)
        if len(found) == wanted and len(np.unique(np.stack(list(found.values()), 1), axis=0)) < languages:
            found.popitem()
    return np.stack(list(found.values()), 1)


def grams(texts: list[str | None]):
    """Bins of all n-grams, a row per place in the texts, and where each text begins.

    Texts are lower-cased and set off by two NULs, which n-grams at their ends contain.
    """
    low = [(t or "").lower() for t in texts]
    line = "\0\0" + "".join(t + "\0\0" for t in low)
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    two = mix(b * _SPREAD[1] + c * _SPREAD[2]) >> np.uint64(64 - BITS)
    three = mix(a * _SPREAD[0] + b * _SPREAD[1] + c * _SPREAD[2]) >> np.uint64(64 - BITS)
    begin = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) + 2 for t in low], out=begin[1:])
    return two.astype(np.int64), three.astype(np.int64) + (1 << BITS), begin


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Per text and bit, how clearly the bit is set (positive) or not."""
        two, three, begin = grams(texts)
        total = np.add.reduceat(self.weights[two], begin[:-1], axis=0, dtype=np.float64)
        total += np.add.reduceat(self.weights[three], begin[:-1], axis=0, dtype=np.float64)
        count = np.diff(begin)[:, None]
        return total / count * np.minimum(count, FULL_GRAMS)

    def predict(self, texts: list[str | None]):
        """Language and score of each text."""
        score = np.zeros(len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), score
        known = np.array([bool(t) and _LETTER.search(t) is not None for t in texts])
        best, at = np.zeros(len(texts), np.int64), np.flatnonzero(known)
        if len(at):
            margin = self.margins([texts[i] for i in at])
            loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.trust[None]
            loss = loss.sum(axis=2)
            likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
            best[at] = loss.argmin(axis=1)
            score[at] = 1 / likely.sum(axis=1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Fit on rows with a language. Rows enter the sample, and a fold of it, by hashes of their id.

    Only what the model consists of reaches the driver: the number of rows per language,
    the counts per fold, language and bin, and how often each bit was right per language.
    More than ``LANGUAGES`` languages are an error.
    """
    source = renamed(labelled, key=id_col, text=text_col, lang=lang_col).where("lang IS NOT NULL")
    counted = source.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    counts = {r.lang: r.n for r in counted}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return Model([], codewords(0), np.zeros((2 << BITS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items()
                           for x in (lang, min(1.0, docs_per_language / n))])
    drawn = F.pmod(F.xxhash64(F.col("key"), F.lit("language")), F.lit(1 << 20)) / (1 << 20)
    fold = F.pmod(F.xxhash64(F.col("key"), F.lit("fold")), F.lit(FOLDS))
    sample = source.where(drawn < share[F.col("lang")]).select("text", "lang", fold.alias("fold"))
    number = {lang: i for i, lang in enumerate(languages)}
    size = 2 << BITS

    def count(batch):
        two, three, begin = grams(batch.column(0).to_pylist())
        own = np.array([number[x] for x in batch.column(1).to_pylist()])
        own = np.repeat((np.asarray(batch.column(2)) * len(number) + own) * size, np.diff(begin))
        found, n = np.unique(np.concatenate([own + two, own + three]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["cell", "n"])

    cells = (map_slices(sample, "text", "cell bigint, n bigint", count, SLICE)
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros(FOLDS * len(languages) * size)
    table[np.asarray(cells.column("cell"))] = np.asarray(cells.column("n"))
    table = table.reshape(FOLDS, len(languages), size)

    code = codewords(len(languages))
    model = Model(languages, code, _bit_weights(table.sum(axis=0), code))
    if not code.shape[1]:
        model.trust = np.ones(code.shape)
        return model
    shared = sample.sparkSession.sparkContext.broadcast(
        [Model(languages, code, _bit_weights(table.sum(axis=0) - own, code)) for own in table])

    def judge(batch):
        texts, own = batch.column(0).to_pylist(), np.array([number[x] for x in batch.column(1).to_pylist()])
        folds, right = np.asarray(batch.column(2)), np.zeros((len(own), code.shape[1]), bool)
        for fold in np.unique(folds).tolist():
            at = np.flatnonzero(folds == fold)
            right[at] = shared.value[fold].margins([texts[i] for i in at]) * code[own[at]] > 0
        rows = [(lang, bit, int(right[own == lang, bit].sum()), int((own == lang).sum()))
                for lang in np.unique(own).tolist() for bit in range(right.shape[1])]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in zip(*rows)], ["lang", "bit", "hits", "n"])

    judged = map_slices(sample, "text", "lang bigint, bit bigint, hits bigint, n bigint", judge, SLICE)
    trust = np.full(code.shape, 0.5)
    for r in judged.groupBy("lang", "bit").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect():
        trust[r.lang, r.bit] = (r.hits + 1) / (r.n + 2)
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def _bit_weights(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log-odds of every bin, a column per bit, from the counts per language and bin."""
    languages, size = table.shape
    table = (table + 0.5).reshape(languages, 2, size // 2)
    table = (table / table.sum(axis=2, keepdims=True)).reshape(languages, size)
    weights = np.empty((size, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        on = code[:, bit] > 0
        weights[:, bit] = np.log(table[on].mean(axis=0)) - np.log(table[~on].mean(axis=0))
    return weights


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row (doc_id, lang_pred, score, ambiguous) per row of ``docs``, over whole texts.

    ``score`` (0 to 1) is the winning codeword's share in the likelihoods of all;
    below ``AMBIGUOUS`` the text is flagged. NULL texts and texts without a letter are
    ``und`` with score 0 and flagged; so is all if the model knows no language.
    Ties go to the language that sorts first. Rows that repeat an id keep one row each;
    ids are only carried, NULL or not. An empty table gives no rows; other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        language, score = shared.value.predict(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(language, pa.string()), pa.array(score),
             pa.array(score < AMBIGUOUS)], ["doc_id", "lang_pred", "score", "ambiguous"])

    source = renamed(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, "text",
                      f"doc_id {kind}, lang_pred string, score double, ambiguous boolean", work, SLICE)


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised without ambiguity.

    NULL and empty texts and those without a letter are not recognised. Rows are judged one by
    one, so rows that repeat are judged alike; ids are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def work(batch):
        language, score = shared.value.predict(batch.column(place).to_pylist())
        return batch.filter(pa.array((score >= AMBIGUOUS) & (np.array(language) != UNKNOWN)))

    return map_slices(docs, text_col, docs.schema, work, SLICE)
