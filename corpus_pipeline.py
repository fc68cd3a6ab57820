"""From raw documents to token ids: each stage is one of the operators on all that is left.

A stage takes (spark, docs, folder), ``docs`` with the columns of ``documents``, and returns
the rows it keeps; the last one returns token ids. ``run`` writes each result to the
shared folder and reads it again, so a stage starts from files, never from a long lineage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language_id, merge_dropout, simhash, substring_dedup
from millrace.llm.common import table
from millrace.session import scratch_path

#: Not every stage can be said in SQL (a learned language, XXH64); tested by brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop texts without letters and those whose language is ambiguous.

    NULL and empty texts have no letter and go. Rows are judged one by one, so those that
    repeat an id or a text, or have no id, are judged alike and stay or go together. Rows
    without a language teach nothing; without any labelled row every text is ambiguous. An
    empty table gives no rows. Columns stay as they are.
    """
    labelled = docs.where("crc32(cast(doc_id AS string)) % 3 <> 1")
    return language_id.recognised(docs, language_id.fit(labelled))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the smallest id stays.

    Rows are told apart by their place, so ``docs`` must be a scan of files that do not change
    meanwhile, as in ``run``. Rows that repeat an id are judged each by its own text; of
    those in one group the first in place stays. A row without an id stays only if no row
    of its group has one, and then only the first. NULL, empty and other texts without words
    are one group. An empty table gives no rows. Columns stay as they are.
    """
    place = F.monotonically_increasing_id()
    groups = simhash.near_duplicates(docs.select(place.alias("place"), "text"), "place")
    found = groups.select(F.col("doc_id").alias("place"), "component_id")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("first")
    stay = (docs.select(place.alias("place"), F.col("doc_id").alias("id")).join(found, "place")
            .groupBy("component_id").agg(first).select(F.col("first.place").alias("__place")))
    return (docs.withColumn("__place", place).join(stay, "__place", "left_semi")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Take out repeated passages; documents of which nothing is left go.

    NULL texts, and those shorter than a window, stay as they are; ``n_chars`` follows the text
    where it changed. Rows that repeat id and text get the same result; different texts
    under one id, and rows without an id, are documents of their own. An empty table gives no
    rows. Other columns stay as they are.
    """
    kept = substring_dedup.without_repeats(docs, carry=True)
    changed, new = F.col("n_removed") > 0, {
        "text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return kept.where("n_removed = 0 OR n_removed < n_words").select(*[
        F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new
        else F.col("row")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents that hold a benchmark item.

    NULL and empty texts hold none and stay. Rows are judged one by one by their text, whatever
    their id. Without benchmark items all rows stay; an empty table gives no rows. Columns
    stay as they are.
    """
    return decontaminate.without_benchmark(docs, table(spark, folder, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every row, as ``merge_dropout.encode`` defines them for NULLs, empty texts,
    repeated rows and empty tables. Columns other than ``doc_id`` and ``text`` are not read."""
    return merge_dropout.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("merge_dropout", tokenise),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on ``documents``: one row (doc_id, token_ids, …) per document left."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
