"""One query per operator, over its whole table, and SQL to check those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (ctph, decontaminate, exact_dedup, hard_negatives, importance, language_id,
                          merge_dropout, simhash, substring_dedup, template_text, token_file, toxicity,
                          warc)
from millrace.llm.common import table

#: Rows that classifiers learn from: those whose remainder is not 1.
HELD_OUT = "crc32(cast(doc_id AS string)) % 3 = 1"


def op1_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return merge_dropout.encode(table(spark, folder, "documents"),
                                public_tokenizers.path("piece_bpe_32k.model"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.where(f"NOT ({HELD_OUT})"))
    return language_id.identify(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"),
        "lang_pred", "score", "ambiguous")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return template_text.extract(table(spark, folder, "pages"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_ctph(spark: SparkSession, folder: str) -> DataFrame:
    return ctph.likeness_to_edits(table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"),
                                      table(spark, folder, "benchmark"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    files = token_file.write(table(spark, folder, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), spell_special=False)
    return token_file.digests(files)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    labelled = docs.where(f"NOT ({HELD_OUT})").select("doc_id", "text").join(labels, "doc_id")
    model = toxicity.fit(labelled)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"), digest_all=True)
    return found.withColumnRenamed("digest", "text_sha256")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = table(spark, folder, "embeddings").withColumn("label", shifted)
    return hard_negatives.mine(rows, F.expr("vec_id % 100 = 0"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_merge_dropout": op1_merge_dropout,
    "op2_language_id": op2_language_id,
    "op3_main_text": op3_main_text,
    "op4_warc": op4_warc,
    "op5_ctph": op5_ctph,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_token_file": op8_token_file,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance": op13_importance,
    "pipeline": pipeline,
}

ORACLE = {
    "op4_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
           (('0x' || substr(hex, (5 * i // 4 + 1)::INT, 2))::INT >> (3 - 5 * i % 4)::INT) & 31)), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM p""",
    "op10_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS words FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(words[s:s + 19], ' ') AS line
  FROM w, unnest(range(1, len(words) - 18)) AS u(s)),
firsts AS (SELECT line, min((doc_id, s)) AS place FROM win GROUP BY line),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM win JOIN firsts USING (line), unnest(range(s, s + 20)) AS v(p)
  WHERE (doc_id, s) > place GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(words) + 1),
           lambda i: NOT list_contains(coalesce(places, []), i)), lambda i: words[i]), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)""",
    "op11_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_hard_negatives": """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT * FROM ranked WHERE rank <= 10""",
    "op13_importance": r"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS step FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
lines AS (SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
split AS (
  SELECT own, doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM lines),
found AS (SELECT own, doc_id, unnest(words) AS word FROM split),
bytes AS (
  SELECT word, list_transform(range(1, length(hex(encode(word))), 2),
                              lambda i: ('0x' || substr(hex(encode(word)), i::INT, 2))::BIGINT) AS b
  FROM (SELECT DISTINCT word FROM found)),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b),
           lambda c, x: xor(step[(xor(c, x) & 255) + 1], c >> 8))) % 10000 AS bucket
  FROM bytes, steps),
counts AS (
  SELECT bucket, count(*) FILTER (own)::DOUBLE AS s, count(*) FILTER (NOT own)::DOUBLE AS t
  FROM found JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))
                                 / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts),
weights AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight
  FROM found JOIN hashed USING (word) JOIN gains USING (bucket) WHERE own GROUP BY doc_id),
scores AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (doc_id) WHERE own),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scores WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scores s LEFT JOIN ranked USING (doc_id)""",
}
