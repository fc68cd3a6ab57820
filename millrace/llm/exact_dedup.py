"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

One scan notes the length of every text and a hash of its first characters, 16 bytes a row.
Texts whose length nobody shares are alone; of the rest those whose length and prefix
nobody shares. Both are decided on the notes. Only texts that are left are read in full
and hashed (SHA-256), in a second scan, and grouped by that hash.

The surviving groups reach the second scan as a bitmap of fixed size, so texts never move,
however many groups survive. Groups that share a bit only have texts hashed in vain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import release, stored
from millrace.operators.joins import lookup_join
from millrace.session import settle

#: Characters of the prefix that is hashed before a text is read in full.
PREFIX = 64
#: Bits of the bitmap of surviving groups: 2 MB are sent to every task, whatever the input.
BITS = 1 << 24


def _shared(notes: DataFrame, *columns: str) -> DataFrame:
    """Values of ``columns`` that more than one row has."""
    return (notes.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(*columns))


def _bit(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITS))


def bitmap(values: DataFrame, *columns: str) -> DataFrame:
    """A set of ``columns`` values as at most ``BITS`` / 32,768 rows (bucket, bits)."""
    return (values.select(_bit(*columns).alias("at"))
            .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))


def with_member(rows: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """Add ``member``: false for rows whose ``columns`` are surely not in the bitmap."""
    at = rows.withColumn("at", _bit(*columns))
    bucket = F.bitmap_bucket_number("at")
    # Bounded by BITS, see bitmap().
    found = at.join(F.broadcast(members), bucket == F.col("bucket"), "left")
    inside = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring("bits", F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10)
    member = F.getbit(byte.cast("int"), (inside % 8).cast("int")) == 1
    return found.withColumn("member", F.coalesce(member, F.lit(False))).drop("at", "bucket", "bits")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     normalise: Callable[[Column], Column] | None = None,
                     digest_all: bool = False, prefix: int = PREFIX) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, digest) per row of ``docs``.

    Texts are equal if they are after ``normalise`` (nothing by default); NULL counts as
    empty. Of equal texts the row with the largest id stays: ``kept``, ``keep_id`` its id.
    ``digest`` is the SHA-256 of the text in lowercase hex, where the text had to be read in
    full or ``digest_all`` asks for it, else NULL.

    Of rows that repeat the largest id with the same text one stays. A row without an id
    stays only if no row of its group has one; ``keep_id`` is NULL then. An empty table
    gives no rows; columns other than the two named are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    size = F.octet_length(text).alias("size")
    head = F.xxhash64(F.substring(text, 1, prefix)).alias("head")

    notes, _ = stored(docs.select(size, head), "notes")
    lengths = bitmap(_shared(notes, "size"), "size")
    left = with_member(notes, lengths, "size").where("member")
    members = settle(bitmap(_shared(left, "size", "head"), "size", "head"))

    rows = with_member(docs.select(F.col(f"`{id_col}`").alias("key"), text.alias("whole"), size, head),
                       members, "size", "head")
    digest = F.unhex(F.sha2("whole", 256))
    digest = digest if digest_all else F.when(F.col("member"), digest)
    found, _ = stored(rows.select("key", "member", digest.alias("digest"),
                                  F.monotonically_increasing_id().alias("place")), "digests")
    release(docs.sparkSession)

    first = F.max(F.struct("key", "place"))
    groups = settle(found.where("member").groupBy(F.col("digest").alias("of"))
                    .agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    asked = found.withColumn("asked", F.when(F.col("member"), F.col("digest")))
    alone = asked.where("NOT member").withColumns({"first": F.lit(None).cast(groups.schema["first"].dataType),
                                                   "n": F.lit(None).cast("long")})
    told = lookup_join(asked.where("member"), groups, "asked", "of").unionByName(alone)
    grouped = F.col("n").isNotNull()
    return told.select(
        F.col("key").alias("doc_id"),
        F.when(grouped, F.col("first.key")).otherwise(F.col("key")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (~grouped | (F.col("place") == F.col("first.place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("digest"))
