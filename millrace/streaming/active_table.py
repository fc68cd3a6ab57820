"""The active-event table: appended batches, and terminal events that end earlier rows.

A batch is written once, as two partitions: its live rows and the rows that end a user.
Nothing stored is rewritten by a batch, and writing a batch again replaces it.
Reading resolves the two: a row lives unless its user was ended in a later batch.
Several batches can be merged into one of the same form, numbered as their last.
The base is dealt into buckets by user and salt: however many users were ended since, only
they are shuffled to it, and a user with very many rows is in several buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from millrace.functions import TERMINAL_EVENTS, is_terminal
from millrace.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join
from millrace.schemas import ACTIVE_EVENT, LONG, STRING, struct
from millrace.session import child_names, delete_path, path_exists, settle
from millrace.sources.buckets import BucketedFolder, bucket_count
from millrace.sources.tables import select_schema

LIVE, ENDED = "live", "ended"
#: Buckets that the rows of one user are spread over, at most.
SALTS = 8
_SALT = "__salt"
_MARK = "upto long, full boolean, buckets int"


def split_kinds(events: DataFrame, terminal=TERMINAL_EVENTS, event: str = "event",
                user: str = "user_id") -> DataFrame:
    """Add ``kind``. Unknown (NULL) events fall out, and so do ended NULL users."""
    kind = F.when(is_terminal(F.col(event), terminal), F.lit(ENDED)).otherwise(F.lit(LIVE))
    return (events.where(F.col(event).isNotNull()).withColumn("kind", kind)
            .where((F.col("kind") == LIVE) | F.col(user).isNotNull()))


def resolve(live: DataFrame, ended: DataFrame, user: str = "user_id", batch: str = "batch_id",
            broadcast: bool | None = None, max_rows: int | None = None) -> DataFrame:
    """Rows of ``live`` whose user has no row in ``ended`` of a later batch."""
    bound = {} if max_rows is None else {"max_rows": max_rows}
    return _not_ended(live, _last_ended(ended, user, batch), user, batch, broadcast=broadcast, **bound)


def _last_ended(ended, user="user_id", batch="batch_id"):
    return settle(ended.groupBy(F.col(user).alias("__user")).agg(F.max(batch).alias("__ended_in")))


def _not_ended(live, last, user="user_id", batch="batch_id", **how):
    joined = lookup_join(live, last, user, "__user", **how)
    kept = F.col("__ended_in").isNull() | (F.col(batch) >= F.col("__ended_in"))
    return joined.where(kept).drop("__ended_in")


def salted(rows: DataFrame) -> DataFrame:
    """Rows with a salt; any will do, as ended users meet every one."""
    return rows.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))


def not_ended_in_buckets(base: DataFrame, last: DataFrame) -> DataFrame:
    """Rows of a bucketed base whose user is not in ``last``, read where they are."""
    everywhere = last.select("__user", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__in"))
    same = (F.col("user_id") == F.col("__user")) & (F.col(_SALT) == F.col("__in"))
    return base.join(everywhere.hint("merge"), same, "left_anti")


def delete_matched(target: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """What a delete of all rows of ``users`` (distinct) leaves; NULL never matches."""
    return lookup_join(target, users, user, user, "left_anti")


def matched_rows(target: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """The rows such a delete removes."""
    return lookup_join(target, users, user, user, "left_semi")


class ActiveTable:
    """Folders: ``base`` (resolved rows), ``merged`` (several batches as one), ``batches``.

    ``marks`` lists the bases and merged parts that are complete; nothing else is read.
    """

    def __init__(self, spark: SparkSession, root: str,
                 schema: T.StructType = ACTIVE_EVENT, terminal=TERMINAL_EVENTS,
                 buckets: int | None = None):
        """``buckets`` of new bases: by default as many as the session shuffles into."""
        self.spark = spark
        self.buckets = buckets
        self.root = root.rstrip("/")
        self.schema = schema
        self.terminal = terminal

    def create(self) -> None:
        """Empty typed table; fails if there is one already."""
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("errorifexists").parquet(f"{self.root}/base/upto=-1")
        self._mark(-1, full=True, buckets=None)

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/marks")

    def attach(self, checkpoint: str) -> int:
        """First batch number for a stream. A fresh checkpoint counts on after all others."""
        streams = f"{self.root}/streams"
        known = "checkpoint string, first long"
        if path_exists(self.spark, f"{checkpoint}/metadata") and path_exists(self.spark, streams):
            started = (self.spark.read.schema(known).parquet(streams)
                       .where(F.col("checkpoint") == checkpoint)
                       .agg(F.max("first")).first()[0])
            if started is not None:
                return started
        first = self.last_batch() + 1
        (self.spark.createDataFrame([(checkpoint, first)], known).coalesce(1)
             .write.mode("append").parquet(streams))
        return first

    def append_batch(self, events: DataFrame, batch_id: int) -> dict[str, int]:
        """Store one batch with a single pass over it; returns row counts by fate."""
        seen = Observation(f"batch {batch_id}")
        terminal = is_terminal(F.col("event"), self.terminal)
        observed = select_schema(events, self.schema).observe(
            seen,
            F.count(F.when(~terminal, 1)).alias("live"),
            F.count(F.when(terminal, 1)).alias("ended"),
            F.count(F.when(F.col("event").isNull(), 1)).alias("unknown_event"),
            F.count(F.when(F.col("user_id").isNull(), 1)).alias("unknown_user"))
        (split_kinds(observed, self.terminal).write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy("kind")
            .parquet(f"{self.root}/batches/batch_id={batch_id}"))
        return seen.get

    def read(self, max_rows: int | None = None) -> DataFrame:
        """The rows alive now."""
        upto, merged = self._complete()
        later = self._since(merged[-1] if merged else upto)
        if merged:
            later = self._merged(merged).unionByName(later)
        live = later.where(F.col("kind") == LIVE).drop("kind")
        last = _last_ended(later.where(F.col("kind") == ENDED))
        small = fits_broadcast(last, BROADCAST_ROWS if max_rows is None else max_rows)
        buckets = self._buckets(upto)
        if small or not buckets:
            alive = _not_ended(live.unionByName(self._base(upto)), last, broadcast=small)
            return alive.select(*self.schema.names)
        base = not_ended_in_buckets(self._bucketed(upto, buckets).read(), last)
        return (_not_ended(live, last, broadcast=False).select(*self.schema.names)
                .unionByName(base.select(*self.schema.names)))

    def compact(self) -> int:
        """Merge the batches since the last time into one. Call it between batches.

        Once the parts after the base hold as many rows as the base, all is resolved
        into a new base instead, so that a row is rewritten a few times only. No file gets
        all rows of a user with very many.
        """
        upto, (base, merged) = self.last_batch(), self._complete()
        last = merged[-1] if merged else base
        if upto == last:
            return upto
        since = self._since(last)
        later = self._merged(merged).unionByName(since) if merged else since
        full = later.where(F.col("kind") == LIVE).count() >= self._base(base).count()
        if full:
            buckets = self.buckets or bucket_count(self.spark)
            self._bucketed(upto, buckets).write(salted(self.read()))
        else:
            buckets = None
            (self._as_one(since).hint("rebalance").write.mode("overwrite").partitionBy("kind")
                 .parquet(f"{self.root}/merged/upto={upto}"))
        self._mark(upto, full, buckets)
        return upto

    def vacuum(self, keep: int = 2) -> int:
        """Delete what only readers from before the last ``keep`` compactions need."""
        marks = self._marks()
        covered = sorted({upto for upto, _ in marks})[-keep:][0]
        oldest_base = sorted(upto for upto, full in marks if full)[-keep:][0]
        limits = {"batches": covered + 1, "merged": oldest_base + 1, "base": oldest_base}
        gone = [f"{self.root}/{kind}/{name}" for kind, limit in limits.items()
                for name in child_names(self.spark, f"{self.root}/{kind}")
                if "=" in name and int(name.split("=")[1]) < limit]
        for path in gone:
            if path.startswith(f"{self.root}/base/"):
                self._bucketed(int(path.split("=")[-1]), 1).forget()
        return sum(delete_path(self.spark, path) for path in gone)

    def last_batch(self) -> int:
        base, merged = self._complete()
        stored = [int(name.split("=")[1])
                  for name in child_names(self.spark, f"{self.root}/batches") if "=" in name]
        return max([base, *merged, *stored])

    def _since(self, batch_id):
        """Stored batches after ``batch_id`` with columns ``batch_id`` and ``kind``."""
        schema = self._stored(batch_id=LONG, kind=STRING)
        if not path_exists(self.spark, f"{self.root}/batches"):
            return self.spark.createDataFrame([], schema)
        batches = self.spark.read.schema(schema).parquet(f"{self.root}/batches")
        return batches.where(F.col("batch_id") > batch_id)

    def _as_one(self, batches):
        """Several batches in the form of one: rows alive after them, users ended in them."""
        ended = batches.where(F.col("kind") == ENDED)
        live = resolve(batches.where(F.col("kind") == LIVE), ended).drop("batch_id")
        others = {f.name: F.lit(None).cast(f.dataType)
                  for f in self.schema.fields if f.name != "user_id"}
        users = ended.select("user_id").distinct().withColumns(others)
        return live.unionByName(users.withColumn("kind", F.lit(ENDED)))

    def _merged(self, numbers):
        paths = [f"{self.root}/merged/upto={number}" for number in numbers]
        return (self.spark.read.schema(self._stored(upto=LONG, kind=STRING))
                .option("basePath", f"{self.root}/merged").parquet(*paths)
                .withColumnRenamed("upto", "batch_id"))

    def _base(self, upto):
        return (self.spark.read.schema(self.schema).parquet(f"{self.root}/base/upto={upto}")
                .withColumn("batch_id", F.lit(upto).cast("long")))

    def _bucketed(self, upto, buckets):
        schema = T.StructType([*self.schema.fields, T.StructField(_SALT, T.IntegerType())])
        return BucketedFolder(self.spark, f"{self.root}/base/upto={upto}", schema, ["user_id", _SALT], buckets)

    def _buckets(self, upto):
        """Buckets of a base; none if it was written before there were any."""
        marks = self.spark.read.schema(_MARK).parquet(f"{self.root}/marks")
        return marks.where((F.col("upto") == upto) & F.col("full")).agg(F.max("buckets")).first()[0]

    def _stored(self, **partitions):
        return T.StructType(self.schema.fields + struct(**partitions).fields)

    def _marks(self):
        """(upto, full) of every completed compaction: control data, one row each."""
        marks = self.spark.read.schema(_MARK).parquet(f"{self.root}/marks").select("upto", "full")
        return sorted({tuple(row) for row in marks.collect()})

    def _complete(self):
        """The last base, and the merged parts after it in order."""
        marks = self._marks()
        base = max(upto for upto, full in marks if full)
        return base, sorted(upto for upto, full in marks if not full and upto > base)

    def _mark(self, upto, full, buckets):
        (self.spark.createDataFrame([(upto, full, buckets)], _MARK).coalesce(1)
             .write.mode("append").parquet(f"{self.root}/marks"))
