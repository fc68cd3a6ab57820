"""Per-region configuration and the landing and archive folders of regional orders."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.schemas import LANDED_ORDER


@dataclass(frozen=True)
class Region:
    endpoint: str
    datakey: str
    bucket: str
    key: str
    database: str
    table: str

    def landing(self, store: str) -> str:
        return f"{store.rstrip('/')}/{self.bucket}/New-Orders/{self.key}"

    def archive(self, store: str) -> str:
        return f"{store.rstrip('/')}/{self.bucket}/Raw-Orders"

    @classmethod
    def from_mapping(cls, settings: dict) -> Region:
        return cls(settings["endpoint"], settings["datakey"],
                   settings["s3_storage"]["bucket"], settings["s3_storage"]["key"],
                   settings["table_storage"]["database"], settings["table_storage"]["table"])


def load_regions(folder: str) -> list[Region]:
    """One YAML file per region. Secrets in the files are not read."""
    import yaml

    return [Region.from_mapping(yaml.safe_load(path.read_text()))
            for path in sorted(Path(folder).glob("*.yaml"))]


def envelope_items(payloads: DataFrame, datakey) -> DataFrame:
    """The raw JSON text of each row under key ``datakey`` of the payloads in ``value``.

    ``datakey`` is a name or a column, so one plan serves every region. Keys beside it may
    hold anything; the items keep every field, nested ones too.
    """
    key = F.lit(datakey) if isinstance(datakey, str) else datakey
    held = F.try_element_at(F.from_json("value", "map<string, string>"), key)
    return payloads.select(F.explode(F.from_json(held, "array<string>")).alias("value"))


def extract_envelope(payloads: DataFrame, datakey, item_schema: str) -> DataFrame:
    """Rows under key ``datakey`` of each JSON payload in ``value``, as columns."""
    return parse_items(envelope_items(payloads, datakey), item_schema)


def parse_items(items: DataFrame, item_schema) -> DataFrame:
    """Declared fields of raw JSON items; further columns are kept.

    The parse is inside a generator: as a plain column it would be repeated per use.
    """
    parsed = F.from_json("value", f"struct<{item_schema}>" if isinstance(item_schema, str)
                         else item_schema)
    rest = [c for c in items.columns if c != "value"]
    return items.select(*rest, F.explode(F.array(parsed)).alias("__item")).select("__item.*", *rest)


def as_variant(items: DataFrame) -> DataFrame:
    """Items parsed once: ``value`` becomes the VARIANT ``item``, NULL where the text is no JSON
    object or names a key twice; ``unread`` keeps the text of those."""
    object_ = F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value"))
    rest = [F.col(f"`{c}`") for c in items.columns if c != "value"]
    return items.select(*rest, F.explode(F.array(F.struct(object_.alias("item"), "value"))).alias("__read")).select(
        *rest, "__read.item", F.when(F.col("__read.item").isNull(), F.col("__read.value")).alias("unread"))


def declared_fields(parsed: DataFrame, schema: StructType) -> DataFrame:
    """The fields of ``schema`` from the column ``item``; NULL where absent or not convertible.
    Items that could not be read are rows of NULLs. Further columns are kept."""
    rest = [F.col(f"`{c}`") for c in parsed.columns if c not in ("item", "unread")]
    return parsed.select(*[
        F.try_variant_get("item", f'$["{f.name}"]', f.dataType.simpleString()).alias(f.name)
        for f in schema.fields], *rest)


def undeclared_fields(parsed: DataFrame, by: str, schema: StructType) -> DataFrame:
    """Fields that ``schema`` does not declare, or that came as another type: rows (``by``,
    field, declared, type, items).

    ``type`` is one that holds all values of the group, nested fields included (VARIANT if none
    does; a whole number beside a decimal one counts as one of 20 digits); ``items`` counts those that hold the field, JSON null too. Items
    that could not be read, or without any field, are counted under a NULL field. Values
    meet per task first, so what is shuffled grows with the number of fields.
    """
    fields = parsed.select(F.col(f"`{by}`").alias("__by"), "item").lateralJoin(
        parsed.sparkSession.tvf.variant_explode_outer(F.col("item").outer()))
    found = fields.groupBy("__by", "key").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("items"))
    declared = F.create_map(*[F.lit(x) for f in schema.fields
                              for x in (f.name, f.dataType.simpleString().upper())])
    return found.select(
        F.col("__by").alias(by), F.col("key").alias("field"),
        F.try_element_at(declared, F.col("key")).alias("declared"),
        F.when(F.col("key").isNotNull(), F.col("type")).alias("type"), "items",
    ).where("field IS NULL OR declared IS NULL OR type NOT IN (declared, 'VOID')")


def land(items: DataFrame, location: str) -> None:
    """Replace the landing folder with the raw items, one JSON text per line."""
    items.select("value").write.mode("overwrite").text(location)


def read_raw(spark: SparkSession, locations: list[str]) -> DataFrame:
    """The raw items of all landing files in one scan (JSON lines or one array a line),
    with the file's path."""
    lines = spark.read.text(locations).select("value", F.col("_metadata.file_path").alias("path"))
    items = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
    return (lines.where(F.trim("value") != "").select("path", F.explode(items).alias("value"))
            .select("value", "path"))


def read_landing(spark: SparkSession, locations: list[str]) -> DataFrame:
    """One scan over the landing files of all regions, with the declared fields."""
    return parse_items(read_raw(spark, locations).select("value"), LANDED_ORDER)


def region_of(path, regions: list[Region]):
    """The data key of the region in whose landing folder a file lies."""
    found = F.lit(None).cast("string")
    for region in regions:
        inside = path.contains(region.landing("") + "/") | path.endswith(region.landing(""))
        found = F.when(inside, F.lit(region.datakey)).otherwise(found)
    return found


def archive(rows: DataFrame, location: str) -> None:
    """Write ``run_ts``/``datakey`` partitions, replacing those of the same key only.

    Rows are brought together by partition, a large one in several files.
    """
    (rows.hint("rebalance", "run_ts", "datakey").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_ts", "datakey").parquet(location))


def read_archive(spark: SparkSession, location: str, run_ts: str) -> DataFrame:
    """The rows of one run. Keys are strings, whatever they look like."""
    path = f"{location}/run_ts={run_ts}"
    stored = spark.read.option("basePath", path).parquet(path).drop("datakey").schema
    return (spark.read.schema(StructType([*stored.fields, StructField("datakey", StringType())]))
            .option("basePath", path).parquet(path))
