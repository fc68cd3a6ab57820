"""Regional orders on the given tables: ``orders`` by priority stands in for regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import row_json
from millrace.operators import orders as operators
from millrace.plans import regional_orders
from millrace.queries import table
from millrace.schemas import CURATED_ORDER
from millrace.session import child_names, scratch_path
from millrace.sources.messages import parse_rows, to_messages
from millrace.sources.regions import (Region, archive, extract_envelope, parse_items, read_archive,
                                      read_landing)

# Regions that are expected: one does not deliver, and others deliver that are not.
EXPECTED = ["1-URGENT", "3-MEDIUM", "5-LOW", "6-NEVER"]


def landed_orders(spark, folder):
    """Orders as the regional services deliver them, unreadable values included."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    hour = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    country = F.concat(F.lit("  Country "), status, F.lit(" "))
    part = F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order-id"),
        priority.alias("product"),
        F.when((priority == "1-URGENT") & (status == "P"), "$1,299.00")
         .otherwise(F.concat(F.lit("$"), amount)).alias("price"),
        status.alias("payment method"),
        F.when(priority == "4-NOT SPECIFIED", "n")
         .otherwise((F.col("o_custkey") % 5 + 1).cast("string")).alias("rating"),
        F.concat(F.lit("order of "), part).alias("comment"),
        F.when(priority == "5-LOW", F.concat_ws(",", F.lit("street"), part, F.lit("city")))
         .otherwise(F.concat_ws(",", F.lit("street"), part, F.lit("city"), country))
         .alias("delivery address"),
        F.when((priority == "3-MEDIUM") & (status == "F"), "some day")
         .otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).alias("date"),
        F.concat(hour, F.lit(":30:15")).alias("time"),
    )


def _comparable(curated):
    """The timestamp without a zone, as the SQL side has none."""
    return curated.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def clean_orders(spark, folder):
    return _comparable(operators.clean_orders(landed_orders(spark, folder)))


def orders_rejects(spark, folder):
    return operators.order_rejects(landed_orders(spark, folder))


def union_regions(spark, folder):
    """Land every region in its own folder, then read, clean and union them."""
    landing = scratch_path(spark, "landing")
    (landed_orders(spark, folder).withColumn("region", F.col("product"))
        .write.partitionBy("region").json(landing))
    regions = [operators.clean_orders(read_landing(spark, [f"{landing}/{name}"]))
               for name in child_names(spark, landing) if name.startswith("region=")]
    return _comparable(operators.union_regions(regions))


def regions_complete(spark, folder):
    return operators.regions_complete(landed_orders(spark, folder), "product", EXPECTED)


def archive_roundtrip(spark, folder):
    """Two runs archived, one of them twice; read back the one archived twice."""
    target = scratch_path(spark, "archive")
    rows = landed_orders(spark, folder).withColumn("datakey", F.col("payment method"))
    for run_ts in ("20251205T020000", "20251205T020500", "20251205T020500"):
        archive(rows.withColumn("run_ts", F.lit(run_ts)), target)
    return read_archive(spark, target, "20251205T020500")


def regional_archive(spark, folder):
    """Land, check and archive by the job's functions; read back fields nobody declared."""
    store = scratch_path(spark, "store")
    regions = [Region("/x", status, "shop", f"orders-{status}.json", "dw", "orders")
               for status in ("F", "O", "P")]
    coupon = F.struct(F.concat(F.lit("c"), "o_custkey").alias("code"),
                      F.array(F.col("o_orderkey"), F.lit(1)).alias("uses"))
    item = F.struct(F.col("o_orderkey").cast("string").alias("order-id"), coupon.alias("coupon"))
    payloads = {}
    for region in regions:
        own = table(spark, folder, "orders").where(F.col("o_orderstatus") == region.datakey)
        payloads[region.datakey] = own.select(F.to_json(F.struct(
            F.lit(1).alias("total"), F.array(item).alias(region.datakey),
            F.struct(F.lit("ok").alias("state")).alias("status"))).alias("value"))
    regional_orders.land_payloads(payloads, regions, store)
    assert regional_orders.check_landing(spark, regions, store)
    regional_orders.archive_landing(spark, regions, store, "20251205T020000")
    stored = read_archive(spark, regions[0].archive(store), "20251205T020000")
    parsed = parse_items(stored, "`order-id`: string, coupon: struct<code: string, uses: array<bigint>>")
    return parsed.select("`order-id`", "coupon.code", F.element_at("coupon.uses", 1).alias("first_use"),
                         "datakey")


def _parsed(spark, folder):
    """Landed and parsed by the job's functions. Each region has fields of its own: nested
    ones, some that not all orders hold, one of two types, a declared one as a number."""
    store = scratch_path(spark, "drifting")
    regions = [Region("/x", status, "shop", f"orders-{status}.json", "dw", "orders") for status in ("F", "O", "P")]
    number = F.col("order-id").cast("bigint")
    coupon = F.struct(F.concat(F.lit("c"), "order-id").alias("code"), F.array(number, F.lit(1)).alias("uses"))
    weight = F.parse_json(F.when(number % 3 == 0, '"heavy"').otherwise(F.col("order-id")))
    own = {"F": {"coupon": coupon}, "P": {"weight": weight},
           "O": {"gift": F.when(number % 7 == 0, number % 2 == 0), "comment": number}}
    rows, payloads = landed_orders(spark, folder), {}
    for region in regions:
        items = rows.where(F.col("payment method") == region.datakey).withColumns(own[region.datakey])
        payloads[region.datakey] = items.select(
            F.to_json(F.struct(F.array(F.struct("*")).alias(region.datakey))).alias("value"))
    regional_orders.land_payloads(payloads, regions, store)
    return regional_orders.parse_landing(spark, regions, store, f"{store}/parsed")


def parsed_orders(spark, folder):
    """Curated orders from the values parsed at landing."""
    return _comparable(regional_orders.curated(_parsed(spark, folder)))


def undeclared_fields(spark, folder):
    return regional_orders.drift(_parsed(spark, folder))


def envelope_extract(spark, folder):
    """Payloads of none, one or two orders under a key that differs by region, beside
    keys that hold a number, a text and an object."""
    first = F.struct(F.col("o_orderkey").cast("string").alias("order-id"),
                     F.col("o_orderpriority").alias("product"))
    second = F.struct(F.concat(F.lit("gift "), F.col("o_orderkey")).alias("order-id"),
                      F.col("o_orderstatus").alias("product"))
    count = (F.when(F.col("o_orderstatus") == "P", 0)
             .when(F.col("o_orderstatus") == "O", 1).otherwise(2))
    items = F.to_json(F.slice(F.array(first, second), F.lit(1), count))
    key = F.concat("o_orderpriority", F.lit("-orders"))
    value = F.concat(F.lit('{"total":'), F.col("o_custkey"), F.lit(',"note":"[x]","'), key, F.lit('":'),
                     items, F.lit(',"page":{"next":[1,2]}}'))
    payloads = table(spark, folder, "orders").select(key.alias("datakey"), value.alias("value"))
    return extract_envelope(payloads, F.col("datakey"), "`order-id`: string, product: string")


def publish_json(spark, folder):
    """Orders as JSON messages, read back with the curated types."""
    messages = to_messages(operators.clean_orders(landed_orders(spark, folder)))
    return _comparable(parse_rows(messages, CURATED_ORDER))


def order_json(spark, folder):
    """The message text itself."""
    return table(spark, folder, "orders").select(
        row_json("o_orderkey", "o_custkey", "o_orderstatus").alias("value"))


QUERIES = {
    "envelope_extract": envelope_extract,
    "clean_orders": clean_orders,
    "orders_rejects": orders_rejects,
    "union_regions": union_regions,
    "regions_complete": regions_complete,
    "archive_roundtrip": archive_roundtrip,
    "regional_archive": regional_archive,
    "publish_json": publish_json,
    "order_json": order_json,
    "parsed_orders": parsed_orders,
    "undeclared_fields": undeclared_fields,
}

_LANDED = """
    SELECT CAST(o_orderkey AS VARCHAR) AS "order-id",
           o_orderpriority AS product,
           CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '$1,299.00'
                ELSE '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
           o_orderstatus AS "payment method",
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n'
                ELSE CAST(o_custkey % 5 + 1 AS VARCHAR) END AS rating,
           'order of ' || o_custkey AS comment,
           'street,' || o_custkey || ',city' ||
               CASE WHEN o_orderpriority = '5-LOW' THEN ''
                    ELSE ',  Country ' || o_orderstatus || ' ' END AS "delivery address",
           CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 'some day'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
           lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':30:15' AS time
    FROM orders"""
_CURATED = f"""
    SELECT trim(split_part("delivery address", ',', 4)) AS raw_country, *,
           TRY_CAST(replace(price, '$', '') AS FLOAT) AS price_dollar,
           TRY_CAST(rating AS INTEGER) AS rating_int,
           TRY_CAST(date || ' ' || time AS TIMESTAMP) AS stamp
    FROM ({_LANDED}) landed"""
_CLEAN = f"""
    SELECT CASE WHEN raw_country <> '' THEN raw_country END AS country, "order-id", product,
           price_dollar, "payment method", rating_int AS rating, comment, "delivery address",
           stamp AS "timestamp"
    FROM ({_CURATED}) curated"""

ORACLE = {
    "envelope_extract": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "order-id", o_orderpriority AS product
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT 'gift ' || o_orderkey, o_orderstatus
        FROM orders WHERE o_orderstatus NOT IN ('P', 'O')""",
    "clean_orders": _CLEAN,
    "orders_rejects": f"""
        SELECT * FROM (
            SELECT "order-id", price, rating, "delivery address", date, time,
                   concat_ws(',',
                       CASE WHEN raw_country = '' THEN 'delivery address' END,
                       CASE WHEN price_dollar IS NULL THEN 'price' END,
                       CASE WHEN rating_int IS NULL THEN 'rating' END,
                       CASE WHEN stamp IS NULL THEN 'timestamp' END) AS faults
            FROM ({_CURATED}) curated) flagged
        WHERE faults <> ''""",
    "union_regions": _CLEAN,
    "regions_complete": """
        WITH wanted(name) AS (VALUES ('1-URGENT'), ('3-MEDIUM'), ('5-LOW'), ('6-NEVER'))
        SELECT count(DISTINCT o_orderpriority) FILTER (o_orderpriority IN (SELECT name FROM wanted))
                 AS present,
               (SELECT string_agg(name, ',' ORDER BY name) FROM wanted
                WHERE name NOT IN (SELECT o_orderpriority FROM orders)) AS missing,
               count(DISTINCT o_orderpriority) FILTER (o_orderpriority NOT IN (SELECT name FROM wanted))
                 AS unexpected,
               false AS complete
        FROM orders""",
    "regional_archive": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "order-id", 'c' || o_custkey AS code,
               o_orderkey AS first_use, o_orderstatus AS datakey
        FROM orders""",
    "archive_roundtrip": f"""
        SELECT *, "payment method" AS datakey FROM ({_LANDED}) landed""",
    "publish_json": _CLEAN,
    "order_json": """
        SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey ||
               ',"o_orderstatus":"' || o_orderstatus || '"}' AS value
        FROM orders""",
    "parsed_orders": f"""
        SELECT * REPLACE (CASE WHEN "payment method" = 'O' THEN "order-id" ELSE comment END AS comment)
        FROM ({_CLEAN}) clean""",
    "undeclared_fields": """
        SELECT 'F' AS datakey, 'coupon' AS field, NULL::VARCHAR AS declared,
               'OBJECT<code: STRING, uses: ARRAY<BIGINT>>' AS type, count(*) AS items
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'O', 'gift', NULL, 'BOOLEAN', count(*)
        FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 7 = 0
        UNION ALL SELECT 'O', 'comment', 'STRING', 'BIGINT', count(*) FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'P', 'weight', NULL, 'VARIANT', count(*) FROM orders WHERE o_orderstatus = 'P'""",
}
