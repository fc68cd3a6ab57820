"""Staging loads on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from millrace.operators import staging as operators
from millrace.plans.staging_loads import FolderStaging, Trends, load_star, stage, star_writer
from millrace.queries import table
from millrace.session import scratch_path
from millrace.sources.published import PublishedRuns
from millrace.sources.tables import read_csv, write_csv

STAGED_BEFORE = "2024-01-16"


def _clicks(spark, folder):
    """Clicks by user, kind and day; the same row occurs many times."""
    return table(spark, folder, "events").select(
        "user_id", F.col("event_type").alias("product_id"), F.col("ts").cast("date").alias("day"))


def _staged_clicks(spark, folder):
    return _clicks(spark, folder).where(F.col("day") < F.lit(STAGED_BEFORE).cast("date"))


def staging_new_rows(spark, folder):
    return operators.new_rows(_clicks(spark, folder), _staged_clicks(spark, folder))


def staging_append(spark, folder):
    """Stage the first days, then everything, then everything again."""
    store = FolderStaging(spark, scratch_path(spark, "staging"))
    raw = _clicks(spark, folder)
    for run, rows in enumerate((_staged_clicks(spark, folder), raw, raw)):
        stage(rows, store, "clickstream", str(run))
    return store.read("clickstream", raw.schema)


def staging_replace(spark, folder):
    """The other mode: only the rows found new are left."""
    store = FolderStaging(spark, scratch_path(spark, "staging"))
    raw = _clicks(spark, folder)
    for run, rows in enumerate((_staged_clicks(spark, folder), raw)):
        stage(rows, store, "clickstream", str(run), mode="replace")
    return store.read("clickstream", raw.schema, "replace")


def staging_by_index(spark, folder):
    """A run's new rows by the kept fingerprints alone, beyond the broadcast bound."""
    store = FolderStaging(spark, scratch_path(spark, "staging"))
    raw = _clicks(spark, folder)
    for run, day in (("1", "2024-01-08"), ("2", STAGED_BEFORE)):
        stage(raw.where(F.col("day") < F.lit(day).cast("date")), store, "clickstream", run)
    return operators.new_by_index(raw, store.index("clickstream", raw.schema), max_rows=0)


def _sources(spark, folder):
    return {
        "users": table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "products": table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice"),
        "orders": table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        "clickstream": table(spark, folder, "events").select("event_id", "user_id", "ts"),
    }


def load_star_rows(spark, folder):
    """Stage the four tables, load them; change some rows, load twice more; all target rows.

    The second delivery repeats every row, changes the customers of one segment and has
    rows without a key.
    """
    root = scratch_path(spark, "star")
    store = FolderStaging(spark, f"{root}/staging")
    sources = _sources(spark, folder)
    fresh = {name: stage(rows, store, name, "1") for name, rows in sources.items()}
    targets = load_star(fresh, lambda rows, target: rows.write.parquet(f"{root}/{target}/load=1"))
    users = sources["users"]
    changed = users.where("c_mktsegment = 'BUILDING'").withColumn("c_name", F.upper("c_name"))
    nameless = users.where("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", F.lit(None).cast("bigint"))
    delivered = {**sources, "users": users.unionByName(changed).unionByName(nameless).unionByName(nameless)}
    fresh = {name: stage(rows, store, name, "2") for name, rows in delivered.items()}
    for load in (2, 3):
        load_star(fresh, lambda rows, target: rows.write.parquet(f"{root}/{target}/load={load}"),
                  loaded=lambda target: spark.read.parquet(f"{root}/{target}"))
    rows = []
    for target in targets.values():
        stored = spark.read.parquet(f"{root}/{target}").drop("load")
        rows.append(stored.select(F.lit(target).alias("target"), *[
            F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(stored.columns[:2])]))
    return reduce(lambda a, b: a.unionByName(b), rows)


def csv_roundtrip(spark, folder):
    """Write a table as CSV with a header line and scan it with its schema."""
    target = f"{scratch_path(spark, 'raw')}/products.csv"
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"), F.col("p_size").alias("stock"))
    write_csv(rows, target)
    return read_csv(spark, target, rows.schema)


def monthly_trend(spark, folder):
    clicks = table(spark, folder, "events").where("event_type = 'click'")
    return operators.monthly_trend(table(spark, folder, "orders"), "o_orderdate", clicks, "ts")


def hourly_clicks(spark, folder):
    clicks = table(spark, folder, "events").where("event_type = 'click'")
    return operators.hourly_clicks(clicks, "ts")


def load_star_published(spark, folder):
    """Two deliveries of the facts; the second load dies before its files are published, is
    run again, and then once more."""
    root, targets = scratch_path(spark, "published"), ("fact_orders", "fact_clicks")
    orders, clicks = table(spark, folder, "orders"), table(spark, folder, "events")
    def delivery(day):
        return {"orders": orders.where(f"(o_orderdate < DATE '1996-01-01') = {day}").selectExpr(
                    "CAST(o_orderkey AS STRING) AS id", "CAST(o_custkey AS STRING) AS by"),
                "clickstream": clicks.where(f"(ts < TIMESTAMP '{STAGED_BEFORE}') = {day}").selectExpr(
                    "CAST(event_id AS STRING) AS id", "CAST(user_id AS STRING) AS by")}

    load_star(delivery("true"), star_writer(spark, root, "1"))
    PublishedRuns(spark, f"{root}/fact_orders").write(delivery("false")["orders"])
    for _ in range(2):
        load_star(delivery("false"), star_writer(spark, root, "2"))
    found = [PublishedRuns(spark, f"{root}/{t}").read("id string, by string").withColumn("target", F.lit(t))
             for t in targets]
    return found[0].unionByName(found[1])


def _trends(spark, folder):
    """Orders by year and clicks by day of the month as runs, late ones first, one repeated."""
    trends = Trends(spark, scratch_path(spark, "trends"))
    orders = table(spark, folder, "orders")
    clicks = table(spark, folder, "events").where("event_type = 'click'")
    for part in (2, 0, 1, 2):
        trends.add(f"run-{part}", orders.where(F.year("o_orderdate") % 3 == part), "o_orderdate",
                   clicks.where(F.day("ts") % 3 == part), "ts")
    return trends


def monthly_trend_by_run(spark, folder):
    return _trends(spark, folder).monthly()


def hourly_clicks_by_run(spark, folder):
    return _trends(spark, folder).hourly()


QUERIES = {
    "staging_new_rows": staging_new_rows,
    "staging_by_index": staging_by_index,
    "staging_append": staging_append,
    "staging_replace": staging_replace,
    "load_star": load_star_rows,
    "csv_roundtrip": csv_roundtrip,
    "monthly_trend": monthly_trend,
    "hourly_clicks": hourly_clicks,
    "load_star_published": load_star_published,
    "monthly_trend_by_run": monthly_trend_by_run,
    "hourly_clicks_by_run": hourly_clicks_by_run,
}

_RAW = "SELECT user_id, event_type AS product_id, CAST(ts AS DATE) AS day FROM events"
_STAGED = f"SELECT * FROM ({_RAW}) raw WHERE day < DATE '{STAGED_BEFORE}'"
_MONTHLY = """
    SELECT coalesce(o.month, c.month) AS month, coalesce(orders, 0) AS orders,
           coalesce(clicks, 0) AS clicks
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders
          FROM orders GROUP BY 1) o
    FULL JOIN (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS clicks
               FROM events WHERE event_type = 'click' GROUP BY 1) c ON o.month = c.month"""
_HOURLY = """
    SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS clicks
    FROM events WHERE event_type = 'click' GROUP BY 1"""

ORACLE = {
    "staging_new_rows": f"{_RAW} EXCEPT {_STAGED}",
    "staging_by_index": f"{_RAW} EXCEPT {_STAGED}",
    "staging_append": f"""
        SELECT DISTINCT * FROM ({_STAGED}) staged
        UNION ALL
        SELECT * FROM ({_RAW} EXCEPT {_STAGED}) fresh""",
    "staging_replace": f"{_RAW} EXCEPT {_STAGED}",
    "load_star": """
        SELECT 'dim_users' AS target, CAST(c_custkey AS VARCHAR) AS c0, c_name AS c1 FROM customer
        UNION ALL SELECT 'dim_users', CAST(c_custkey AS VARCHAR), upper(c_name) FROM customer
        WHERE c_mktsegment = 'BUILDING' AND upper(c_name) <> c_name
        UNION ALL SELECT DISTINCT 'dim_users', NULL, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT 'dim_products', CAST(p_partkey AS VARCHAR), p_name FROM part
        UNION ALL SELECT 'fact_orders', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders
        UNION ALL SELECT 'fact_clicks', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR) FROM events""",
    "csv_roundtrip": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               p_type AS category, p_retailprice AS price, p_size AS stock
        FROM part""",
    "monthly_trend": _MONTHLY,
    "hourly_clicks": _HOURLY,
    "monthly_trend_by_run": _MONTHLY,
    "hourly_clicks_by_run": _HOURLY,
    "load_star_published": """
        SELECT 'fact_orders' AS target, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS "by" FROM orders
        UNION ALL SELECT 'fact_clicks', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR) FROM events""",
}
