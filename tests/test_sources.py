from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import batch_number
from millrace.operators.traffic import scale_domain
from millrace.plans.app_traffic import log_events, preview, region_traffic
from millrace.session import object_store_options, scratch_path, settle, shared_dir
from millrace.sources.batches import (list_batches, mark_processed, next_batch, numbered,
                                      read_processed)
from millrace.sources import jdbc
from millrace.sources.jdbc import Database, ReadSplit
from millrace.sources.messages import parse_rows, publish, to_messages
from millrace.sources.tables import (empty_relation, read_boundaries, read_table, select_schema,
                                     write_table)
from tests.helpers import rows, values


def test_messages_round_trip(spark, tmp_path):
    given = spark.createDataFrame([(1, "a \"b\""), (2, None)], "x int, y string")
    messages = to_messages(given)
    assert messages.dtypes == [("value", "binary")]
    assert rows(parse_rows(messages, given.schema)) == rows(given)
    publish(given, str(tmp_path / "out"))
    assert rows(parse_rows(spark.read.text(str(tmp_path / "out")), given.schema)) == rows(given)


def test_boundaries(spark, tmp_path):
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NAME_1": name, "GID": 1},
         "geometry": {"type": "Point", "coordinates": [1, 2]}} for name in ("Goa", "Kerala")]}
    path = tmp_path / "map.json"
    path.write_text(json.dumps(collection, indent=1))
    assert rows(read_boundaries(spark, str(path))) == [("Goa",), ("Kerala",)]


def test_traffic_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text(
        '{"user_id":1,"state":"Goa","event_id":1,"device_id":1}\n' * 3)
    (tmp_path / "map.json").write_text(json.dumps({"features": [
        {"properties": {"NAME_1": name}} for name in ("Goa", "Kerala")]}))
    write_table(spark.createDataFrame([(1, "login")], "Event_ID int, event string"),
                str(tmp_path / "events"))
    write_table(spark.createDataFrame([(1, "Mobile")], "Device_ID int, device string"),
                str(tmp_path / "devices"))
    log_events(spark, table=str(tmp_path / "active"), checkpoint=str(tmp_path / "checkpoint"),
               event_lookup=str(tmp_path / "events"), device_lookup=str(tmp_path / "devices"),
               folder=str(tmp_path / "in"), available_now=True, timeout=60)
    filled = region_traffic(spark, table=str(tmp_path / "active"), boundaries=str(tmp_path / "map.json"))
    assert rows(filled) == [("Goa", 3), ("Kerala", 0)]
    assert rows(scale_domain(filled)) == [(0, 3)]
    assert preview(filled, 1).count() == 1
    assert sorted(filled.toPandas()["app_traffic"]) == [0, 3]


def test_table_formats(spark, tmp_path):
    given = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    for fmt in ("parquet", "json", "csv", "orc"):
        write_table(given, str(tmp_path / fmt), fmt)
        assert rows(read_table(spark, str(tmp_path / fmt), fmt, given.schema)) == rows(given)
    write_table(given, str(tmp_path / "parts"), partition_by=("x",))
    assert read_table(spark, str(tmp_path / "parts")).where("x = 2").count() == 1


def test_declared_schema(spark):
    given = spark.createDataFrame([("1", 2)], "`order-id` string, n int")
    wanted = empty_relation(spark, "n long, `order-id` int")
    assert select_schema(given, wanted.schema).first() == (2, 1)
    assert wanted.isEmpty()


@pytest.mark.parametrize("name, number", [
    ("Training_data_0.parquet", 0), ("/d/Training_data_12.parquet", 12),
    ("Training_data_3.csv", None), ("Training_data.parquet", None), (None, None)])
def test_batch_number(spark, name, number):
    one = spark.createDataFrame([(name,)], "name string")
    assert one.select(batch_number(F.col("name"))).first()[0] == number


def test_next_batch(spark, tmp_path):
    folder, done = str(tmp_path / "in"), str(tmp_path / "done")
    for number in (2, 10, 3):
        spark.range(1).coalesce(1).write.parquet(f"{folder}/Training_data_{number}.parquet")

    def following():
        row = next_batch(list_batches(spark, folder), read_processed(spark, done)).first()
        return row and (row["batch_id"], row["path"].rsplit("/", 1)[1])

    for number in (2, 3, 10):
        assert following() == (number, f"Training_data_{number}.parquet")
        assert following() == (number, f"Training_data_{number}.parquet")
        found = next_batch(list_batches(spark, folder), read_processed(spark, done)).first()
        mark_processed(spark, done, number, found["modified"], "accepted")
    assert following() is None
    spark.range(1).write.parquet(f"{folder}/Training_data_11.parquet")
    assert following() == (11, "Training_data_11.parquet")


def test_numbered_skips_other_files(spark):
    files = spark.createDataFrame([("a/T_1.parquet",), ("a/readme.txt",)], "path string")
    assert rows(numbered(files)) == [(1, "a/T_1.parquet")]


def test_jdbc_options():
    database = Database("jdbc:x://h/db", "x.Driver", "me", "hidden")
    assert database.options("t") == {"url": "jdbc:x://h/db", "driver": "x.Driver", "dbtable": "t",
                                     "user": "me", "password": "hidden"}
    assert "hidden" not in repr(database)
    assert ReadSplit("id", "0", "9", 4).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}


def test_jdbc_writer_and_split_reader_pass_their_options(monkeypatch):
    calls = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda *a, **k: calls.append((a, k)))
    database = Database("jdbc:x://h/db", "x.Driver", "me", "hidden")
    jdbc.warehouse_writer(database, connections=8)("rows", "fact_orders")
    assert calls == [(("rows", database, "fact_orders", "append"), {"connections": 8})]


def test_object_store_options():
    options = object_store_options("http://store:9000", "a", "b")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert options["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "a").startswith(named) and scratch_path(spark, "a") != scratch_path(spark, "a")
    settled = settle(values(spark, ["x"]))
    assert rows(settled) == [("x",)]
