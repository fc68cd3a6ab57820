from __future__ import annotations

import datetime
import json
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.orders import clean_orders, order_rejects, regions_complete, union_regions
from millrace.plans import regional_orders
from millrace.schemas import CURATED_ORDER, LANDED_ORDER
from millrace.sources.published import PublishedRuns
from millrace.sources.regions import (Region, archive, as_variant, declared_fields, envelope_items,
                                      extract_envelope, land, load_regions, read_archive, read_landing,
                                      undeclared_fields)
from millrace.sources.tables import empty_relation
from tests.helpers import rows, values

GOOD = ("o1", "Lamp", "$12.50", "card", "4", "fine", "1 Road, Town, State, USA ",
        "2025-12-05", "02:03:04")


def landed(spark, *changes):
    given = []
    for number, change in enumerate(changes):
        row = dict(zip(LANDED_ORDER.names, GOOD), **{"order-id": f"o{number}"}, **change)
        given.append(tuple(row[name] for name in LANDED_ORDER.names))
    return spark.createDataFrame(given, LANDED_ORDER)


def test_clean_row(spark):
    cleaned = clean_orders(landed(spark, {}))
    assert [(f.name, f.dataType) for f in cleaned.schema] == [
        (f.name, f.dataType) for f in CURATED_ORDER]
    assert cleaned.first() == (
        "USA", "o0", "Lamp", 12.5, "card", 4, "fine", "1 Road, Town, State, USA ",
        datetime.datetime(2025, 12, 5, 2, 3, 4))


BAD = [{"delivery address": "1 Road, Town, State"}, {"price": "$1,299.00"}, {"price": "$x"},
       {"rating": "n"}, {"date": "some day"}]


def test_bad_values_become_null_and_are_reported(spark):
    orders = landed(spark, {}, *BAD, {"price": None})
    cleaned = clean_orders(orders)
    assert cleaned.count() == 7
    assert rows(cleaned.where("country IS NULL").select("`order-id`")) == [("o1",)]
    assert rows(cleaned.where("price_dollar IS NULL").select("`order-id`")) == [
        ("o2",), ("o3",), ("o6",)]
    assert rows(order_rejects(orders).select("`order-id`", "faults")) == [
        ("o1", "delivery address"), ("o2", "price"), ("o3", "price"), ("o4", "rating"),
        ("o5", "timestamp")]


@pytest.mark.parametrize("change", BAD)
def test_strict_fails(spark, change):
    with pytest.raises(PySparkException):
        clean_orders(landed(spark, change), strict=True).collect()


def test_padded_country_and_float32(spark):
    cleaned = clean_orders(landed(spark, {"delivery address": "a,b,c,   India   ", "price": "$0.1"}))
    assert cleaned.first()["country"] == "India"
    assert cleaned.select(F.col("price_dollar").cast("double")).first()[0] != 0.1


def test_union_starts_from_an_empty_frame(spark):
    one, two = clean_orders(landed(spark, {})), clean_orders(landed(spark, {}, {}))
    assert union_regions([empty_relation(spark, CURATED_ORDER), one, two]).count() == 3


def test_regions_complete(spark):
    orders = spark.createDataFrame([("usa",), ("usa",), ("india",), (None,)], "region string")
    assert regions_complete(orders, "region", ["usa", "india"]).first() == (2, "", 0, True)
    assert regions_complete(orders, "region", ["usa"]).first() == (1, "", 1, True)
    assert regions_complete(orders, "region", ["usa", "mars", "eire"]).first() == (1, "eire,mars", 1, False)
    assert regions_complete(orders.where("false"), "region", ["usa"]).first() == (0, "usa", 0, False)
    assert regions_complete(orders, "region", []).first() == (0, "", 2, True)


def test_envelope(spark):
    payloads = values(spark, ['{"usa-orders":[{"a":"1"},{"a":"2"}]}', '{"usa-orders":[]}',
                              '{"other":[{"a":"3"}]}', "garbage", None])
    assert rows(extract_envelope(payloads, "usa-orders", "a: string")) == [("1",), ("2",)]


@pytest.mark.parametrize("sibling", ["3", "null", '"text"', "true", '{"usa-orders":[{"a":"no"}]}',
                                     "[1,2]", "[[]]", '[{"a":{"b":1}}]'])
def test_envelope_with_siblings_of_any_type(spark, sibling):
    items = '"usa-orders":[{"a":"1","n":{"x":[1,{"y":2}]}},{"a":"2"}]'
    payloads = values(spark, [f'{{"s":{sibling},{items}}}', f'{{{items},"s":{sibling}}}'])
    assert rows(extract_envelope(payloads, "usa-orders", "a: string")) == [
        ("1",), ("1",), ("2",), ("2",)]
    assert [json.loads(r[0]) for r in rows(envelope_items(payloads, "usa-orders"))][0] == {
        "a": "1", "n": {"x": [1, {"y": 2}]}}


def test_landing_reads_an_array_on_one_line(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text(json.dumps([dict(zip(LANDED_ORDER.names, GOOD))] * 3))
    assert read_landing(spark, [str(path)]).count() == 3


def test_archive_replaces_the_same_key_only(spark, tmp_path):
    target = str(tmp_path / "raw")

    def put(run_ts, key, n):
        archive(spark.range(n).select(F.lit(run_ts).alias("run_ts"), F.lit(key).alias("datakey"),
                                      "id"), target)

    put("t1", "usa", 2), put("t1", "india", 3), put("t2", "usa", 1), put("t1", "usa", 1)
    assert rows(read_archive(spark, target, "t1")) == [(0, "india"), (0, "usa"), (1, "india"),
                                                      (2, "india")]


CONFIG = """
endpoint: /{0}
datakey: {0}-orders
s3_storage:
  bucket: shop
  key: {0}_orders.json
table_storage:
  database: dw
  table: orders
  password: unused
"""


@pytest.fixture
def regions(tmp_path):
    folder = tmp_path / "config"
    folder.mkdir()
    for name in ("usa", "india", "canada"):
        (folder / f"{name}_config.yaml").write_text(CONFIG.format(name))
    return load_regions(str(folder))


def payload(spark, key, count):
    order = dict(zip(LANDED_ORDER.names, GOOD))
    return values(spark, [json.dumps({key: [order] * count})])


def test_config(regions):
    assert [r.datakey for r in regions] == ["canada-orders", "india-orders", "usa-orders"]
    assert regions[0] == Region("/canada", "canada-orders", "shop", "canada_orders.json", "dw", "orders")
    assert not any("password" in str(r) for r in regions)


def test_whole_run(spark, tmp_path, regions):
    store, written = str(tmp_path / "store"), []
    payloads = {r.datakey: payload(spark, r.datakey, n + 1) for n, r in enumerate(regions)}

    def write(orders, database, name):
        written.append((database, name, orders.count()))

    assert regional_orders.run(spark, payloads, regions, store, "t1", write)
    assert written == [("dw", "orders", 6)]
    archived = read_archive(spark, regions[0].archive(store), "t1")
    assert rows(archived.groupBy("datakey").count()) == [
        ("canada-orders", 1), ("india-orders", 2), ("usa-orders", 3)]
    strict = regional_orders.transform(spark, regions, store, strict=True)
    assert strict.where("country = 'USA'").count() == 6


def test_missing_region_stops_the_load(spark, tmp_path, regions):
    store, written = str(tmp_path / "store"), []
    payloads = {r.datakey: payload(spark, r.datakey, n) for n, r in enumerate(regions)}
    assert not regional_orders.run(spark, payloads, regions, store, "t1",
                                   lambda *call: written.append(call))
    assert not written


def test_land_replaces(spark, tmp_path):
    target, raw = str(tmp_path / "landing"), F.to_json(F.struct("*")).alias("value")
    land(landed(spark, {}, {}).select(raw), target)
    land(landed(spark, {}).select(raw), target)
    assert read_landing(spark, [target]).count() == 1


def test_absent_landing_folder_is_a_missing_region(spark, tmp_path, regions):
    store = str(tmp_path / "store")
    assert not regional_orders.check_landing(spark, regions, store)
    regional_orders.land_payloads({regions[0].datakey: payload(spark, regions[0].datakey, 2)},
                                  regions[:1], store)
    assert regional_orders.landing_status(spark, regions, store).first() == (
        1, "india-orders,usa-orders", 0, False)
    assert regional_orders.check_landing(spark, regions[:1], store)


def test_archive_keeps_every_field_and_the_keys_as_text(spark, tmp_path):
    regions = [Region("/x", str(n), "shop", f"{n}.json", "dw", "orders") for n in range(2)]
    payloads = {r.datakey: values(spark, [json.dumps({"total": 3, r.datakey: [
        {"order-id": "o1", "coupon": "c", "seller": {"id": 7}}]})]) for r in regions}
    store = str(tmp_path)
    regional_orders.land_payloads(payloads, regions, store)
    regional_orders.archive_landing(spark, regions, store, "t1")
    stored = read_archive(spark, regions[0].archive(store), "t1")
    assert stored.dtypes == [("value", "string"), ("datakey", "string")]
    assert [(json.loads(v), k) for v, k in rows(stored.orderBy("datakey"))] == [
        ({"order-id": "o1", "coupon": "c", "seller": {"id": 7}}, k) for k in ("0", "1")]


def test_declared_fields_of_parsed_items(spark):
    given = ['{"order-id":"o1","price":"$3","rating":4,"date":null,"more":[1,{"a":2}]}',
             '{"order-id":{"n":1},"price":2.5}', " {}", "", "null", "[1]", "no json", '{"price":1,"price":2}', None]
    found = declared_fields(as_variant(values(spark, given)), LANDED_ORDER)
    assert found.columns == LANDED_ORDER.names
    assert Counter(tuple(r) for r in found.select("order-id", "price", "rating", "date").collect()) == Counter(
        [("o1", "$3", "4", None), ('{"n":1}', "2.5", None, None), *[(None,) * 4] * 7])
    unread = as_variant(values(spark, given)).where("item IS NULL").select("unread")
    assert Counter(r[0] for r in unread.collect()) == Counter(["", "null", "[1]", "no json", given[7], None])


def test_undeclared_fields(spark):
    texts = [("a", '{"order-id":"1","price":2,"note":null,"item":1,"by":"x"}'), ("a", '{"note":null,"item":"t"}'),
             ("a", '{"price":"3"}'), ("b", '{"price":null,"deep":{"x":[{"y":true}]}}'), ("b", "{}"), ("b", "[1,2]"),
             (None, '{"new":1.5}'), (None, '{"new":10}')]
    parsed = as_variant(spark.createDataFrame(texts, "by string, value string"))
    assert rows(undeclared_fields(parsed, "by", LANDED_ORDER)) == sorted([
        ("a", "price", "STRING", "VARIANT", 2), ("a", "note", None, "VOID", 2), ("a", "item", None, "VARIANT", 2),
        ("a", "by", None, "STRING", 1), ("b", "deep", None, "OBJECT<x: ARRAY<OBJECT<y: BOOLEAN>>>", 1),
        ("b", None, None, None, 2), (None, "new", None, "DECIMAL(21,1)", 2)], key=repr)
    assert rows(undeclared_fields(parsed.where("false"), "by", LANDED_ORDER)) == []


def test_values_meet_per_task_before_the_shuffle(spark):
    parsed = as_variant(spark.createDataFrame([("a", "{}")], "by string, value string"))
    plan = undeclared_fields(parsed, "by", LANDED_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_schema_of_variant_agg" in plan


def test_parsed_landing_equals_the_text(spark, tmp_path, regions):
    store = str(tmp_path / "store")
    payloads = {r.datakey: payload(spark, r.datakey, n + 1) for n, r in enumerate(regions)}
    regional_orders.land_payloads(payloads, regions, store)
    parsed = regional_orders.parse_landing(spark, regions, store, f"{store}/parsed")
    assert rows(regional_orders.curated(parsed)) == rows(regional_orders.transform(spark, regions, store))
    assert rows(regional_orders.drift(parsed)) == []


def test_a_repeated_run_loads_the_warehouse_once(spark, tmp_path, regions):
    store, root = str(tmp_path / "store"), str(tmp_path / "warehouse")
    payloads = {r.datakey: payload(spark, r.datakey, 2) for r in regions}
    for run_ts in ("t1", "t1", "t2"):
        assert regional_orders.run(spark, payloads, regions, store, run_ts,
                                   regional_orders.warehouse_writer(spark, root, run_ts))
    assert PublishedRuns(spark, f"{root}/dw/orders").read(CURATED_ORDER).count() == 12
