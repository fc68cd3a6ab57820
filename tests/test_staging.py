from __future__ import annotations

import pytest

from millrace.operators.staging import (hourly_clicks, monthly_trend, new_rows, star_target,
                                        transformed_source)
from millrace.plans.staging_loads import (FolderStaging, JdbcStaging, load_star, load_transformed, stage,
                                          stage_csv)
from millrace.schemas import STAGING_TABLES
from millrace.sources.tables import read_csv, write_csv
from tests.helpers import rows

DDL = "a int, b string"


def frame(spark, *given):
    return spark.createDataFrame(list(given), DDL)


def test_new_rows_equals_subtract(spark):
    raw = frame(spark, (1, "x"), (1, "x"), (2, None), (3, None), (None, None), (4, "y"), (4, "z"))
    staged = frame(spark, (2, None), (4, "y"), (None, None), (9, "gone"))
    expected = rows(raw.subtract(staged))
    assert rows(new_rows(raw, staged)) == expected
    assert expected == sorted([(1, "x"), (3, None), (4, "z")], key=repr)
    # By position, whatever the names on the other side.
    assert rows(new_rows(raw, staged.toDF("c", "d"))) == expected


@pytest.mark.parametrize("max_rows", [0, 100])
def test_new_rows_both_ways(spark, max_rows):
    raw = frame(spark, (1, "x"), (1, "x"), (2, None), (None, None), (None, "q"), (4, "z"))
    staged = frame(spark, (2, None), (4, "y"), (None, None), (None, None))
    fresh = new_rows(raw, staged, max_rows=max_rows)
    assert rows(fresh) == sorted([(1, "x"), (None, "q"), (4, "z")], key=repr)


def test_small_difference_leaves_staged_rows_in_place(spark, tmp_path):
    frame(spark, (1, "x"), (2, "y")).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    plan = new_rows(frame(spark, (1, "x")), staged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "broadcast" in plan


def test_load_adds_changed_rows_and_nothing_twice(spark, tmp_path):
    target = str(tmp_path / "dim_t")
    write = lambda rows, _: rows.write.mode("append").parquet(target)
    loaded = lambda _: spark.read.parquet(target)
    load_star({"t": frame(spark, (1, "old"), (None, "n"))}, write)
    for _ in range(2):
        load_star({"t": frame(spark, (1, "new"), (1, "old"), (2, "a"), (2, "a"), (None, "n"))}, write, loaded)
    assert rows(loaded("")) == sorted([(1, "old"), (None, "n"), (1, "new"), (2, "a")], key=repr)


def test_empty_difference_writes_nothing(spark, tmp_path):
    store = FolderStaging(spark, str(tmp_path))
    stage(frame(spark, (1, "x")), store, "t", "1")
    assert stage(frame(spark, (1, "x")), store, "t", "2").isEmpty()
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["run=1"]


def test_database_staging_wants_a_split(spark):
    with pytest.raises(ValueError):
        JdbcStaging(spark, None, {}).read("users", frame(spark).schema)


def test_new_rows_shares_nothing_with_staged(spark):
    raw = spark.range(5000).selectExpr("CAST(id % 700 AS INT) AS a", "CAST(id % 3 AS STRING) AS b")
    staged = raw.where("a < 300")
    fresh = new_rows(raw, staged)
    assert fresh.intersect(staged).count() == 0
    assert fresh.count() == fresh.distinct().count() == raw.distinct().count() - staged.distinct().count()


@pytest.mark.parametrize("mode, expected", [("append_new", [(1, "x"), (2, "y"), (3, "z")]),
                                            ("replace", [(3, "z")])])
def test_stage_modes(spark, tmp_path, mode, expected):
    store = FolderStaging(spark, str(tmp_path))
    stage(frame(spark, (1, "x"), (2, "y")), store, "t", "1", mode)
    fresh = stage(frame(spark, (2, "y"), (3, "z"), (3, "z")), store, "t", "2", mode)
    assert rows(fresh) == [(3, "z")]
    assert rows(store.read("t", fresh.schema, mode)) == expected


@pytest.mark.parametrize("mode", ["append_new", "replace"])
def test_repeated_run_finds_the_same_rows(spark, tmp_path, mode):
    store = FolderStaging(spark, str(tmp_path))
    stage(frame(spark, (1, "x")), store, "t", "1", mode)
    raw = frame(spark, (1, "x"), (2, "y"))
    for _ in range(2):
        assert rows(stage(raw, store, "t", "2", mode)) == [(2, "y")]
    assert store.read("t", raw.schema, mode).count() == (2 if mode == "append_new" else 1)


def test_nothing_new_leaves_staging_alone(spark, tmp_path):
    store = FolderStaging(spark, str(tmp_path))
    given = frame(spark, (1, "x"))
    stage(given, store, "t", "1", "replace")
    assert stage(given, store, "t", "2", "replace").count() == 0
    assert rows(store.read("t", given.schema, "replace")) == [(1, "x")]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        stage(frame(spark), FolderStaging(spark, str(tmp_path)), "t", "1", "upsert")


def test_routes():
    assert {t: star_target(t) for t in ("users", "products", "orders", "clickstream")} == {
        "users": "dim_users", "products": "dim_products",
        "orders": "fact_orders", "clickstream": "fact_clicks"}
    assert star_target("stores") == "dim_stores"
    assert transformed_source("orders") == "Torders"


def test_load_transformed_covers_all_tables():
    calls = []
    load_transformed(lambda source: source, lambda source, target: calls.append((source, target)))
    assert calls == [("Tusers", "dim_users"), ("Tproducts", "dim_products"),
                     ("Torders", "fact_orders"), ("Tclickstream", "fact_clicks")]


FILES = {
    "users": "user_id,name,email,signup_date\nu1,Ann,a@x.org,2024-02-03\n",
    "products": "product_id,product_name,category,price,stock\np1,Big Lamp,Home,12.5,11\n",
    "orders": "order_id,user_id,product_id,quantity,order_date\n"
              "o1,u1,p1,2,2025-01-02\no2,u1,p1,1,2025-02-02\n",
    "clickstream": "click_id,user_id,product_id,timestamp\nc1,u1,p1,2025-01-02 03:04:05.123456\n",
}


@pytest.fixture
def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return folder


def test_csv_types_match_inference(spark, raw_folder):
    for name, schema in STAGING_TABLES.items():
        inferred = read_csv(spark, str(raw_folder / f"{name}.csv"))
        assert [(f.name, f.dataType) for f in inferred.schema] == [(f.name, f.dataType) for f in schema]


def test_csv_to_star(spark, raw_folder, tmp_path):
    store, star = FolderStaging(spark, str(tmp_path / "staging")), tmp_path / "star"
    write = lambda rows, target: rows.write.mode("append").parquet(str(star / target))
    loaded = lambda target: spark.read.parquet(str(star / target))

    first = stage_csv(spark, str(raw_folder), store, "1")
    load_star(first, write)
    load_star(first, write, loaded)
    with (raw_folder / "orders.csv").open("a") as file:
        file.write("o3,u1,p1,5,2025-02-03\n")
    second = stage_csv(spark, str(raw_folder), store, "2")
    assert {name: df.count() for name, df in second.items()} == {
        "users": 0, "products": 0, "orders": 1, "clickstream": 0}
    load_star(second, write, loaded)
    assert {t: loaded(t).count() for t in ("dim_users", "dim_products", "fact_orders", "fact_clicks")} == {
        "dim_users": 1, "dim_products": 1, "fact_orders": 3, "fact_clicks": 1}

    trend = monthly_trend(loaded("fact_orders"), "order_date", loaded("fact_clicks"), "timestamp")
    assert [(str(m), o, c) for m, o, c in rows(trend)] == [("2025-01-01", 1, 1), ("2025-02-01", 2, 0)]
    assert rows(hourly_clicks(loaded("fact_clicks"), "timestamp")) == [(3, 1)]


def test_csv_write_has_a_header(spark, tmp_path):
    given = frame(spark, (1, "x"))
    write_csv(given, str(tmp_path / "t.csv"))
    assert rows(read_csv(spark, str(tmp_path / "t.csv"), given.schema)) == [(1, "x")]
