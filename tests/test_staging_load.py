"""The load of all nine delivered files, and the warehouse built on it."""

import csv

import pytest

from quaystar.plans.staging import MANIFEST, StagingLoad
from quaystar.plans.warehouse import STEPS, Warehouse, staged
from quaystar.schema import SOURCES
from quaystar.sources.tables import TableStore

DELIVERED = {
    "customers": [["c1", "u1", "01000", "sao paulo", "SP"], ["c2", "u2", "80000", "curitiba", "PR"]],
    "geolocation": [["01000", "-23.5", "-46.6", "sao paulo", "SP"], ["01000", "-23.7", "-46.8", "SP city", "SP"]],
    "orders": [
        ["o1", "c1", "delivered", "2018-01-02 10:00:00", "", "", "2018-01-20 01:00:00", "2018-01-15 00:00:00"],
        ["o2", "c2", "shipped", "2018-02-03 23:59:00", "nan", "", "", "2018-02-20 00:00:00"],
    ],
    "order_items": [
        ["o1", "1", "p1", "s1", "2018-01-05 00:00:00", "100.00", "10.50"],
        ["o1", "2", "p2", "s1", "2018-01-05 00:00:00", "50.00", "5.00"],
        ["o2", "1", "p2", "s1", "2018-02-05 00:00:00", "50.00", "5.25"],
    ],
    "order_payments": [["o1", "1", "credit_card", "3", "165.50"], ["o2", "1", "boleto", "1", "55.25"]],
    "order_reviews": [
        ["r1", "o1", "5", "", 'good,\nvery "good"  ', "2018-01-21 00:00:00", "2018-01-23 12:00:00"],
        ["r2", "o2", "2", "", "", "2018-02-21 00:00:00", ""],
    ],
    "products": [["p1", "moveis", "10", "20", "1", "12000", "60", "40", "30"], ["p2", "", "5", "", "", "", "", "", ""]],
    "sellers": [["s1", "02000", "campinas", "SP"]],
    "category_translation": [["moveis", "furniture"]],
}


def deliver(folder, table, values):
    source = SOURCES[table]
    with open(folder / source.files.replace("*", "shop"), "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.writer(file)
        writer.writerow([column.name for column in source.columns])
        writer.writerows(values)


@pytest.fixture(scope="module")
def delivery(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivered")
    for table, values in DELIVERED.items():
        deliver(folder, table, values)
    return folder


@pytest.fixture(scope="module")
def first_load(spark, tmp_path_factory, delivery):
    load = StagingLoad(spark, TableStore(spark, str(tmp_path_factory.mktemp("store"))), str(delivery))
    return load, load.load_all()


def test_first_load(first_load):
    first = {done.table: done for done in first_load[1]}
    assert set(first) == set(SOURCES)
    assert all((done.duplicates, done.errors) == (0, 0) for done in first.values())
    assert {name: done.loaded for name, done in first.items()} == {name: len(v) for name, v in DELIVERED.items()}


def test_warehouse_on_delivered_files(spark, first_load):
    store = first_load[0].store
    warehouse = Warehouse(spark, store, staged(store))
    log = TableStore(spark, f"{store.root}/log")
    assert warehouse.load(log=log) == {step.table: "built" for step in STEPS}
    assert store.exists("fact_orders_quarantine") and store.row_count("fact_orders_quarantine") == 0
    assert [(row.etl_run_id, row.status) for row in log.read("etl_run_log").collect()] == [(1, "SUCCESS")]
    assert log.read("etl_validation_result").count() == 6
    second = warehouse.load()
    assert second.pop("agg_monthly_sales") == "built" and set(second.values()) == {"skipped"}

    orders = {row.order_id: row for row in store.read("fact_orders").collect()}
    assert orders["o1"].days_to_delivery == 18 and orders["o1"].is_delayed == 1
    assert orders["o2"].days_to_delivery is None and orders["o2"].is_delayed == 0
    assert str(orders["o1"].total_order_value) == "165.50"
    products = {row.product_id: row for row in store.read("dim_product").collect()}
    assert (products["p1"].category_name_en, products["p1"].size_class, products["p1"].is_heavy) == ("furniture", "Large", 1)
    assert (products["p2"].category_name_en, products["p2"].size_class, products["p2"].is_heavy) == (None, "Small", 0)
    reviews = {row.order_id: row for row in store.read("fact_reviews").collect()}
    assert (reviews["o1"].review_comment_length, reviews["o1"].has_comment, reviews["o1"].days_to_answer) == (17, 1, 2)
    assert (reviews["o2"].review_comment_length, reviews["o2"].has_comment) == (0, 0)
    places = store.read("dim_geolocation").first()
    assert (str(places.latitude), places.city) == ("-23.600000", "SP city")
    categories = {row.category_name_en for row in store.read("agg_monthly_sales").collect()}
    assert categories == {"furniture", "Unknown"}
    assert all(row.created_at for row in store.read("fact_payments").collect())


def test_resume_and_reload(rows, delivery, first_load):
    load = first_load[0]
    store = load.store
    assert load.load_all() == []
    assert rows(store.read("order_reviews"), "review_comment_message")[0] == ('good,\nvery "good"  ',)

    # A duplicate, an orphan and a bad amount: the good rows are stored, but the load is not recorded.
    payments = [*DELIVERED["order_payments"], ["o2", "2", "voucher", "1", "2.00"]]
    deliver(
        delivery,
        "order_payments",
        [*payments, payments[0], ["o9", "1", "boleto", "1", "1.00"], ["o1", "2", "boleto", "1", "much"]],
    )
    again = load.load_all(reload=["order_payments"])
    assert [(done.table, done.loaded, done.duplicates, done.errors) for done in again] == [("order_payments", 3, 1, 2)]
    assert rows(store.read("order_payments__rejects"), "order_id", "_errors") == [
        ("o1", "payment_value"),
        ("o9", "order_id"),
    ]
    assert ("order_payments", 2) in rows(store.read(MANIFEST))
    assert [done.table for done in load.load_all()] == ["order_payments"]


def test_an_orphan_does_not_displace_a_good_row(spark, rows, tmp_path, tmp_path_factory):
    for table, values in DELIVERED.items():
        deliver(tmp_path, table, values)
    review = DELIVERED["order_reviews"][0]
    deliver(tmp_path, "order_reviews", [["r1", "gone", *review[2:]], review, ["r2", "o2", *review[2:]]])
    load = StagingLoad(spark, TableStore(spark, str(tmp_path_factory.mktemp("store"))), str(tmp_path))
    done = {one.table: one for one in load.load_all()}["order_reviews"]
    assert (done.loaded, done.duplicates, done.errors) == (2, 0, 1)
    assert rows(load.store.read("order_reviews"), "review_id", "order_id") == [("r1", "o1"), ("r2", "o2")]


def test_a_failed_table_does_not_stop_the_others(spark, rows, tmp_path, tmp_path_factory):
    for table, values in DELIVERED.items():
        if table != "geolocation":
            deliver(tmp_path, table, values)
    place = [["01000", "NaN", "-46.6", "sao paulo", "SP"], ["01000", "Infinity", "1", "x", "SP"], ["01000", "-23.5", "-46.6", "y", "SP"]]
    load = StagingLoad(spark, TableStore(spark, str(tmp_path_factory.mktemp("store"))), str(tmp_path))
    done = {one.table: one for one in load.load_all()}
    assert set(done) == set(SOURCES) and [name for name, one in done.items() if one.failure] == ["geolocation"]
    assert "PATH_NOT_FOUND" in done["geolocation"].failure
    deliver(tmp_path, "geolocation", place)
    again = load.load_all()
    assert [(one.table, one.loaded, one.errors, one.failure) for one in again] == [("geolocation", 1, 2, None)]


def test_keys_survive_a_load_that_fails_half_way(spark, tmp_path, tmp_path_factory, monkeypatch):
    for table, values in DELIVERED.items():
        deliver(tmp_path, table, values)
    store = TableStore(spark, str(tmp_path_factory.mktemp("store")))
    staging = StagingLoad(spark, store, str(tmp_path))
    staging.load_all()
    warehouse = Warehouse(spark, store, staged(store))
    warehouse.load()

    def customer_of():
        joined = warehouse.table("fact_orders").join(warehouse.table("dim_customer"), "customer_key")
        return {row.order_id: row.customer_id for row in joined.collect()}

    assert customer_of() == {"o1": "c1", "o2": "c2"}
    added = [[f"n{k}", f"v{k}", "01000", "sao paulo", "SP"] for k in range(40)]
    deliver(tmp_path, "customers", DELIVERED["customers"] + added)
    staging.load_all(reload=["customers"])
    real = warehouse.build

    def failing(name):
        if name == "fact_order_items":
            raise RuntimeError("lost")
        return real(name)

    monkeypatch.setattr(warehouse, "build", failing)
    with pytest.raises(RuntimeError):
        warehouse.load(force=True)
    monkeypatch.undo()
    warehouse.load()
    assert customer_of() == {"o1": "c1", "o2": "c2"}
    keys = [row.customer_key for row in warehouse.table("dim_customer").collect()]
    assert sorted(keys) == list(range(1, 43))
