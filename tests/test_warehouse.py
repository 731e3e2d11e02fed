"""The warehouse over the order-processing tables at the smallest scale."""

import pytest
from pyspark.sql import functions as F

from quaystar.operators import facts
from quaystar.plans import reports, validation
from quaystar.plans.catalogue import DELTA_FROM, OrderWarehouse
from quaystar.plans.delta import load_delta
from quaystar.plans.warehouse import STEPS
from quaystar.schema import TABLES
from quaystar.sources.tables import TableStore

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    built = OrderWarehouse(spark, FOLDER, str(tmp_path_factory.mktemp("warehouse")))
    built.load()
    return built


def test_schemas_are_as_declared(warehouse):
    for step in STEPS:
        declared = [(f.name, f.dataType) for f in TABLES[step.table].schema()]
        assert [(f.name, f.dataType) for f in warehouse.table(step.table).schema] == declared, step.table


def test_surrogate_keys_are_dense(warehouse):
    for step in STEPS:
        key = TABLES[step.table].identity
        if key:
            found = warehouse.table(step.table).agg(F.min(key), F.max(key), F.countDistinct(key), F.count("*")).first()
            assert found[0] == 1 and found[1] == found[2] == found[3], step.table


def test_invariants(warehouse, rows):
    table = warehouse.table
    assert rows(validation.duplicate_keys(table)) == []
    assert rows(validation.missing_keys(table)) == [(0, 0, 0, 0)]
    assert rows(validation.orphan_customers(table)) == [(0,)]
    assert rows(validation.orphan_products(table)) == [(0,)]
    assert rows(validation.facts_nonempty(table)) == [("OK", "OK", "OK")]
    # The aggregate holds the lines of orders with an order fact; the others make up the difference.
    unmatched = table("fact_order_items").join(table("fact_orders"), "order_id", "left_anti")
    lost = unmatched.agg(F.sum(F.col("total_item_value") + F.col("freight_value"))).first()[0]
    assert validation.revenue_reconciliation(table).first().difference == lost


def test_orders_are_whole(warehouse):
    """Each order inside the calendar with a known status is either a fact or in quarantine."""
    table = warehouse.table
    known = table("orders").join(table("dim_order_status").select(F.col("status_code").alias("order_status")), "order_status")
    inside = known.where(F.year("order_purchase_timestamp").between(2015, 2020)).count()
    names = ("orders", "order_items", "dim_customer", "dim_order_status", "dim_date")
    aside = facts.fact_orders_quarantine(*[table(name) for name in names])
    assert table("fact_orders").count() + aside.count() == inside
    assert aside.count() > 0


def test_delta_twice(spark, warehouse, rows, tmp_path):
    """The first delta brings the facts to those of a full load, the second adds nothing."""
    table = warehouse.table
    target = OrderWarehouse(spark, FOLDER, str(tmp_path))
    old = F.col("order_date_key") < DELTA_FROM
    for name in ("fact_orders", "fact_order_items"):
        target.store.replace(name, table(name).where(old))
    before = {name: target.store.row_count(name) for name in ("fact_orders", "fact_order_items")}
    assert load_delta(target) == {name: table(name).count() - loaded for name, loaded in before.items()}
    assert load_delta(target) == {"fact_orders": 0, "fact_order_items": 0}
    assert rows(target.table("agg_monthly_sales")) == rows(table("agg_monthly_sales"))
    for name in before:
        columns = TABLES[name].insert_list()
        assert rows(target.table(name), *columns) == rows(table(name), *columns)
        key = TABLES[name].identity
        kept = {tuple(r) for r in table(name).where(old).select(key, "order_id").collect()}
        assert kept <= {tuple(r) for r in target.table(name).select(key, "order_id").collect()}
    keys = target.table("fact_orders").agg(F.countDistinct("order_key"), F.count("*")).first()
    assert keys[0] == keys[1]


def test_delta_leaves_other_months_alone(spark, warehouse, rows, tmp_path):
    target = OrderWarehouse(spark, FOLDER, str(tmp_path))
    for step in STEPS[:-1]:
        old = F.col("order_date_key") < DELTA_FROM if step.table in ("fact_orders", "fact_order_items") else F.lit(True)
        target.store.replace(step.table, warehouse.table(step.table).where(old))
    target.build("agg_monthly_sales")
    before = {part.slice: part for part in target.store.parts("agg_monthly_sales")}
    assert target.refresh_sales() == []
    load_delta(target)
    after = {part.slice: part for part in target.store.parts("agg_monthly_sales")}
    assert rows(target.table("agg_monthly_sales")) == rows(warehouse.table("agg_monthly_sales"))
    assert min(set(after) - set(before)) == str(DELTA_FROM // 100)
    assert all(after[month] == part for month, part in before.items())
    # A late review renews the month of its order, however old.
    order = target.table("fact_orders").join(target.table("fact_order_items"), "order_id", "left_semi").orderBy("order_id").first()
    reviews = target.table("fact_reviews")
    late = reviews.limit(1).withColumn("order_id", F.lit(order.order_id)).withColumn("review_score", F.lit(1))
    target.store.append("fact_reviews", late)
    month = str(order.order_date_key // 100)
    assert target.refresh_sales() == [month]
    renewed = {part.slice: part for part in target.store.parts("agg_monthly_sales")}
    assert {name for name in after if renewed[name] != after[name]} == {month}
    in_parts = rows(target.table("agg_monthly_sales"))
    # A table that was replaced makes the whole aggregate new; the result is the same.
    target.store.replace("fact_reviews", target.table("fact_reviews"))
    assert target.refresh_sales() is None
    assert rows(target.table("agg_monthly_sales")) == in_parts


def test_failed_load_changes_nothing(spark, warehouse, tmp_path):
    """The load dies in a task, at the last fact; no reader sees its dimensions."""
    target = OrderWarehouse(spark, FOLDER, str(tmp_path))
    names = ("dim_date", "dim_customer", "dim_order_status")
    for name in names:
        target.build(name)
    before = {name: target.store.parts(name) for name in names}
    payments = target.staging["order_payments"]()
    broken = payments.withColumn("payment_value", F.raise_error(F.lit("no value")).cast("decimal(10,2)"))
    target.staging["order_payments"] = lambda: broken
    with pytest.raises(Exception, match="no value"):
        target.load(force=True)
    for seen in (target.store, TableStore(spark, str(tmp_path))):
        assert {name: seen.parts(name) for name in names} == before
        assert not any(seen.exists(step.table) for step in STEPS if step.table not in names)
    target.staging["order_payments"] = lambda: payments
    assert set(target.load().values()) == {"built", "skipped"}
    assert target.store.row_count("fact_orders_quarantine") > 0


def test_audit_runs(spark, warehouse, rows, tmp_path):
    log = TableStore(spark, str(tmp_path))
    assert validation.audit(warehouse.table, log) == 1

    def broken(name):
        found = warehouse.table(name)
        return found.where("customer_key > 5") if name == "dim_customer" else found

    assert validation.audit(broken, log) == 2
    runs = validation.latest_runs(log.read("etl_run_log")).collect()
    assert [(run.etl_run_id, run.status) for run in runs] == [(2, "FINISHED_WITH_ERRORS"), (1, "SUCCESS")]
    assert all(run.finished_at and run.started_at for run in runs)
    results = validation.results_of_run(log.read("etl_validation_result"), 2).collect()
    assert [r.validation_result_id for r in results] == list(range(7, 13))
    assert [r.validation_status for r in results] == ["OK", "OK", "OK", "ERROR", "OK", "OK"]


def test_views_answer_sql(spark, warehouse, rows):
    warehouse.exchange_rates()
    warehouse.register_views()
    by_view = spark.sql("""
        SELECT region_name, count(*) AS total_orders, sum(is_delayed) AS delayed_orders
        FROM fact_orders f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY region_name""")
    report = reports.delay_by_region(warehouse.table("fact_orders"), warehouse.table("dim_customer"))
    assert rows(by_view) == rows(report, "region_name", "total_orders", "delayed_orders")
    assert spark.sql("SELECT * FROM vw_fact_orders_pln").count() == warehouse.store.row_count("fact_orders")
