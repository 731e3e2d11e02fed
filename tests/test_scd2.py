from datetime import datetime

from pyspark.sql import functions as F

from quaystar.operators import scd2
from quaystar.plans.history import change_products, load_history
from quaystar.plans.warehouse import Warehouse
from quaystar.sources.tables import TableStore

COLUMNS = (
    "product_id string, category_name_pt string, category_name_en string, product_weight_g decimal(10,2), "
    "product_length_cm decimal(10,2), product_height_cm decimal(10,2), product_width_cm decimal(10,2), size_class string"
)
FIRST, SECOND = datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 2, 1)


def products(spark, *named):
    return spark.createDataFrame([(i, n, n, None, None, None, None, "Small") for i, n in named], COLUMNS)


def versions(frame):
    return sorted(
        ((r.product_id, r.category_name_pt, r.valid_from, r.valid_to, r.is_current) for r in frame.collect()), key=str
    )


def test_changes_close_and_open_versions_once(spark):
    initial = scd2.initial_versions(products(spark, ("a", "x"), ("b", None), ("c", "z")))
    changes = products(spark, ("a", "y"), ("b", ""), ("d", "new"))
    start = scd2.FIRST_VALID_FROM
    expected = [
        ("a", "x", start, datetime(2024, 1, 2, 3, 4, 4), 0),
        ("a", "y", FIRST, None, 1),
        ("b", None, start, None, 1),  # NULL and '' are the same version
        ("c", "z", start, None, 1),  # nothing delivered
        ("d", "new", FIRST, None, 1),
    ]
    applied = scd2.apply_changes(initial, changes, FIRST)
    assert versions(applied) == expected
    assert versions(scd2.apply_changes(applied, changes, SECOND)) == expected
    assert tuple(scd2.version_counts(applied).first()) == (5, 4, 4, 1)
    assert [r.product_id for r in scd2.version_history(applied).collect()] == ["a", "a"]


def test_a_value_that_comes_back_is_a_new_version(spark):
    rows = scd2.initial_versions(products(spark, ("a", "x")))
    rows = scd2.apply_changes(rows, products(spark, ("a", "y")), FIRST)
    rows = scd2.apply_changes(rows, products(spark, ("a", "x")), SECOND)
    assert [(v[1], v[4]) for v in sorted(versions(rows), key=lambda v: v[2])] == [("x", 0), ("y", 0), ("x", 1)]


def test_demonstration_change_takes_the_first_product_not_renamed(spark):
    rows = scd2.initial_versions(products(spark, ("a", "x_SCD_DEMO"), ("b", "_SCD_DEMO"), ("c", "xSCD_DEMO"), ("d", "q")))
    # '_' is a wildcard: any character before SCD_DEMO counts as renamed.
    change = scd2.demo_change(rows).collect()
    assert [(r.product_id, r.category_name_pt, r.category_name_en) for r in change] == [("d", "q_SCD_DEMO", "q SCD Demo")]
    applied = scd2.apply_changes(rows, scd2.demo_change(rows), FIRST)
    assert scd2.demo_change(applied).isEmpty()


def test_update_time_is_set_where_the_version_ended(spark):
    rows = scd2.initial_versions(products(spark, ("a", "x"), ("b", "x")))
    rows = rows.withColumn("updated_at", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    closed = scd2.close_changed(rows, products(spark, ("a", "y"), ("b", "x")), FIRST).collect()
    assert {r.product_id: r.updated_at for r in closed} == {"a": FIRST, "b": datetime(2020, 1, 1)}


def test_stored_history_keeps_its_keys(spark, tmp_path):
    warehouse = Warehouse(spark, TableStore(spark, str(tmp_path)), {})
    warehouse.store.replace("dim_product", products(spark, ("a", "x"), ("b", "x"), ("c", "x")))
    first = {(r.product_id, r.product_scd_key) for r in load_history(warehouse).collect()}
    assert {key for _, key in first} == {1, 2, 3}
    changes = scd2.demo_change(load_history(warehouse))
    changes = spark.createDataFrame(changes.collect(), changes.schema)
    change_products(warehouse, changes, FIRST)
    stored = change_products(warehouse, changes, SECOND)  # known by now
    found = {(r.product_id, r.product_scd_key, r.category_name_pt, r.is_current) for r in stored.collect()}
    assert {(i, k) for i, k, _, _ in found if k < 4} == first
    assert ("a", 4, "x_SCD_DEMO", 1) in found
    assert all(r.created_at and r.updated_at for r in stored.collect())
    assert load_history(warehouse).count() == stored.count()


def test_ended_versions_are_not_written_again(spark, tmp_path):
    warehouse = Warehouse(spark, TableStore(spark, str(tmp_path)), {})
    warehouse.store.replace("dim_product", products(spark, ("a", "x"), ("b", "x"), ("c", "x")))
    ended = []
    for name, time in (("y", FIRST), ("z", SECOND), ("z", datetime(2024, 3, 1))):
        stored = change_products(warehouse, products(spark, ("a", name)), time)
        parts = [part for part in warehouse.store.parts("dim_product_scd2") if part.slice == "ended"]
        assert parts[: len(ended)] == ended
        ended = parts
    assert [part.rows for part in ended] == [1, 1]
    assert [(v[0], v[1], v[4]) for v in sorted(versions(stored), key=lambda v: (v[0], v[2]))] == [
        ("a", "x", 0), ("a", "y", 0), ("a", "z", 1), ("b", "x", 1), ("c", "x", 1)
    ]
    keys = [r.product_scd_key for r in TableStore(spark, str(tmp_path)).read("dim_product_scd2").collect()]
    assert sorted(keys) == [1, 2, 3, 4, 5]
