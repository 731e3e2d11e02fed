"""The monthly aggregate from rows built here: its results, and one shuffle of the lines reduced per order."""

import re

from pyspark.sql import functions as F


def _inputs(spark):
    items = spark.createDataFrame(
        [(1, 10, 7, 20240105, 1, 5.0, 1.0), (1, 10, 7, 20240105, 1, 3.0, None), (2, 11, 7, 20240210, 1, 4.0, 2.0),
         (3, 10, 8, 20240211, 1, 6.0, 0.0), (None, 12, 8, 20240211, 1, 1.0, 1.0)],
        "order_id long, product_key long, seller_key long, order_date_key int, quantity int, total_item_value double,"
        " freight_value double",
    )
    orders = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "order_id long, is_delayed int")
    dates = spark.createDataFrame([(20240105, 2024, 1), (20240210, 2024, 2), (20240211, 2024, 2)], "date_key int, year int, month_of_year int")
    products = spark.createDataFrame([(10, "toys"), (11, None), (12, "toys")], "product_key long, category_name_en string")
    reviews = spark.createDataFrame([(1, 4), (1, 5), (3, 2)], "order_id long, review_score int")
    return items, orders, dates, products, reviews


def test_monthly_sales_values(spark, rows):
    from quaystar.operators.facts import monthly_sales

    found = monthly_sales(*_inputs(spark))
    got = rows(found, "year", "month", "category_name_en", "seller_key", "total_orders", "total_items", "orders_delayed")
    assert got == sorted([(2024, 1, "toys", 7, 1, 2, 1), (2024, 2, "Unknown", 7, 1, 1, 0), (2024, 2, "toys", 8, 1, 1, 0)], key=str)
    revenue = {(r.month, r.category_name_en): float(r.total_revenue) for r in found.collect()}
    assert revenue == {(1, "toys"): 9.0, (2, "Unknown"): 6.0, (2, "toys"): 6.0}


def test_lines_per_order_are_shuffled_once(spark):
    from quaystar.operators.facts import monthly_sales

    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, orders, dates, products, reviews = _inputs(spark)
        plan = monthly_sales(items, orders, F.broadcast(dates), products, reviews)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # Before: once by the grouping keys, then again by order_id for the join.
    assert not [keys for keys in shuffles if "order_id" in keys and "seller_key" in keys], shuffles
