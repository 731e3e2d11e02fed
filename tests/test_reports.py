"""Reports that repeat lines per review, against the joins they stand for."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quaystar.plans import reports

ITEMS = (
    "order_id string, product_key bigint, seller_key bigint, total_item_value decimal(10,2), freight_value decimal(10,2)"
)


@pytest.fixture(scope="module")
def tables(spark):
    """A third of the lines and reviews belong to one order; some amounts are missing."""
    chance = random.Random(21)

    def order():
        return "hot" if chance.random() < 0.33 else f"o{chance.randrange(60)}"

    def amount(none):
        return None if chance.random() < none else Decimal(chance.randrange(1, 99999)).scaleb(-2)

    items = [(order(), chance.randrange(12), chance.randrange(6), amount(0.1), amount(0.2)) for _ in range(900)]
    reviews = [(order(), chance.randrange(12), chance.randrange(6), chance.randrange(1, 6)) for _ in range(200)]
    ids = sorted({row[0] for row in items})
    orders = [
        (i, chance.randrange(2), chance.choice([None, 3, 9]), Decimal(chance.randrange(1, 9999))) for i in ids
    ]
    sellers = [(k, f"s{k}", f"city{k}", "SP", "Southeast") for k in range(6)]
    products = [(k, chance.choice(["a", "b", None]), k % 2) for k in range(12)]
    found = {
        "items": spark.createDataFrame(items, ITEMS),
        "reviews": spark.createDataFrame(
            reviews, "order_id string, product_key bigint, seller_key bigint, review_score int"
        ),
        "orders": spark.createDataFrame(
            orders, "order_id string, is_delayed int, days_to_delivery int, total_order_value decimal(20,2)"
        ),
        "sellers": spark.createDataFrame(
            sellers,
            "seller_key bigint, seller_id string, seller_city string, seller_state string, region_name string",
        ),
        "products": spark.createDataFrame(products, "product_key bigint, category_name_en string, is_heavy int"),
    }
    for name, frame in found.items():
        frame.createOrReplaceTempView(f"r_{name}")
    return found


def test_seller_rank(spark, tables, rows):
    joined = spark.sql("""
        SELECT rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank, * FROM (
            SELECT seller_id, seller_city, seller_state, region_name, count(DISTINCT i.order_id) AS total_orders,
                   CAST(sum(coalesce(total_item_value, 0) + coalesce(freight_value, 0)) AS DECIMAL(20,2)) AS total_revenue,
                   CAST(CAST(avg(CAST(review_score AS DECIMAL(5,2))) AS DECIMAL(38,6)) AS DECIMAL(3,2)) AS avg_review_score
            FROM r_items i JOIN r_sellers s ON i.seller_key = s.seller_key
                 LEFT JOIN r_reviews r ON i.order_id = r.order_id AND i.seller_key = r.seller_key
            GROUP BY ALL) ORDER BY revenue_rank, seller_id LIMIT 4""")
    assert rows(reports.seller_rank(tables["items"], tables["sellers"], tables["reviews"], 4)) == rows(joined)


def test_category_quality(spark, tables, rows):
    joined = spark.sql("""
        SELECT category_name_en, count(DISTINCT i.order_id) AS total_orders,
               CAST(sum(total_item_value) AS DECIMAL(20,2)) AS product_revenue,
               CAST(sum(freight_value) AS DECIMAL(20,2)) AS freight_revenue,
               CAST(CAST(avg(CAST(review_score AS DECIMAL(5,2))) AS DECIMAL(38,6)) AS DECIMAL(3,2)) AS avg_review_score,
               CAST(100.0 * sum(is_heavy) / count(*) AS DECIMAL(5,2)) AS heavy_products_percent
        FROM r_items i JOIN r_products p ON i.product_key = p.product_key
             LEFT JOIN r_reviews r ON i.order_id = r.order_id AND i.product_key = r.product_key
        GROUP BY category_name_en HAVING count(DISTINCT i.order_id) >= 20""")
    assert rows(reports.category_quality(tables["items"], tables["products"], tables["reviews"])) == rows(joined)
    assert joined.where(F.col("category_name_en").isNull()).count() == 1


def test_delay_vs_rating(spark, tables, rows):
    joined = spark.sql("""
        SELECT CASE WHEN is_delayed = 1 THEN 'Delayed' ELSE 'On time / no delay' END AS delivery_status,
               count(DISTINCT o.order_id) AS orders_count,
               CAST(avg(CAST(days_to_delivery AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS avg_days_to_delivery,
               CAST(avg(CAST(review_score AS DECIMAL(5,2))) AS DECIMAL(3,2)) AS avg_review_score,
               CAST(sum(total_order_value) AS DECIMAL(20,2)) AS total_revenue
        FROM r_orders o LEFT JOIN r_reviews r ON o.order_id = r.order_id GROUP BY 1""")
    assert rows(reports.delay_vs_rating(tables["orders"], tables["reviews"])) == rows(joined)


def test_rank_repeats_for_equal_revenue(spark, rows):
    items = spark.createDataFrame(
        [("o1", 1, 1, Decimal(5), None), ("o2", 1, 2, Decimal(5), None), ("o3", 1, 3, Decimal(1), None)], ITEMS
    )
    sellers = spark.createDataFrame(
        [(k, f"s{k}", "c", "SP", "Southeast") for k in (1, 2, 3)],
        "seller_key bigint, seller_id string, seller_city string, seller_state string, region_name string",
    )
    reviews = spark.createDataFrame([], "order_id string, seller_key bigint, review_score int")
    ranked = reports.seller_rank(items, sellers, reviews)
    assert rows(ranked, "revenue_rank", "seller_id", "avg_review_score") == [
        (1, "s1", None),
        (1, "s2", None),
        (3, "s3", None),
    ]


def test_previous_month_is_the_previous_one_present(spark):
    orders = spark.createDataFrame(
        [(20180105, Decimal(100)), (20180107, Decimal(100)), (20180301, Decimal(150)), (20180401, Decimal(0))],
        "order_date_key int, total_order_value decimal(20,2)",
    )
    days = spark.createDataFrame(
        [(20180105, 2018, 1), (20180107, 2018, 1), (20180301, 2018, 3), (20180401, 2018, 4)],
        "date_key int, year int, month_of_year int",
    )
    found = reports.month_over_month(orders, days).select("month_of_year", "total_orders", "revenue_mom_percent")
    assert [(m, n, p if p is None else str(p)) for m, n, p in found.collect()] == [
        (1, 2, None),
        (3, 1, "-25.00"),
        (4, 1, "-100.00"),
    ]
