"""Reports over the stored warehouse tables. Ties are broken by the business key, so every report has one result.

Reports that join order lines with reviews repeat a line for each review of its order (and seller or product). That
fan-out is part of their figures; it is computed from counts per join key, and never as pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystar.functions.columns import MONEY, flag, mean, money_sum, percent, ratio
from quaystar.operators.numbering import ntile_over_all
from quaystar.session import shared_folder

MEAN = "decimal(10,2)"
SCORE = "decimal(3,2)"


def _amount() -> Column:
    return F.coalesce("total_item_value", F.lit(0)) + F.coalesce("freight_value", F.lit(0))


def monthly_category(agg_monthly_sales: DataFrame, rows: int = 50) -> DataFrame:
    """Monthly sales by category. `total_orders` adds the orders of each seller, so a shared order counts repeatedly."""
    return (
        agg_monthly_sales.groupBy("year", "month", "category_name_en")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_items").alias("total_items"),
            money_sum(F.col("total_revenue")).alias("total_revenue"),
            ratio(F.sum("total_revenue"), F.sum("total_orders"), MONEY).alias("avg_order_value"),
            F.sum("orders_delayed").alias("delayed_orders"),
        )
        .orderBy("year", "month", F.desc("total_revenue"), "category_name_en")
        .limit(rows)
    )


def delay_by_region(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Delivery delays by customer region. Orders are summed per customer first; the join then sees customers only."""
    per_customer = fact_orders.groupBy("customer_key").agg(
        F.count("*").alias("orders"),
        F.sum("is_delayed").alias("delayed"),
        F.sum("days_to_delivery").alias("days"),
        F.count("days_to_delivery").alias("timed"),
        F.sum("total_order_value").alias("value"),
    )
    return (
        per_customer.join(dim_customer.select("customer_key", "region_name"), "customer_key")
        .groupBy("region_name")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("delayed").alias("delayed_orders"),
            percent(F.sum("delayed"), F.sum("orders")).alias("delayed_percent"),
            ratio(F.sum("days"), F.sum("timed"), MEAN).alias("avg_days_to_delivery"),
            money_sum(F.col("value")).alias("total_revenue"),
        )
        .orderBy(F.desc("delayed_percent"), F.desc("total_orders"), "region_name")
    )


def _lines_and_reviews(fact_items: DataFrame, fact_reviews: DataFrame, key: str) -> DataFrame:
    """Lines per (order, key) with the repeats and scores the left join with reviews would give them."""
    lines = fact_items.groupBy("order_id", key).agg(
        F.count("*").alias("lines"),
        F.sum(_amount()).alias("amount"),
        F.sum("total_item_value").alias("item_value"),
        F.sum("freight_value").alias("freight"),
    )
    reviews = fact_reviews.groupBy("order_id", key).agg(
        F.count("*").alias("reviews"), F.sum("review_score").alias("score"), F.count("review_score").alias("scored")
    )
    repeats = F.greatest(F.coalesce("reviews", F.lit(0)), F.lit(1))
    return lines.join(reviews, ["order_id", key], "left").select(
        "order_id",
        key,
        (F.col("lines") * repeats).alias("joined_rows"),
        (F.col("amount") * repeats).alias("amount"),
        (F.col("item_value") * repeats).alias("item_value"),
        (F.col("freight") * repeats).alias("freight"),
        (F.col("score") * F.col("lines")).alias("score"),
        (F.col("scored") * F.col("lines")).alias("scored"),
    )


def seller_rank(fact_items: DataFrame, dim_seller: DataFrame, fact_reviews: DataFrame, rows: int = 20) -> DataFrame:
    """Sellers by revenue. The rank is taken over the rows kept: whoever outranks one of them is among them."""
    sellers = dim_seller.select("seller_key", "seller_id", "seller_city", "seller_state", "region_name")
    top = (
        _lines_and_reviews(fact_items, fact_reviews, "seller_key")
        .groupBy("seller_key")
        .agg(
            F.count("*").alias("total_orders"),
            money_sum(F.col("amount")).alias("total_revenue"),
            ratio(F.sum("score"), F.sum("scored"), SCORE).alias("avg_review_score"),
        )
        .join(sellers, "seller_key")
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(rows)
    )
    rank = F.rank().over(Window.orderBy(F.desc("total_revenue")))
    return top.select(
        rank.alias("revenue_rank"),
        "seller_id",
        "seller_city",
        "seller_state",
        "region_name",
        "total_orders",
        "total_revenue",
        "avg_review_score",
    ).orderBy("revenue_rank", "seller_id")


def payment_methods(fact_payments: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    per_type = fact_payments.groupBy("payment_type_key").agg(
        F.count("*").alias("payment_records"),
        F.countDistinct("order_id").alias("paid_orders"),
        money_sum(F.col("payment_value")).alias("total_payment_value"),
        mean(F.col("payment_value"), MEAN).alias("avg_payment_value"),
        mean(F.col("payment_installments"), MEAN).alias("avg_installments"),
    )
    # Codes, names and categories of payment types are unique together, so one key is one group of the report.
    names = dim_payment_type.select("payment_type_key", "payment_type_name", "payment_category")
    return (
        per_type.join(F.broadcast(names), "payment_type_key")
        .drop("payment_type_key")
        .orderBy(F.desc("total_payment_value"), "payment_type_name")
    )


def category_quality(
    fact_items: DataFrame, dim_product: DataFrame, fact_reviews: DataFrame, min_orders: int = 20, rows: int = 30
) -> DataFrame:
    """Revenue, freight, rating and share of heavy products per category; products without category form one group."""
    joined = _lines_and_reviews(fact_items, fact_reviews, "product_key").join(
        dim_product.select("product_key", "category_name_en", "is_heavy"), "product_key"
    )
    # One row per order first: the distinct orders of a category are then a plain count.
    per_order = joined.groupBy("category_name_en", "order_id").agg(
        F.sum("item_value").alias("item_value"),
        F.sum("freight").alias("freight"),
        F.sum("score").alias("score"),
        F.sum("scored").alias("scored"),
        F.sum("joined_rows").alias("joined_rows"),
        F.sum(F.col("joined_rows") * F.col("is_heavy")).alias("heavy_rows"),
    )
    return (
        per_order.groupBy("category_name_en")
        .agg(
            F.count("*").alias("total_orders"),
            money_sum(F.col("item_value")).alias("product_revenue"),
            money_sum(F.col("freight")).alias("freight_revenue"),
            ratio(F.sum("score"), F.sum("scored"), SCORE).alias("avg_review_score"),
            percent(F.sum("heavy_rows"), F.sum("joined_rows")).alias("heavy_products_percent"),
        )
        .where(F.col("total_orders") >= min_orders)
        .orderBy(F.desc("product_revenue"), "category_name_en")
        .limit(rows)
    )


def month_over_month(fact_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue against the previous month present. The window runs over calendar months, so it stays small."""
    per_day = fact_orders.groupBy("order_date_key").agg(
        F.count("*").alias("orders"), F.sum("total_order_value").alias("value")
    )
    months = F.broadcast(dim_date.select(F.col("date_key").alias("order_date_key"), "year", "month_of_year"))
    monthly = (
        per_day.join(months, "order_date_key")
        .groupBy("year", "month_of_year")
        .agg(F.sum("orders").alias("total_orders"), money_sum(F.col("value")).alias("monthly_revenue"))
    )
    previous = F.lag("monthly_revenue").over(Window.orderBy("year", "month_of_year"))
    gain = F.col("monthly_revenue") - F.col("previous_month_revenue")
    return (
        monthly.withColumn("previous_month_revenue", previous)
        .withColumn("revenue_mom_percent", percent(gain, F.col("previous_month_revenue"), MONEY))
        .orderBy("year", "month_of_year")
    )


def category_share(fact_items: DataFrame, dim_product: DataFrame, rows: int = 30) -> DataFrame:
    """Share and running share of the categories. Rank and running sum of the first rows need the first rows only."""
    category = F.coalesce("category_name_en", F.lit("Unknown")).alias("category_name_en")
    per_order = (
        fact_items.join(dim_product.select("product_key", category), "product_key")
        .groupBy("category_name_en", "order_id")
        .agg(F.sum(_amount()).alias("amount"))
    )
    revenue = per_order.groupBy("category_name_en").agg(
        F.count("*").alias("total_orders"), money_sum(F.col("amount")).alias("total_revenue")
    )
    by_revenue = Window.orderBy(F.desc("total_revenue"), "category_name_en")
    running = F.sum("total_revenue").over(by_revenue.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The whole is that of the categories: lines of products without a row have no share.
    whole = revenue.agg(F.sum("total_revenue").cast(MONEY)).scalar()
    return (
        revenue.orderBy(F.desc("total_revenue"), "category_name_en")
        .limit(rows)
        .select(
            F.rank().over(Window.orderBy(F.desc("total_revenue"))).alias("category_rank"),
            "category_name_en",
            "total_orders",
            "total_revenue",
            running.alias("_running"),
        )
        .select(
            "category_rank",
            "category_name_en",
            "total_orders",
            "total_revenue",
            percent(F.col("total_revenue"), whole, "decimal(10,2)").alias("revenue_share_percent"),
            percent(F.col("_running"), whole, "decimal(10,2)").alias("cumulative_revenue_share_percent"),
        )
        .orderBy("category_rank", "category_name_en")
    )


def customer_quartiles(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Spending and order-count quartile of each customer with orders."""
    shared_folder(fact_orders.sparkSession)
    spent = fact_orders.groupBy("customer_key").agg(
        F.countDistinct("order_id").alias("orders_count"), money_sum(F.col("total_order_value")).alias("total_spent")
    )
    customers = dim_customer.select("customer_key", "customer_id", "region_name")
    metrics = spent.join(customers, "customer_key").drop("customer_key").checkpoint()
    count = metrics.count()
    by_money = ntile_over_all(metrics, ["total_spent", "customer_id"], 4, "monetary_quartile", count)
    return ntile_over_all(by_money, ["orders_count", "customer_id"], 4, "frequency_quartile", count)


def customer_segments(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    money, frequency = F.col("monetary_quartile"), F.col("frequency_quartile")
    segment = (
        F.when((money == 4) & (frequency >= 3), "High value").when(money >= 3, "Medium value").otherwise("Low value")
    )
    return (
        customer_quartiles(fact_orders, dim_customer)
        .groupBy(segment.alias("customer_segment"), "region_name")
        .agg(
            F.count("*").alias("customers_count"),
            mean(F.col("orders_count"), MEAN).alias("avg_orders_count"),
            mean(F.col("total_spent"), MONEY).alias("avg_total_spent"),
            money_sum(F.col("total_spent")).alias("segment_revenue"),
        )
        .orderBy(F.desc("segment_revenue"), "customer_segment", "region_name")
    )


def delay_vs_rating(fact_orders: DataFrame, fact_reviews: DataFrame) -> DataFrame:
    """Ratings of delayed and other orders. An order with several reviews counts its value and days once per review."""
    reviews = fact_reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"), F.sum("review_score").alias("score"), F.count("review_score").alias("scored")
    )
    repeats = F.greatest(F.coalesce("reviews", F.lit(0)), F.lit(1))
    days, status = F.col("days_to_delivery"), F.when(F.col("is_delayed") == 1, "Delayed").otherwise("On time / no delay")
    return (
        fact_orders.select("order_id", "is_delayed", "days_to_delivery", "total_order_value")
        .join(reviews, "order_id", "left")
        .groupBy(status.alias("delivery_status"))
        .agg(
            F.count("*").alias("orders_count"),
            ratio(F.sum(days * repeats), F.sum(flag(days.isNotNull()) * repeats), MEAN).alias("avg_days_to_delivery"),
            ratio(F.sum("score"), F.sum("scored"), SCORE).alias("avg_review_score"),
            money_sum(F.col("total_order_value") * repeats).alias("total_revenue"),
        )
        .orderBy("delivery_status")
    )


def top_orders_pln(orders_pln: DataFrame, rows: int = 20) -> DataFrame:
    return (
        orders_pln.orderBy(F.desc("total_order_value_pln"), "order_id")
        .limit(rows)
        .select(
            "order_id",
            "total_order_value_brl",
            "brl_to_pln_rate",
            "total_order_value_pln",
            "exchange_rate_date",
        )
    )
