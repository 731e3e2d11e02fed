"""Fact builders. The same builders serve the full load and the delta load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystar.functions.columns import MONEY, date_key, flag, ratio, text_length

OUTSIDE = "outside_calendar"


def _calendar(dim_date: DataFrame, key: str) -> DataFrame:
    # Broadcast is safe: one row per calendar day, fixed by the calendar's range.
    return F.broadcast(dim_date.select(F.col("date_key").alias(key)))


def _orders_of_customers(orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, key: str) -> DataFrame:
    """Order -> customer key and purchase date key, for orders inside the calendar."""
    return (
        orders.select("order_id", "customer_id", date_key(F.col("order_purchase_timestamp")).alias(key))
        .join(_calendar(dim_date, key), key, "left_semi")
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
        .select("order_id", "customer_key", key)
    )


def fact_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """One row per order line. Only the order-line side is large: AQE splits its hot products, sellers and orders."""
    return (
        order_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id")
        .join(_orders_of_customers(orders, dim_customer, dim_date, "order_date_key"), "order_id")
        .select(
            "order_id",
            "order_item_id",
            "customer_key",
            "product_key",
            "seller_key",
            "order_date_key",
            F.lit(1).alias("quantity"),
            "price",
            "freight_value",
            F.col("price").alias("total_item_value"),
            F.lit(0).alias("is_out_of_stock"),
        )
    )


def order_totals(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(
        F.count("*").alias("total_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
    )


def _in_calendar(name: str) -> Column:
    return F.col(name).isNull() | F.col(f"_{name}").isNotNull()


def _order_rows(
    orders: DataFrame, order_items: DataFrame, dim_customer: DataFrame, dim_order_status: DataFrame, dim_date: DataFrame
) -> DataFrame:
    bought, delivered, estimated = (
        F.col("order_purchase_timestamp"),
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    zero = F.lit(0)
    price, freight = (F.coalesce(n, zero).cast(MONEY) for n in ("total_price", "total_freight_value"))
    statuses = F.broadcast(dim_order_status.select(F.col("status_code").alias("order_status"), "order_status_key"))
    days = F.datediff(delivered.cast("date"), bought.cast("date"))
    return (
        orders.withColumn("order_date_key", date_key(bought))
        .withColumn("estimated_delivery_date_key", date_key(estimated))
        .withColumn("actual_delivery_date_key", date_key(delivered))
        .join(_calendar(dim_date, "order_date_key"), "order_date_key", "left_semi")
        .join(statuses, "order_status")
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
        .join(order_totals(order_items), "order_id", "left")
        .select(
            "order_id",
            "customer_key",
            "order_date_key",
            "estimated_delivery_date_key",
            "actual_delivery_date_key",
            "order_status_key",
            F.coalesce("total_items", zero).alias("total_items"),
            price.alias("total_price"),
            freight.alias("total_freight_value"),
            (price + freight).cast(MONEY).alias("total_order_value"),
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            days.alias("days_to_delivery"),
            flag(delivered > estimated).alias("is_delayed"),
        )
    )


def _with_calendar_marks(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    for name in ("estimated_delivery_date_key", "actual_delivery_date_key"):
        known = _calendar(dim_date, f"_{name}")
        rows = rows.join(known, F.col(name) == F.col(f"_{name}"), "left")
    return rows


def marked_orders(
    orders: DataFrame, order_items: DataFrame, dim_customer: DataFrame, dim_order_status: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per order, and OUTSIDE: whether one of its delivery dates is no calendar day."""
    rows = _order_rows(orders, order_items, dim_customer, dim_order_status, dim_date)
    marked = _with_calendar_marks(rows, dim_date)
    inside = _in_calendar("estimated_delivery_date_key") & _in_calendar("actual_delivery_date_key")
    return marked.select(*rows.columns, (~inside).alias(OUTSIDE))


def fact_orders(
    orders: DataFrame, order_items: DataFrame, dim_customer: DataFrame, dim_order_status: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per order; its delivery dates must be calendar days (see fact_orders_quarantine)."""
    marked = marked_orders(orders, order_items, dim_customer, dim_order_status, dim_date)
    return marked.where(~F.col(OUTSIDE)).drop(OUTSIDE)


def fact_orders_quarantine(
    orders: DataFrame, order_items: DataFrame, dim_customer: DataFrame, dim_order_status: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Orders whose delivery dates lie outside the calendar: set aside instead of failing the load."""
    marked = marked_orders(orders, order_items, dim_customer, dim_order_status, dim_date)
    return marked.where(OUTSIDE).drop(OUTSIDE)


def first_item(order_items: DataFrame) -> DataFrame:
    """Product and seller of the first line per order. Rows are cut to one per order before the shuffle as well."""
    position = F.row_number().over(Window.partitionBy("order_id").orderBy("order_item_id"))
    return (
        order_items.select("order_id", "order_item_id", "product_id", "seller_id")
        .withColumn("_position", position)
        .where(F.col("_position") == 1)
        .drop("_position")
    )


def fact_reviews(
    order_reviews: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """One row per review, credited to the first line of its order; reviews of orders without lines have no row.

    The review id comes along to number the rows and is not part of the table.
    """
    credited = (
        first_item(order_items)
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id")
        .select("order_id", "product_key", "seller_key")
    )
    # What a review takes from its order: one row per order, so AQE can split an order with very many reviews.
    per_order = (
        orders.select("order_id", "customer_id")
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
        .select("order_id", "customer_key")
        .join(credited, "order_id")
    )
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    length = F.coalesce(text_length(F.col("review_comment_message")), F.lit(0))
    reviews = (
        order_reviews.withColumn("review_date_key", date_key(created))
        .join(_calendar(dim_date, "review_date_key"), "review_date_key", "left_semi")
        .select(
            "review_id",
            "order_id",
            "review_date_key",
            "review_score",
            length.alias("review_comment_length"),
            flag(F.col("review_score") >= 4).alias("is_positive_review"),
            flag(length > 0).alias("has_comment"),
            created.alias("review_creation_time"),
            "review_answer_timestamp",
            F.datediff(answered.cast("date"), created.cast("date")).alias("days_to_answer"),
        )
    )
    return reviews.join(per_order, "order_id")


def fact_payments(
    order_payments: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_payment_type: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row per payment record; its date is the purchase date of the order."""
    types = dim_payment_type.select(F.col("payment_type_code").alias("payment_type"), "payment_type_key")
    return (
        order_payments.join(F.broadcast(types), "payment_type")
        .join(_orders_of_customers(orders, dim_customer, dim_date, "payment_date_key"), "order_id")
        .select(
            "order_id",
            "customer_key",
            "payment_date_key",
            "payment_type_key",
            "payment_sequential",
            "payment_installments",
            "payment_value",
            F.lit(None).cast("decimal(10,2)").alias("payment_fee"),
            F.col("payment_value").alias("net_payment_value"),
        )
    )


def monthly_sales(
    fact_items: DataFrame, fact_orders: DataFrame, dim_date: DataFrame, dim_product: DataFrame, fact_reviews: DataFrame
) -> DataFrame:
    """Sales per (year, month, category, seller).

    Lines are first reduced to (order, category, seller): a distinct order is then one row, so neither COUNT(DISTINCT)
    multiplies the rows, and a hot order is small before the join on order_id. The review score is the mean, over the
    lines, of the mean per order; the mean per order is cut to two digits first.
    """
    amount = F.coalesce("total_item_value", F.lit(0)) + F.coalesce("freight_value", F.lit(0))
    category = F.coalesce("category_name_en", F.lit("Unknown")).alias("category_name_en")
    # Placed by order_id once: that serves the grouping and the join on order_id below, so these rows, the largest
    # between the steps, are shuffled once and not twice.
    per_order = (
        fact_items.join(dim_product.select("product_key", category), "product_key")
        .repartition("order_id")
        .groupBy("order_id", "order_date_key", "category_name_en", "seller_key")
        .agg(
            F.count("*").alias("lines"),
            F.sum("quantity").alias("items"),
            F.sum(amount).alias("revenue"),
            F.sum(F.coalesce("freight_value", F.lit(0))).alias("freight"),
        )
    )
    scores = fact_reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("decimal(5,2)")).cast("decimal(5,2)").alias("score")
    )
    months = dim_date.select(F.col("date_key").alias("order_date_key"), "year", F.col("month_of_year").alias("month"))
    revenue, orders = F.sum("revenue"), F.count("*")
    score_sum = F.sum(F.col("score") * F.col("lines"))
    scored_lines = F.sum(F.when(F.col("score").isNotNull(), F.col("lines")))
    attributes = fact_orders.select("order_id", "is_delayed").join(scores, "order_id", "left")
    return (
        per_order.join(attributes, "order_id")
        .join(F.broadcast(months), "order_date_key")
        .groupBy("year", "month", "category_name_en", "seller_key")
        .agg(
            orders.alias("total_orders"),
            F.sum("items").alias("total_items"),
            revenue.cast(MONEY).alias("total_revenue"),
            F.sum("freight").cast(MONEY).alias("total_freight"),
            ratio(revenue, orders, MONEY).alias("avg_order_value"),
            ratio(score_sum, scored_lines, "decimal(3,2)").alias("avg_review_score"),
            F.sum("is_delayed").alias("orders_delayed"),
        )
    )
