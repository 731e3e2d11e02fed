"""Delta load: facts of source rows that are not in the fact tables yet, by the builders of the full load."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quaystar.operators import facts


def new_orders(
    stored_orders: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    dim_customer: DataFrame,
    dim_order_status: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Fact rows of orders without a stored fact. The anti join comes first, so the builder sees new orders only, and
    their lines only: those are found before they are added up."""
    missing = orders.join(stored_orders.select("order_id"), "order_id", "left_anti").select(*orders.columns)
    lines = order_items.select("order_id", "price", "freight_value").join(missing.select("order_id"), "order_id", "left_semi")
    return facts.fact_orders(missing, lines, dim_customer, dim_order_status, dim_date)


def new_order_items(
    stored_items: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Fact rows of lines without a stored fact; of the orders, only those of such lines meet the customers."""
    key = ["order_id", "order_item_id"]
    missing = order_items.join(stored_items.select(*key), key, "left_anti").select(*order_items.columns)
    needed = orders.join(missing.select("order_id"), "order_id", "left_semi").select(*orders.columns)
    return facts.fact_order_items(missing, needed, dim_customer, dim_product, dim_seller, dim_date)
