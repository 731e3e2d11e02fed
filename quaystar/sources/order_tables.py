"""Staging tables derived from order-processing Parquet tables (customer, supplier, part, orders, lineitem, events).

They stand in for the nine delivered files, so that the warehouse can be built from, and checked against, any volume of
those tables. Every table is derived from all rows of its source. Modulo terms only vary values (states, dates,
defects such as repeated review ids); they do not leave rows out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.functions.columns import REGIONS
from quaystar.operators.ingest import first_per_key
from quaystar.operators.numbering import positions_in_group

# State number -> state code. The last one belongs to no region.
STATE_CODES = [code for codes in REGIONS.values() for code in codes] + ["XX"]
PAYMENT_TYPE_OF_PRIORITY = {
    "1-URGENT": "credit_card",
    "2-HIGH": "debit_card",
    "3-MEDIUM": "boleto",
    "5-LOW": "voucher",
}
CURRENCY_OF_EVENT = {"purchase": "brl", "signup": "usd", "view": "eur", "click": "gbp"}
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _id(name: str) -> Column:
    return F.col(name).cast("string")


def _zip(name: str) -> Column:
    return F.lpad((F.col(name) % 100).cast("string"), 5, "0")


def _state(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, STATE_CODES)), (number % len(STATE_CODES) + 1).cast("int"))


def _days(number: Column) -> Column:
    return F.make_dt_interval(days=number.cast("int"))


def _lookup(column: Column, values: dict[str, str], default: str) -> Column:
    found = F.lit(default)
    for key, value in values.items():
        found = F.when(column == key, value).otherwise(found)
    return found


class OrderTables:
    """Staging tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.builders: dict[str, Callable[[], DataFrame]] = {
            "customers": self.customers,
            "geolocation": self.geolocation,
            "orders": self.orders,
            "order_items": self.order_items,
            "order_payments": self.order_payments,
            "order_reviews": self.order_reviews,
            "products": self.products,
            "sellers": self.sellers,
            "category_translation": self.category_translation,
        }

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            _id("c_custkey").alias("customer_id"),
            (F.col("c_custkey") % 1000).cast("string").alias("customer_unique_id"),
            _zip("c_custkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            _state(F.col("c_custkey")).alias("customer_state"),
        )

    def sellers(self) -> DataFrame:
        return self.raw("supplier").select(
            _id("s_suppkey").alias("seller_id"),
            _zip("s_suppkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            _state(F.col("s_suppkey")).alias("seller_state"),
        )

    def delivered_geolocation(self) -> DataFrame:
        """As delivered: several rows per (zip, latitude, longitude)."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            _zip("c_custkey").alias("geolocation_zip_code_prefix"),
            (-30 + (key % 16) * 0.5).cast("double").alias("geolocation_lat"),
            (-60 + (key % 8) * 0.25).cast("double").alias("geolocation_lng"),
            F.col("c_mktsegment").alias("geolocation_city"),
            _state(key % 100).alias("geolocation_state"),
        )

    def geolocation(self) -> DataFrame:
        return first_per_key(
            self.delivered_geolocation(), ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"]
        )

    def orders(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        bought = F.col("o_orderdate") + F.make_ym_interval(F.lit(20))
        order_status = (
            F.when(key % 50 == 0, "canceled")
            .when(key % 97 == 0, "mystery")
            .when(status == "F", "delivered")
            .when(status == "O", "shipped")
            .otherwise("processing")
        )
        return self.raw("orders").select(
            _id("o_orderkey").alias("order_id"),
            _id("o_custkey").alias("customer_id"),
            order_status.alias("order_status"),
            bought.alias("order_purchase_timestamp"),
            (bought + F.expr("interval 1 hour")).alias("order_approved_at"),
            F.when(status != "P", bought + F.expr("interval 2 days")).alias("order_delivered_carrier_date"),
            F.when(status == "F", bought + _days(key * 7 % 40 + 1)).alias("order_delivered_customer_date"),
            F.when(key % 33 != 0, bought + _days(20 + key % 15)).alias("order_estimated_delivery_date"),
        )

    def order_items(self) -> DataFrame:
        """Order line numbers repeat in lineitem, so lines are numbered anew per order, also for very large orders."""
        numbered = positions_in_group(self.raw("lineitem"), "l_orderkey", LINE_ORDER, "order_item_id")
        return numbered.select(
            _id("l_orderkey").alias("order_id"),
            F.col("order_item_id").cast("int").alias("order_item_id"),
            _id("l_partkey").alias("product_id"),
            _id("l_suppkey").alias("seller_id"),
            (F.col("l_shipdate") + F.make_ym_interval(F.lit(20))).alias("shipping_limit_date"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
            (F.col("l_quantity") * 0.5).cast("decimal(10,2)").alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            _id("o_orderkey").alias("order_id"),
            F.explode(F.sequence(F.lit(1), (1 + key % 2).cast("int"))).alias("payment_sequential"),
            _lookup(F.col("o_orderpriority"), PAYMENT_TYPE_OF_PRIORITY, "not_defined").alias("payment_type"),
            (1 + key % 10).cast("int").alias("payment_installments"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"),
        )

    def delivered_order_reviews(self) -> DataFrame:
        """As delivered: a review of every order; some review ids come twice."""
        key = F.col("o_orderkey")
        created = F.col("o_orderdate") + F.make_ym_interval(F.lit(20)) + F.expr("interval 30 days")
        message = F.when(key % 3 == 1, F.lit("  ")).when(key % 3 == 2, F.concat("o_orderpriority", F.lit("  ")))
        return self.raw("orders").select(
            F.concat(F.lit("r"), (key - F.when(key % 100 == 2, 1).otherwise(0)).cast("string")).alias("review_id"),
            (key - F.when(key % 100 == 4, 1).otherwise(0)).cast("string").alias("order_id"),
            (1 + key * 3 % 5).cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            message.alias("review_comment_message"),
            created.alias("review_creation_date"),
            F.when(key % 11 != 0, created + _days(key % 7)).alias("review_answer_timestamp"),
        )

    def order_reviews(self) -> DataFrame:
        return first_per_key(self.delivered_order_reviews(), ["review_id"])

    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.raw("part").select(
            _id("p_partkey").alias("product_id"),
            F.when(key % 40 != 0, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (size * 10).cast("int").alias("product_description_lenght"),
            (size % 6).cast("int").alias("product_photos_qty"),
            F.when(key % 50 != 1, size * 400).cast("int").alias("product_weight_g"),
            size.cast("int").alias("product_length_cm"),
            (size % 20 + 1).cast("int").alias("product_height_cm"),
            (size % 15 + 1).cast("int").alias("product_width_cm"),
        )

    def category_translation(self) -> DataFrame:
        """One row per category in use; PROMO stays untranslated, so its own name is the fallback."""
        return (
            self.raw("part")
            .where(F.col("p_type") != "PROMO")
            .select(
                F.col("p_type").alias("product_category_name"),
                F.lower("p_type").alias("product_category_name_english"),
            )
            .distinct()
        )

    def rate_payloads(self) -> DataFrame:
        """One JSON rate payload per event, with the time it was fetched."""
        rate = F.struct(F.to_date("ts").alias("effectiveDate"), F.col("value").cast("decimal(18,6)").alias("mid"))
        payload = F.to_json(
            F.struct(
                _lookup(F.col("event_type"), CURRENCY_OF_EVENT, "chf").alias("code"), F.array(rate).alias("rates")
            )
        )
        return self.raw("events").select(payload.alias("payload"), F.col("ts").alias("fetched_at"))
