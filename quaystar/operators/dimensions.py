"""Dimension builders: staging tables in, insert lists out. Keys are added when the rows are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.functions.columns import date_key, flag, region_of, size_class, us_week

# Fixed values: (code, name, category, risk level).
PAYMENT_TYPES = [
    ("credit_card", "Credit Card", "Card", "Medium"),
    ("debit_card", "Debit Card", "Card", "Low"),
    ("boleto", "Boleto Bancário", "Bank Transfer", "Low"),
    ("voucher", "Voucher", "Cash", "Low"),
    ("not_defined", "Not Defined", "Unknown", "High"),
]
# Fixed values: (code, final, problem); the name is the title-cased code.
ORDER_STATUSES = [
    ("created", 0, 0),
    ("approved", 0, 0),
    ("invoiced", 0, 0),
    ("pending_payment", 0, 0),
    ("processing", 0, 0),
    ("shipped", 0, 0),
    ("delivered", 1, 0),
    ("canceled", 1, 1),
    ("unavailable", 1, 1),
]
CALENDAR_START, CALENDAR_END = "2015-01-01", "2020-12-31"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day. Weekdays run from 1 = Sunday to 7 = Saturday. Its size is fixed, so it is safe to broadcast."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col("calendar_date")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(first, last)).alias("calendar_date"))
        .select(
            date_key(day).alias("date_key"),
            day,
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            us_week(day).alias("week_of_year"),
            F.month(day).alias("month_of_year"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
            flag(F.dayofweek(day).isin(1, 7)).alias("is_weekend"),
            F.lit(0).alias("is_holiday"),
        )
    )


def _party(rows: DataFrame, role: str, segment: str) -> DataFrame:
    """Customers and sellers have the same shape: distinct rows, region of the state, a constant segment."""
    return (
        rows.where(F.col(f"{role}_id").isNotNull())
        .select(f"{role}_id", f"{role}_zip_code_prefix", f"{role}_city", f"{role}_state")
        .distinct()
        .withColumn("region_name", region_of(F.col(f"{role}_state")))
        .withColumn(f"{role}_segment", F.lit(segment))
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return _party(customers, "customer", "Regular")


def dim_seller(sellers: DataFrame) -> DataFrame:
    return _party(sellers, "seller", "Standard")


def dim_product(products: DataFrame, category_translation: DataFrame) -> DataFrame:
    """The size class goes by weight and length; a category without translation keeps its own name."""
    weight, length = F.col("product_weight_g"), F.col("product_length_cm")
    # Multiplied as decimals: three int factors can leave the int range.
    sides = [F.coalesce(F.col(f"product_{side}_cm"), F.lit(0)) for side in ("length", "height", "width")]
    volume = sides[0].cast("decimal(12,0)") * sides[1].cast("decimal(12,0)") * sides[2].cast("decimal(12,0)")
    return (
        products.where(F.col("product_id").isNotNull())
        .join(category_translation, "product_category_name", "left")
        .select(
            "product_id",
            F.col("product_category_name").alias("category_id"),
            F.coalesce("product_category_name_english", "product_category_name").alias("category_name_en"),
            F.col("product_category_name").alias("category_name_pt"),
            F.col("product_name_lenght").alias("product_name_length"),
            F.col("product_description_lenght").alias("product_description_length"),
            "product_photos_qty",
            weight.cast("decimal(10,2)").alias("product_weight_g"),
            length.cast("decimal(10,2)").alias("product_length_cm"),
            F.col("product_height_cm").cast("decimal(10,2)").alias("product_height_cm"),
            F.col("product_width_cm").cast("decimal(10,2)").alias("product_width_cm"),
            volume.cast("decimal(15,2)").alias("volume_cm3"),
            flag(F.coalesce(weight, F.lit(0)) > 10000).alias("is_heavy"),
            size_class(weight, length).alias("size_class"),
        )
    )


def dim_payment_type(spark: SparkSession) -> DataFrame:
    """Seed rows; their keys follow the order of the list."""
    return spark.createDataFrame(
        [(key, *row) for key, row in enumerate(PAYMENT_TYPES, 1)],
        "payment_type_key bigint, payment_type_code string, payment_type_name string, payment_category string, "
        "risk_level string",
    )


def dim_order_status(spark: SparkSession) -> DataFrame:
    """Seed rows; their keys follow the order of the list."""
    rows = [
        (key, code, code.replace("_", " ").title(), final, problem)
        for key, (code, final, problem) in enumerate(ORDER_STATUSES, 1)
    ]
    return spark.createDataFrame(
        rows,
        "order_status_key bigint, status_code string, status_name string, is_final_status int, is_problem_status int",
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    return (
        geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"))
        .agg(
            F.avg("geolocation_lat").cast("decimal(10,6)").alias("latitude"),
            F.avg("geolocation_lng").cast("decimal(10,6)").alias("longitude"),
            F.min("geolocation_city").alias("city"),
            F.min("geolocation_state").alias("state"),
        )
        .withColumn("region_name", region_of(F.col("state")))
        .withColumn("distance_from_sao_paulo_km", F.lit(None).cast("int"))
    )
