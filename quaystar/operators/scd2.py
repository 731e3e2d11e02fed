"""Type-2 history of products: one row per version, valid from a change until one second before the next."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystar.functions.columns import flag, row_hash

ATTRIBUTES = [
    "category_name_pt",
    "category_name_en",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "size_class",
]
COLUMNS = ["product_id", *ATTRIBUTES, "valid_from", "valid_to", "is_current", "scd_hash"]
# Start of the first version, and the suffixes of the demonstration change.
FIRST_VALID_FROM = datetime(1900, 1, 1)
DEMO_SUFFIX_PT, DEMO_SUFFIX_EN = "_SCD_DEMO", " SCD Demo"


def with_hash(rows: DataFrame) -> DataFrame:
    return rows.withColumn("scd_hash", row_hash(ATTRIBUTES))


def _current_versions(rows: DataFrame, valid_from: datetime) -> DataFrame:
    start = F.lit(valid_from.isoformat(" ")).cast("timestamp_ntz")
    return (
        with_hash(rows)
        .withColumn("valid_from", start)
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        .withColumn("is_current", F.lit(1))
        .select(*COLUMNS)
    )


def initial_versions(dim_product: DataFrame) -> DataFrame:
    return _current_versions(dim_product.where(F.col("product_id").isNotNull()), FIRST_VALID_FROM)


def renamed(products: DataFrame) -> DataFrame:
    """Products with the category names of the demonstration change."""
    return products.select(
        "product_id",
        F.concat(F.coalesce("category_name_pt", F.lit("unknown")), F.lit(DEMO_SUFFIX_PT)).alias("category_name_pt"),
        F.concat(F.coalesce("category_name_en", F.lit("unknown")), F.lit(DEMO_SUFFIX_EN)).alias("category_name_en"),
        *ATTRIBUTES[2:],
    )


def demo_change(versions: DataFrame) -> DataFrame:
    """The first current product that was not renamed yet, renamed. `_` in the pattern stands for any character."""
    candidates = versions.where(
        (F.col("is_current") == 1) & ~F.coalesce("category_name_pt", F.lit("")).like(f"%{DEMO_SUFFIX_PT}")
    )
    return with_hash(renamed(candidates.orderBy("product_id").limit(1)))


def close_changed(versions: DataFrame, changes: DataFrame, change_time: datetime) -> DataFrame:
    """End the current version of each product whose new hash differs. `changes` has one row per product."""
    time = F.lit(change_time.isoformat(" ")).cast("timestamp_ntz")
    new = changes.select("product_id", row_hash(ATTRIBUTES).alias("_new_hash"))
    # NULL (no change delivered) counts as unchanged.
    changed = F.coalesce((F.col("is_current") == 1) & (F.col("scd_hash") != F.col("_new_hash")), F.lit(False))
    kept = [name for name in versions.columns if name not in ("valid_to", "is_current", "updated_at")]
    updates = {
        "valid_to": F.when(changed, time - F.expr("interval 1 second")).otherwise(F.col("valid_to")),
        "is_current": F.when(changed, 0).otherwise(F.col("is_current")),
    }
    if "updated_at" in versions.columns:
        updates["updated_at"] = F.when(changed, time.cast("timestamp")).otherwise(F.col("updated_at"))
    return (
        versions.join(new, "product_id", "left")
        .select(*kept, *[value.alias(name) for name, value in updates.items()])
        .select(*versions.columns)
    )


def opened(closed: DataFrame, changes: DataFrame, change_time: datetime) -> DataFrame:
    """New current versions for changes that no current version has already; hand in versions closed before."""
    current = closed.where(F.col("is_current") == 1).select("product_id", "scd_hash")
    return _current_versions(changes, change_time).join(current, ["product_id", "scd_hash"], "left_anti").select(*COLUMNS)


def apply_changes(versions: DataFrame, changes: DataFrame, change_time: datetime) -> DataFrame:
    """All versions after the change. Applying the same changes again adds nothing."""
    closed = close_changed(versions.select(*COLUMNS), changes, change_time)
    return closed.unionByName(opened(closed, changes, change_time))


def version_history(versions: DataFrame, products: int = 5, rows: int = 20) -> DataFrame:
    """Versions of the first products that have more than one."""
    several = (
        versions.groupBy("product_id").count().where(F.col("count") > 1).orderBy("product_id").limit(products)
    ).select("product_id")
    return (
        versions.join(several, "product_id", "left_semi")
        .select("product_id", "category_name_pt", "category_name_en", "valid_from", "valid_to", "is_current")
        .orderBy("product_id", "valid_from")
        .limit(rows)
    )


def version_counts(versions: DataFrame) -> DataFrame:
    return versions.agg(
        F.count("*").alias("all_scd2_rows"),
        F.countDistinct("product_id").alias("distinct_products"),
        F.sum(flag(F.col("is_current") == 1)).alias("current_rows"),
        F.sum(flag(F.col("is_current") == 0)).alias("historical_rows"),
    )
