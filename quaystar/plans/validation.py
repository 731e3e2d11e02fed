"""Checks of a loaded warehouse, and the audit tables that record them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystar.functions.columns import MONEY, date_key, flag
from quaystar.schema import TABLES
from quaystar.sources.tables import TableStore

Tables = Callable[[str], DataFrame]

COUNTED = [
    "dim_date",
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_payment_type",
    "dim_order_status",
    "dim_geolocation",
    "fact_order_items",
    "fact_orders",
    "fact_reviews",
    "fact_payments",
    "agg_monthly_sales",
]
RUN_NAME = "manual_validation_after_etl"


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def _count(rows: DataFrame, name: str = "row_count") -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def row_counts(table: Tables) -> DataFrame:
    return _union([_count(table(name)).select(F.lit(name).alias("table_name"), "row_count") for name in COUNTED])


def _ok(condition: Column) -> Column:
    return F.when(condition, "OK").otherwise("ERROR")


def facts_nonempty(table: Tables) -> DataFrame:
    counts = {name: _count(table(name)).scalar() for name in ("fact_orders", "fact_order_items", "fact_payments")}
    return _one_row(table).select(*[_ok(count > 0).alias(f"{name}_status") for name, count in counts.items()])


def _one_row(table: Tables) -> DataFrame:
    return table("dim_date").sparkSession.range(1)


def duplicate_keys(table: Tables) -> DataFrame:
    """Business keys that occur more than once in a dimension; empty for a sound load."""
    checks = []
    for name, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_seller", "seller_id")):
        counted = table(name).groupBy(F.col(key).alias("business_key")).agg(F.count("*").alias("duplicated_count"))
        checks.append(
            counted.where(F.col("duplicated_count") > 1).select(
                F.lit(name).alias("table_name"), "business_key", "duplicated_count"
            )
        )
    return _union(checks)


def missing_keys(table: Tables) -> DataFrame:
    keys = ("customer_key", "product_key", "seller_key", "order_date_key")
    return table("fact_order_items").agg(
        *[F.coalesce(F.sum(flag(F.col(key).isNull())), F.lit(0)).alias(f"missing_{key}") for key in keys]
    )


def revenue_reconciliation(table: Tables) -> DataFrame:
    """Revenue of the lines against the aggregate. Lines of orders without an order fact are in the first only."""
    amount = F.coalesce("total_item_value", F.lit(0)) + F.coalesce("freight_value", F.lit(0))
    lines = table("fact_order_items").agg(F.sum(amount).cast(MONEY)).scalar()
    aggregate = table("agg_monthly_sales").agg(F.sum("total_revenue").cast(MONEY)).scalar()
    return _one_row(table).select(
        lines.alias("revenue_from_fact_items"), aggregate.alias("revenue_from_aggregate")
    ).withColumn("difference", (F.col("revenue_from_fact_items") - F.col("revenue_from_aggregate")).cast(MONEY))


def orphan_customers(table: Tables) -> DataFrame:
    orphans = table("fact_orders").join(table("dim_customer"), "customer_key", "left_anti")
    return _count(orphans, "orphan_rows")


def orphan_products(table: Tables) -> DataFrame:
    orphans = table("fact_order_items").join(table("dim_product"), "product_key", "left_anti")
    return _count(orphans, "orphan_rows")


def dropped_rows(table: Tables) -> DataFrame:
    """fact, outcome, row_count: the staging rows of orders, payments and reviews by what becomes of them.

    'stored', or the first reason that keeps a row out of its fact. The counts of a fact add up to its staging rows.
    """
    days = F.broadcast(table("dim_date").select(F.col("date_key").alias("_day")))  # one row per calendar day
    known = {
        "customer": table("dim_customer").select(F.col("customer_id").alias("_customer")),
        "status": F.broadcast(table("dim_order_status").select(F.col("status_code").alias("_status"))),
        "type": F.broadcast(table("dim_payment_type").select(F.col("payment_type_code").alias("_type"))),
    }

    def in_calendar(rows: DataFrame, day: Column, name: str) -> DataFrame:
        """name: whether the day is in the calendar; null if there is no day."""
        rows = rows.withColumn("_key", date_key(day)).join(days, F.col("_key") == F.col("_day"), "left")
        return rows.withColumn(name, F.when(F.col("_key").isNotNull(), F.col("_day").isNotNull())).drop("_key", "_day")

    orders = table("orders").join(known["status"], F.col("order_status") == F.col("_status"), "left")
    orders = orders.join(known["customer"], F.col("customer_id") == F.col("_customer"), "left")
    for name, day in (
        ("_bought", "order_purchase_timestamp"),
        ("_estimated", "order_estimated_delivery_date"),
        ("_delivered", "order_delivered_customer_date"),
    ):
        orders = in_calendar(orders, F.col(day), name)
    no_customer = F.when(~F.coalesce("_bought", F.lit(False)), "bought outside the calendar").when(
        F.col("_customer").isNull(), "unknown customer"
    )
    late = ~F.coalesce("_estimated", F.lit(True)) | ~F.coalesce("_delivered", F.lit(True))
    of_order = no_customer.when(F.col("_status").isNull(), "unknown status").when(late, "delivery outside the calendar")
    sound = orders.where(F.col("_customer").isNotNull()).select(F.col("order_id").alias("_order"), F.col("_bought").alias("_in"))

    payments = table("order_payments").join(known["type"], F.col("payment_type") == F.col("_type"), "left")
    payments = payments.join(sound, F.col("order_id") == F.col("_order"), "left")
    of_payment = (
        F.when(F.col("_type").isNull(), "unknown payment type")
        .when(F.col("_order").isNull(), "unknown order or customer")
        .when(~F.coalesce("_in", F.lit(False)), "bought outside the calendar")
    )
    lines = table("order_items").select(F.col("order_id").alias("_with_lines")).distinct()
    reviews = in_calendar(table("order_reviews"), F.col("review_creation_date"), "_created")
    reviews = reviews.join(sound.select("_order"), F.col("order_id") == F.col("_order"), "left")
    reviews = reviews.join(lines, F.col("order_id") == F.col("_with_lines"), "left")
    of_review = (
        F.when(~F.coalesce("_created", F.lit(False)), "written outside the calendar")
        .when(F.col("_order").isNull(), "unknown order or customer")
        .when(F.col("_with_lines").isNull(), "order without lines")
    )
    counts = [
        rows.groupBy(F.lit(fact).alias("fact"), outcome.otherwise("stored").alias("outcome")).agg(F.count("*").alias("row_count"))
        for fact, rows, outcome in (
            ("fact_orders", orders, of_order),
            ("fact_payments", payments, of_payment),
            ("fact_reviews", reviews, of_review),
        )
    ]
    return _union(counts)


def _found(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows of a fact, and those whose key the dimension lacks, in one pass over the fact."""
    known = dimension.select(F.col(key).alias("_known")).distinct()
    marked = fact.select(key).join(known, F.col(key) == F.col("_known"), "left")
    return marked.agg(F.count("*").alias("rows"), F.count_if(F.col("_known").isNull()).alias("orphans"))


def validation_results(table: Tables, run_id: int = 1, first_id: int = 1) -> DataFrame:
    """The six recorded checks. Checks of one table share a pass over it."""
    duplicates = table("dim_product").groupBy("product_id").count().where(F.col("count") > 1)
    # Check names, expectations and details as recorded, in this order.
    checks = [
        ("fact_orders is not empty", "> 0", "Tabela fact_orders powinna zawierać załadowane zamówienia."),
        ("fact_order_items is not empty", "> 0", "Tabela fact_order_items powinna zawierać pozycje zamówień."),
        ("agg_monthly_sales is not empty", "> 0", "Tabela agregująca powinna być zasilona po ETL."),
        ("missing customer keys in fact_orders", "0", "Sprawdzenie, czy fact_orders ma poprawne klucze klientów."),
        ("missing product keys in fact_order_items", "0", "Sprawdzenie, czy fact_order_items ma poprawne klucze produktów."),
        ("duplicate product business keys", "0", "Sprawdzenie duplikatów product_id w dim_product."),
    ]
    # What each pass finds, and the number of the check it is for.
    passes = [
        (_found(table("fact_orders"), table("dim_customer"), "customer_key"), {0: "rows", 3: "orphans"}),
        (_found(table("fact_order_items"), table("dim_product"), "product_key"), {1: "rows", 4: "orphans"}),
        (_count(table("agg_monthly_sales"), "rows"), {2: "rows"}),
        (_count(duplicates, "rows"), {5: "rows"}),
    ]
    results = []
    for found, uses in passes:
        structs = []
        for position, column in uses.items():
            name, expected, details = checks[position]
            passed = F.col(column) > 0 if expected == "> 0" else F.col(column) == 0
            structs.append(
                F.struct(
                    F.lit(first_id + position).cast("bigint").alias("validation_result_id"),
                    F.lit(run_id).cast("bigint").alias("etl_run_id"),
                    F.lit(name).alias("validation_name"),
                    _ok(passed).alias("validation_status"),
                    F.lit(expected).alias("expected_value"),
                    F.col(column).cast("string").alias("actual_value"),
                    F.lit(details).alias("details"),
                )
            )
        results.append(found.select(F.inline(F.array(*structs))))
    return _union(results)


def run_record(table: Tables, run_id: int = 1) -> DataFrame:
    """The record of a run when it starts."""
    counted = ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "agg_monthly_sales")
    return _one_row(table).select(
        F.lit(run_id).cast("bigint").alias("etl_run_id"),
        F.lit(RUN_NAME).alias("run_name"),
        F.current_timestamp().alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit("STARTED").alias("status"),
        *[_count(table(name)).scalar().alias(f"{name}_rows") for name in counted],
        F.lit(None).cast("string").alias("error_message"),
    )


def close_run(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Finish the started runs that have results: with errors if any of their checks failed."""
    verdict = results.groupBy("etl_run_id").agg(F.bool_or(F.col("validation_status") == "ERROR").alias("_failed"))
    closing = (F.col("status") == "STARTED") & F.col("_failed").isNotNull()
    status = F.when(closing & F.col("_failed"), "FINISHED_WITH_ERRORS").when(closing, "SUCCESS")
    return (
        runs.join(verdict, "etl_run_id", "left")
        .withColumn("finished_at", F.when(closing, F.current_timestamp()).otherwise(F.col("finished_at")))
        .withColumn("status", F.coalesce(status, F.col("status")))
        .select(*runs.columns)
    )


def latest_runs(runs: DataFrame, rows: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("etl_run_id")).limit(rows)


def results_of_run(results: DataFrame, run_id: int) -> DataFrame:
    return results.where(F.col("etl_run_id") == run_id).orderBy("validation_result_id")


def audit(table: Tables, log: TableStore) -> int:
    """Record a run in the store: log row, check results, closing status. Returns the run id."""
    run_id = 1 + _highest(log, "etl_run_log", "etl_run_id")
    first_id = 1 + _highest(log, "etl_validation_result", "validation_result_id")
    runs, checks = TABLES["etl_run_log"], TABLES["etl_validation_result"]
    started = log.append("etl_run_log", runs.shape(run_record(table, run_id)))
    checked = validation_results(table, run_id, first_id).withColumn("checked_at", F.current_timestamp())
    results = log.append("etl_validation_result", checks.shape(checked))
    log.replace("etl_run_log", runs.shape(close_run(started, results)))
    return run_id


def _highest(log: TableStore, table: str, key: str) -> int:
    if not log.exists(table):
        return 0
    return log.read(table).agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
