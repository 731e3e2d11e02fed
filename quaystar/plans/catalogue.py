"""The registered queries: each takes (spark, folder of the order-processing tables) and returns a DataFrame.

Reports, checks and delta loads read the stored warehouse tables of that folder. A table that is not stored yet is built
by its load step first; dimension and fact queries run their builders on the staging tables.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.functions.columns import date_key, flag, region_of, us_week
from quaystar.operators import delta, facts, ingest, rates, scd2
from quaystar.operators.numbering import assign_keys
from quaystar.plans import history, reports, validation
from quaystar.plans.delta import INPUTS, load_delta
from quaystar.plans.warehouse import SALES, STEPS, Warehouse
from quaystar.schema import SOURCES, TABLES
from quaystar.session import shared_folder, table_files
from quaystar.sources.csv_files import scan_csv
from quaystar.sources.order_tables import OrderTables
from quaystar.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]

# Staging tables that take a shuffle to derive; they are stored once instead of being derived by each reader.
STORED_STAGING = ("geolocation", "order_items", "order_reviews")
RAW_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
CHANGE_TIME, LATER_CHANGE_TIME = datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 2, 2)
# Orders bought before this day are loaded already when the delta comes.
DELTA_FROM = 20180101
# Rates fetched before this moment are stored already when the next ones come.
RATES_FROM = datetime(2024, 1, 16, 12)

_warehouses: dict[tuple[str, str], OrderWarehouse] = {}


class OrderWarehouse(Warehouse):
    """Warehouse over the order-processing tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.source, self.root = OrderTables(spark, folder), root
        super().__init__(spark, TableStore(spark, root), dict(self.source.builders))
        for name in STORED_STAGING:
            self.staging[name] = lambda name=name: self._stored_staging(name)

    def _stored_staging(self, name: str) -> DataFrame:
        """Stored under the state of the source files (see `warehouse`), so a copy is never older than its source."""
        with self._building:
            stored = f"staging__{name}"
            return self.store.read(stored) if self.store.exists(stored) else self.store.replace(stored, self.source.builders[name]())

    def scratch_store(self) -> TableStore:
        return TableStore(self.spark, f"{self.root}/scratch/{uuid.uuid4().hex}")

    def exchange_rates(self) -> DataFrame:
        with self._building:
            if not self.store.exists("dim_exchange_rate"):
                self.merge_rates(rates.parse_payloads(self.source.rate_payloads()))
            return self.store.read("dim_exchange_rate")

    def csv_export(self, name: str, rows: DataFrame) -> str:
        """The rows as delivered CSV files, for the scans to read."""
        folder = f"{self.root}/csv/{uuid.uuid4().hex}/{name}"
        rows.write.options(header=True, quote='"', escape='"').csv(folder)
        return folder


def warehouse(spark: SparkSession, folder: str) -> OrderWarehouse:
    """One warehouse per application and state of the source files, in the shared folder."""
    state = hashlib.sha256(table_files(spark, folder, RAW_TABLES).encode()).hexdigest()[:16]
    key = (spark.sparkContext.applicationId, state)
    if key not in _warehouses or _warehouses[key].spark is not spark:
        _warehouses[key] = OrderWarehouse(spark, folder, f"{shared_folder(spark)}/quaystar/{key[0]}/{state}")
    return _warehouses[key]


# --- staging -------------------------------------------------------------------------------------------------------


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Products written as CSV, 'nan' and empty for NULL, scanned and typed again."""
    wh, source = warehouse(spark, folder), SOURCES["products"]
    products = wh.source.products()
    text = products.select(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in products.columns])
    return ingest.accepted(ingest.typed(scan_csv(spark, wh.csv_export("products", text), source), source))


def _with_long_messages(reviews: DataFrame) -> DataFrame:
    """Reviews whose messages hold commas, quotes and line breaks."""
    message = F.concat(
        F.lit('score "'),
        F.col("review_score").cast("string"),
        F.lit('",\nsecond line of '),
        "order_id",
        F.when(F.col("review_score") > 3, F.lit('\n\n"end"')).otherwise(F.lit("")),
    )
    return reviews.withColumn("review_comment_message", F.when(F.col("review_score") > 1, message))


def csv_free_text_scan(spark: SparkSession, folder: str) -> DataFrame:
    wh, source = warehouse(spark, folder), SOURCES["order_reviews"]
    rows = _with_long_messages(wh.source.delivered_order_reviews())
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    scanned = scan_csv(spark, wh.csv_export("order_reviews", text), source)
    return ingest.accepted(ingest.typed(scanned, source)).drop("review_comment_title")


def csv_lone_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews whose messages hold one quote each, not enclosed in quotes; the good ones come in files of another column
    order."""
    wh, source = warehouse(spark, folder), SOURCES["order_reviews"]
    rows = wh.source.delivered_order_reviews().withColumn(
        "review_comment_message", F.concat(F.col("review_score").cast("string"), F.lit('" shelf of '), "order_id")
    )
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    path, good = f"{wh.root}/csv/{uuid.uuid4().hex}/order_reviews", F.col("review_score") > "3"
    for part, columns in ((text.where(~good), text.columns), (text.where(good), text.columns[::-1])):
        part.select(*columns).write.mode("append").options(header=True, quote='"', escapeQuotes=False).csv(path)
    return ingest.accepted(ingest.typed(scan_csv(spark, path, source), source)).drop("review_comment_title")


def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    text = F.when(key % 7 == 0, "").when(key % 11 == 0, "nan").otherwise(F.concat(F.lit('"'), name, F.lit('"')))
    part = warehouse(spark, folder).source.raw("part")
    return ingest.null_tokens(part.select(key.cast("string").alias("part_id"), text.alias("part_name"), "p_brand"))


def _spoiled_payments(wh: OrderWarehouse) -> DataFrame:
    """Payments as text: some amounts are no numbers, low-priority orders lack their payment type."""
    rows = wh.source.order_payments()
    amount = F.when(F.col("order_id").cast("bigint") % 13 == 0, "x").otherwise(F.col("payment_value").cast("string"))
    return rows.select(
        "order_id",
        F.col("payment_sequential").cast("string").alias("payment_sequential"),
        F.when(F.col("payment_type") != "voucher", F.col("payment_type")).alias("payment_type"),
        F.col("payment_installments").cast("string").alias("payment_installments"),
        amount.alias("payment_value"),
    )


def typed_load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    checked = ingest.typed(_spoiled_payments(warehouse(spark, folder)), SOURCES["order_payments"])
    return ingest.rejected(checked).select(
        "order_id", "payment_sequential", F.col("_errors").alias("refused_columns")
    )


def pk_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.first_per_key(warehouse(spark, folder).source.raw("lineitem"), ["l_orderkey", "l_linenumber"])


def pk_first_in_file(spark: SparkSession, folder: str) -> DataFrame:
    """Lines delivered as payments with one number per order, the last line first: the load keeps the first in the files,
    which is no smallest one."""
    wh, source = warehouse(spark, folder), SOURCES["order_payments"]
    lines = wh.source.raw("lineitem").orderBy("l_orderkey", F.desc("l_linenumber"), F.desc("l_extendedprice"))
    text = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.lit("1").alias("payment_sequential"),
        F.lit("boleto").alias("payment_type"),
        F.col("l_linenumber").cast("string").alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("payment_value"),
    )
    scanned = scan_csv(spark, wh.csv_export("order_payments", text), source, placed=True)
    kept = ingest.first_per_key(ingest.accepted(ingest.typed(scanned, source)), source.key)
    return kept.select("order_id", "payment_sequential", "payment_installments", "payment_value")


def fk_reject(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose customer was not delivered: here the customers of one market segment."""
    source = warehouse(spark, folder).source
    known = source.customers().where(F.col("customer_city") != "MACHINERY")
    return ingest.orphans(source.orders(), "customer_id", known, "customer_id").select(
        "order_id", "customer_id", "order_status"
    )


def _delivered_reviews(wh: OrderWarehouse) -> tuple[DataFrame, DataFrame]:
    """Reviews of all orders as text, with repeated review ids, and the orders that were delivered: not those shipped."""
    rows = wh.source.delivered_order_reviews()
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return text, wh.source.orders().where(F.col("order_status") != "shipped")


def staging_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews through the whole staging load: typed, orphans refused, first per key; with the counts of the load."""
    source = SOURCES["order_reviews"]
    text, parents = _delivered_reviews(warehouse(spark, folder))
    checked = ingest.refuse_orphans(ingest.typed(text, source), "order_id", parents, "order_id")
    counts = ingest.load_counts(checked, source.key).select(F.struct("loaded", "duplicates", "errors")).scalar()
    kept = ingest.first_per_key(ingest.accepted(checked), source.key)
    return kept.select("review_id", "order_id", "review_score", counts.alias("counts")).select(
        "review_id", "order_id", "review_score", "counts.*"
    )


def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    lines = wh.source.raw("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").cast("string").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("string").alias("freight_value"),
    )
    delivered = {
        "customers": wh.source.customers(),
        "geolocation": wh.source.delivered_geolocation(),
        "order_items": lines,
        "order_payments": _spoiled_payments(wh),
        "order_reviews": wh.source.delivered_order_reviews(),
    }
    summary = None
    for name, rows in delivered.items():
        text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        counts = ingest.load_counts(ingest.typed(text, SOURCES[name]), SOURCES[name].key)
        counts = counts.select(F.lit(name).alias("table_name"), "loaded", "duplicates", "errors")
        summary = counts if summary is None else summary.unionByName(counts)
    return summary


def _loaded_counts(wh: OrderWarehouse) -> DataFrame:
    """Rows now in each table; the last one is empty."""
    tables = {name: wh.source.raw(name) for name in ("customer", "orders", "part", "supplier", "lineitem")}
    tables["returned_orders"] = wh.source.raw("orders").where(F.col("o_orderstatus") == "R")
    counts = None
    for name, rows in tables.items():
        one = rows.agg(F.count("*").alias("actual")).select(F.lit(name).alias("table_name"), "actual")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _recorded_counts(counts: DataFrame) -> DataFrame:
    """A manifest in which one table is recorded short and two are not recorded."""
    short = flag(F.col("table_name") == "lineitem")
    return counts.where(~F.col("table_name").isin("part", "returned_orders")).select(
        "table_name", (F.col("actual") - short).alias("recorded")
    )


def load_manifest(spark: SparkSession, folder: str) -> DataFrame:
    counts = _loaded_counts(warehouse(spark, folder))
    return ingest.load_decisions(counts, _recorded_counts(counts))


def manifest_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    counts = _loaded_counts(warehouse(spark, folder))
    recorded = _recorded_counts(counts).where(F.col("table_name") != "supplier")
    return ingest.bootstrap_manifest(counts, recorded, ["supplier"])


def selective_reload(spark: SparkSession, folder: str) -> DataFrame:
    counts = _loaded_counts(warehouse(spark, folder))
    return ingest.load_decisions(counts, _recorded_counts(counts), ["orders", "supplier"])


# --- tables --------------------------------------------------------------------------------------------------------


def _keyed(name: str) -> Query:
    """A dimension as its builder gives it, with its surrogate keys."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        table = TABLES[name]
        return assign_keys(warehouse(spark, folder).insert_rows(name), table.business_key, table.identity)

    return query


def _insert_rows(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder).insert_rows(name).select(*TABLES[name].insert_list())


def _with_use(dimension: DataFrame, key: str, used: DataFrame, name: str) -> DataFrame:
    """A dimension of fixed rows with the number of staging rows that refer to each."""
    counts = used.groupBy(key).agg(F.count("*").alias(name))
    return dimension.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    bought = wh.table("orders").select(date_key(F.col("order_purchase_timestamp")).alias("date_key"))
    return _with_use(wh.insert_rows("dim_date"), "date_key", bought, "orders_bought")


def dim_payment_type(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    used = wh.table("order_payments").select(F.col("payment_type").alias("payment_type_code"))
    return _with_use(wh.insert_rows("dim_payment_type"), "payment_type_code", used, "payments")


def dim_order_status(spark: SparkSession, folder: str) -> DataFrame:
    wh = warehouse(spark, folder)
    used = wh.table("orders").select(F.col("order_status").alias("status_code"))
    return _with_use(wh.insert_rows("dim_order_status"), "status_code", used, "orders")


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = warehouse(spark, folder).table("orders").select("order_id", "order_status")
    return assign_keys(orders, ["order_id"], "order_key")


def date_keys(spark: SparkSession, folder: str) -> DataFrame:
    bought, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return warehouse(spark, folder).table("orders").select(
        "order_id",
        date_key(bought).alias("order_date_key"),
        date_key(delivered).alias("delivery_date_key"),
        us_week(F.to_date(bought)).alias("order_week"),
    )


def region_map(spark: SparkSession, folder: str) -> DataFrame:
    customers = warehouse(spark, folder).table("customers")
    return customers.select(
        "customer_id", "customer_state", region_of(F.col("customer_state")).alias("region_name")
    )


def first_item(spark: SparkSession, folder: str) -> DataFrame:
    return facts.first_item(warehouse(spark, folder).table("order_items"))


def fact_orders_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    table = warehouse(spark, folder).table
    names = ("orders", "order_items", "dim_customer", "dim_order_status", "dim_date")
    return facts.fact_orders_quarantine(*[table(name) for name in names])


def append_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Customers stored in two appends; the second brings all customers and adds those of one segment."""
    wh = warehouse(spark, folder)
    target = Warehouse(spark, wh.scratch_store(), wh.staging)
    rows = wh.insert_rows("dim_customer")
    early = assign_keys(rows.where(F.col("customer_city") != "MACHINERY"), ["customer_id"], "customer_key")
    target.store.replace("dim_customer", TABLES["dim_customer"].shape(early))
    stored = target.append_new("dim_customer", rows)
    filled = flag(F.col("created_at").isNotNull() & F.col("updated_at").isNotNull())
    return stored.select("customer_key", "customer_id", "customer_segment", filled.alias("has_timestamps"))


def _table_states(wh: OrderWarehouse, done: dict[str, str]) -> DataFrame:
    actions = [(name, position, action) for position, (name, action) in enumerate(done.items(), 1)]
    steps = wh.spark.createDataFrame(actions, "table_name string, step int, action string")
    return validation.row_counts(wh.table).join(F.broadcast(steps), "table_name")


def warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    """A full load of all tables, forced."""
    wh = warehouse(spark, folder)
    return _table_states(wh, wh.load(force=True))


def skip_if_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """The load after a load: only the aggregate is built again."""
    wh = warehouse(spark, folder)
    wh.load()
    return _table_states(wh, wh.load())


def load_fails_half_way(spark: SparkSession, folder: str) -> DataFrame:
    """A forced load over fewer customers dies at the reviews: rows of each table then, and whether it is as before."""
    wh = warehouse(spark, folder)
    before = {step.table: (wh.table(step.table), wh.store.parts(step.table))[1] for step in STEPS}

    def lost() -> DataFrame:
        raise OSError("order_reviews cannot be read")

    fewer = {"customers": lambda: wh.table("customers").where(F.col("customer_city") != "MACHINERY"), "order_reviews": lost}
    try:
        Warehouse(spark, TableStore(spark, wh.root), {**wh.staging, **fewer}).load(force=True)
    except OSError:
        pass
    else:
        raise AssertionError("the load has not failed")
    after = TableStore(spark, wh.root)
    states = [(name, after.parts(name) == parts) for name, parts in before.items()]
    states = spark.createDataFrame(states, "table_name string, unchanged boolean")
    return validation.row_counts(after.read).join(F.broadcast(states), "table_name")


# --- product history -----------------------------------------------------------------------------------------------


def product_snapshot(dim_product: DataFrame) -> DataFrame:
    """The next delivery of all products: the heavy ones were renamed, the others are as before."""
    heavy = F.col("is_heavy") == 1
    unchanged = dim_product.where(~heavy).select("product_id", *scd2.ATTRIBUTES)
    return scd2.renamed(dim_product.where(heavy)).unionByName(unchanged)


def _scd2(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        products = warehouse(spark, folder).table("dim_product")
        return build(scd2.initial_versions(products), product_snapshot(products))

    return query


def _applied(versions: DataFrame, snapshot: DataFrame) -> DataFrame:
    return scd2.apply_changes(versions, snapshot, CHANGE_TIME)


def scd2_apply(spark: SparkSession, folder: str) -> DataFrame:
    """The stored history after the snapshot was delivered twice: the second delivery changes nothing."""
    wh = warehouse(spark, folder)
    products = wh.table("dim_product")
    target = Warehouse(spark, wh.scratch_store(), wh.staging)
    target.store.replace("dim_product", products)
    history.change_products(target, product_snapshot(products), CHANGE_TIME)
    stored = history.change_products(target, product_snapshot(products), LATER_CHANGE_TIME)
    return stored.select("product_scd_key", *scd2.COLUMNS)


# --- delta, rates --------------------------------------------------------------------------------------------------


def delta_orders(spark: SparkSession, folder: str) -> DataFrame:
    table = warehouse(spark, folder).table
    stored = table("fact_orders").where(F.col("order_date_key") < DELTA_FROM)
    names = ("orders", "order_items", "dim_customer", "dim_order_status", "dim_date")
    return delta.new_orders(stored, *[table(name) for name in names])


def delta_order_items(spark: SparkSession, folder: str) -> DataFrame:
    table = warehouse(spark, folder).table
    stored = table("fact_order_items").where(F.col("order_date_key") < DELTA_FROM)
    names = ("order_items", "orders", "dim_customer", "dim_product", "dim_seller", "dim_date")
    return delta.new_order_items(stored, *[table(name) for name in names])


def delta_agg_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The stored aggregate of the older facts after the delta, which computes the months it touches only."""
    wh = warehouse(spark, folder)
    kept = {step.table: (lambda name=step.table: wh.table(name)) for step in STEPS if step.table not in (*INPUTS, SALES)}
    target = Warehouse(spark, wh.scratch_store(), {**wh.staging, **kept})
    for name in INPUTS:
        target.store.replace(name, wh.table(name).where(F.col("order_date_key") < DELTA_FROM))
    target.build(SALES)
    load_delta(target)
    return target.table(SALES)


def rate_payload_json(spark: SparkSession, folder: str) -> DataFrame:
    return rates.parse_payloads(warehouse(spark, folder).source.rate_payloads())


def rate_payload_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of which some are broken: no JSON, no rates, no value; and some on several lines, which is fine."""
    wh = warehouse(spark, folder)
    rows = wh.source.rate_payloads()
    second = F.second("fetched_at")
    payload = F.col("payload")
    spoiled = (
        F.when(second < 6, F.lit("<html>busy</html>"))
        .when(second < 12, F.regexp_replace(payload, r"\[.*\]", "[]"))
        .when(second < 18, F.replace(payload, F.lit('"mid"'), F.lit('"middle"')))
        .when(second < 30, F.replace(payload, F.lit(","), F.lit(",\n  ")))
        .otherwise(payload)
    )
    landed = rows.withColumn("payload", spoiled)
    good = rates.parse_payloads(landed).select("fetched_at", "currency_code", "rate_value", F.lit(None).cast("string").alias("missing"))
    refused = rates.refused_payloads(landed).select(
        "fetched_at", F.lit(None).cast("string").alias("currency_code"), F.lit(None).cast("decimal(18,6)").alias("rate_value"), "missing"
    )
    return good.unionByName(refused)


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rates of the earlier fetches, merged with the later ones; one date is in both."""
    wh = warehouse(spark, folder)
    fetched = rates.parse_payloads(wh.source.rate_payloads())
    later = F.col("fetched_at") >= F.lit(RATES_FROM.isoformat(" ")).cast("timestamp_ntz")
    target = Warehouse(spark, wh.scratch_store(), wh.staging)
    target.merge_rates(fetched.where(~later))
    return target.merge_rates(fetched.where(later)).select(*rates.COLUMNS)


def retire_current(spark: SparkSession, folder: str) -> DataFrame:
    stored = warehouse(spark, folder).exchange_rates().select(*rates.COLUMNS)
    return rates.retire_current(stored, rates.SOURCE_SYSTEM, rates.ORDER_CURRENCY, rates.BASE_CURRENCY)


def latest_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rates.latest_rate(warehouse(spark, folder).exchange_rates())


def orders_pln_view(spark: SparkSession, folder: str) -> DataFrame:
    """The converted orders, by the name of their view."""
    wh = warehouse(spark, folder)
    wh.table("fact_orders")
    wh.exchange_rates()
    wh.register_views()
    return spark.table(rates.ORDERS_PLN_VIEW)


def rpt_orders_pln(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_orders_pln(orders_pln_view(spark, folder))


# --- reports, checks -----------------------------------------------------------------------------------------------


def _report(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    return lambda spark, folder: build(*[warehouse(spark, folder).table(name) for name in names], **options)


def _check(build: Callable[[validation.Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(warehouse(spark, folder).table)


def dropped_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Where the staging rows of orders, payments and reviews go: into their fact, or out of the load, and why."""
    return validation.dropped_rows(warehouse(spark, folder).table)


def _with_defects(folder_tables: validation.Tables) -> validation.Tables:
    """The tables with defects: customers of one segment twice, sellers of one region three times, lines without a
    customer or product key, and lines of products that the dimension lacks."""

    def table(name: str) -> DataFrame:
        rows = folder_tables(name)
        if name == "dim_customer":
            return rows.unionByName(rows.where(F.col("customer_city") == "MACHINERY"))
        if name == "dim_seller":
            twice = rows.where(F.col("region_name") == "South")
            return rows.unionByName(twice).unionByName(twice)
        if name == "dim_product":
            return rows.where(F.col("size_class") != "Small")
        if name == "fact_order_items":
            return rows.withColumns({
                "customer_key": F.when(F.col("order_item_id") != 2, F.col("customer_key")),
                "seller_key": F.when(F.col("price") < 50_000, F.col("seller_key")),
            })
        return rows

    return table


def _defect_check(build: Callable[[validation.Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(_with_defects(warehouse(spark, folder).table))


def category_share_without_small(spark: SparkSession, folder: str) -> DataFrame:
    """Category shares when the dimension lacks some products of the lines."""
    table = _with_defects(warehouse(spark, folder).table)
    return reports.category_share(table("fact_order_items"), table("dim_product"))


RUN_COLUMNS = [
    "etl_run_id",
    "run_name",
    "status",
    "fact_orders_rows",
    "fact_order_items_rows",
    "fact_payments_rows",
    "fact_reviews_rows",
    "agg_monthly_sales_rows",
]


def audit_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A run started, checked and closed."""
    table = warehouse(spark, folder).table
    return validation.close_run(validation.run_record(table), validation.validation_results(table)).select(*RUN_COLUMNS)


def audit_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Two recorded runs: the results of the later one, with its log row."""
    wh = warehouse(spark, folder)
    log = wh.scratch_store()
    run_id = [validation.audit(wh.table, log) for _ in range(2)][-1]
    results = validation.results_of_run(log.read("etl_validation_result"), run_id)
    runs = validation.latest_runs(log.read("etl_run_log")).select("etl_run_id", "run_name", "status")
    return results.join(F.broadcast(runs), "etl_run_id").select(
        "etl_run_id", "run_name", "status", "validation_result_id", "validation_name", "validation_status", "actual_value"
    )


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_free_text_scan": csv_free_text_scan,
    "csv_lone_quotes": csv_lone_quotes,
    "null_tokens": null_tokens,
    "typed_load_rejects": typed_load_rejects,
    "pk_dedup_first": pk_dedup_first,
    "pk_first_in_file": pk_first_in_file,
    "fk_reject": fk_reject,
    "staging_chain": staging_chain,
    "load_summary": load_summary,
    "load_manifest": load_manifest,
    "manifest_bootstrap": manifest_bootstrap,
    "selective_reload": selective_reload,
    "rate_payload_json": rate_payload_json,
    "rate_payload_rejects": rate_payload_rejects,
    "append_defaults": append_defaults,
    "skip_if_loaded": skip_if_loaded,
    "warehouse_load": warehouse_load,
    "load_fails_half_way": load_fails_half_way,
    "merge_upsert": merge_upsert,
    "retire_current": retire_current,
    "surrogate_keys": surrogate_keys,
    "date_key": date_keys,
    "region_map": region_map,
    "dim_date": dim_date,
    "dim_customer": _keyed("dim_customer"),
    "dim_seller": _keyed("dim_seller"),
    "dim_product": _keyed("dim_product"),
    "dim_payment_type": dim_payment_type,
    "dim_order_status": dim_order_status,
    "dim_geolocation": _keyed("dim_geolocation"),
    "first_item": first_item,
    "fact_order_items": _insert_rows("fact_order_items"),
    "fact_orders": _insert_rows("fact_orders"),
    "fact_orders_quarantine": fact_orders_quarantine,
    "fact_reviews": _insert_rows("fact_reviews"),
    "fact_payments": _insert_rows("fact_payments"),
    "agg_monthly_sales": _insert_rows("agg_monthly_sales"),
    "scd2_hash": _scd2(lambda versions, _: versions.select("product_id", "scd_hash")),
    "scd2_initial": _scd2(lambda versions, _: assign_keys(versions, ["product_id", "valid_from"], "product_scd_key")),
    "scd2_changes": _scd2(lambda versions, _: scd2.demo_change(versions)),
    "scd2_close": _scd2(lambda versions, snapshot: scd2.close_changed(versions, snapshot, CHANGE_TIME)),
    "scd2_apply": scd2_apply,
    "scd2_history": _scd2(lambda versions, snapshot: scd2.version_history(_applied(versions, snapshot))),
    "scd2_counts": _scd2(lambda versions, snapshot: scd2.version_counts(_applied(versions, snapshot))),
    "delta_orders": delta_orders,
    "delta_order_items": delta_order_items,
    "delta_agg_refresh": delta_agg_refresh,
    "latest_rate": latest_rate,
    "orders_pln_view": orders_pln_view,
    "global_ntile": _report(reports.customer_quartiles, "fact_orders", "dim_customer"),
    "rpt_monthly_category": _report(reports.monthly_category, "agg_monthly_sales"),
    "rpt_delay_by_region": _report(reports.delay_by_region, "fact_orders", "dim_customer"),
    "rpt_seller_rank": _report(reports.seller_rank, "fact_order_items", "dim_seller", "fact_reviews"),
    "rpt_payment_methods": _report(reports.payment_methods, "fact_payments", "dim_payment_type"),
    "rpt_category_quality": _report(reports.category_quality, "fact_order_items", "dim_product", "fact_reviews"),
    "rpt_mom_revenue": _report(reports.month_over_month, "fact_orders", "dim_date"),
    "rpt_category_share": _report(reports.category_share, "fact_order_items", "dim_product"),
    "rpt_customer_segments": _report(reports.customer_segments, "fact_orders", "dim_customer"),
    "rpt_delay_vs_rating": _report(reports.delay_vs_rating, "fact_orders", "fact_reviews"),
    "rpt_orders_pln": rpt_orders_pln,
    "val_row_counts": _check(validation.row_counts),
    "val_facts_nonempty": _check(validation.facts_nonempty),
    "val_duplicate_keys": _check(validation.duplicate_keys),
    "val_missing_keys": _check(validation.missing_keys),
    "val_revenue_recon": _check(validation.revenue_reconciliation),
    "val_orphan_customers": _check(validation.orphan_customers),
    "val_orphan_products": _check(validation.orphan_products),
    "dropped_rows": dropped_rows,
    "val_duplicate_keys_defects": _defect_check(validation.duplicate_keys),
    "val_missing_keys_defects": _defect_check(validation.missing_keys),
    "val_orphan_products_defects": _defect_check(validation.orphan_products),
    "rpt_category_share_defects": category_share_without_small,
    "audit_validation_results": _check(validation.validation_results),
    "audit_run_log": audit_run_log,
    "audit_latest": audit_latest,
}
