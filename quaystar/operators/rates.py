"""Exchange rates: JSON payloads, keyed upsert, the current rate and converted order values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.functions.columns import MONEY

# Where the rates come from, and the currencies of the converted orders.
SOURCE_SYSTEM, BASE_CURRENCY, ORDER_CURRENCY = "NBP", "PLN", "BRL"
ORDERS_PLN_VIEW = "vw_fact_orders_pln"
PAYLOAD = "struct<code: string, rates: array<struct<effectiveDate: date, mid: decimal(18,6)>>>"
PAIR = ["source_system", "currency_code", "base_currency"]
KEY = [*PAIR, "rate_date"]
COLUMNS = [*KEY, "rate_value", "fetched_at", "is_current"]


def _parsed(payloads: DataFrame) -> DataFrame:
    """payload, fetched_at and the rate row of each payload; what a broken one lacks is null."""
    # As a generator, each payload is parsed once, not once per use of a value.
    one = F.coalesce(F.from_json("payload", PAYLOAD), F.from_json(F.lit("{}"), PAYLOAD))
    parsed = payloads.select("payload", "fetched_at", F.inline(F.array(one)))
    rate = F.get("rates", F.lit(0))
    return parsed.select(
        "payload",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.upper("code").alias("currency_code"),
        F.lit(BASE_CURRENCY).alias("base_currency"),
        rate["effectiveDate"].alias("rate_date"),
        rate["mid"].alias("rate_value"),
        "fetched_at",
    )


def _whole() -> Column:
    return F.col("currency_code").isNotNull() & F.col("rate_date").isNotNull() & F.col("rate_value").isNotNull()


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """Landed payload texts -> rate rows; a payload delivers the first element of its `rates`. Broken payloads, without
    a code, a date or a value, deliver nothing: they are in `refused_payloads`."""
    return _parsed(payloads).where(_whole()).drop("payload")


def refused_payloads(payloads: DataFrame) -> DataFrame:
    """payload, fetched_at and the columns it has no value for, as a list text."""
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("currency_code", "rate_date", "rate_value")]
    return _parsed(payloads).where(~_whole()).select("payload", "fetched_at", F.concat_ws(",", *lacking).alias("missing"))


def _is_pair(source: str, currency: str, base: str) -> Column:
    return (
        (F.col("source_system") == source) & (F.col("currency_code") == currency) & (F.col("base_currency") == base)
    )


def retire_current(rates: DataFrame, source: str, currency: str, base: str) -> DataFrame:
    """UPDATE … SET is_current = 0 for one pair."""
    retired = F.when(_is_pair(source, currency, base), 0).otherwise(F.col("is_current"))
    return rates.withColumn("is_current", retired)


def upsert_rates(target: DataFrame, fetched: DataFrame) -> DataFrame:
    """The table after applying the fetched rates in the order of their fetch time.

    A fetch retires all rows of its pair, then updates or inserts its own row and makes that current, even if its date
    is older. Applied as a batch: the last fetch per key gives the value, the last fetch per pair gives the current row.
    """
    last = F.struct("fetched_at", "rate_value")
    news = fetched.groupBy(*KEY).agg(F.max(last).alias("_news"))
    current = fetched.groupBy(*PAIR).agg(
        F.max(F.struct("fetched_at", "rate_value", "rate_date"))["rate_date"].alias("_current_date")
    )
    kept = [name for name in target.columns if name not in COLUMNS]
    return (
        target.join(news, KEY, "full_outer")
        .join(current, PAIR, "left")
        .select(
            *KEY,
            F.coalesce(F.col("_news.rate_value"), F.col("rate_value")).alias("rate_value"),
            F.coalesce(F.col("_news.fetched_at"), F.col("fetched_at")).alias("fetched_at"),
            F.when(F.col("_current_date").isNull(), F.col("is_current"))
            .otherwise((F.col("rate_date") == F.col("_current_date")).cast("int"))
            .alias("is_current"),
            *kept,
        )
    )


def latest_rate(rates: DataFrame) -> DataFrame:
    """The pair's row with the latest date, whether it is marked current or not."""
    return (
        rates.where(_is_pair(SOURCE_SYSTEM, ORDER_CURRENCY, BASE_CURRENCY))
        .orderBy(F.desc("rate_date"), F.desc("fetched_at"))
        .limit(1)
        .select("rate_value", "rate_date")
    )


def orders_pln(fact_orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Order values converted at the latest rate; without a rate there are no rows."""
    rate = latest_rate(rates).select(F.struct("rate_value", "rate_date")).scalar()
    value = F.col("total_order_value")
    return (
        fact_orders.select("order_id", "customer_key", "order_date_key", value, rate.alias("_rate"))
        .where(F.col("_rate").isNotNull())
        .select(
            "order_id",
            "customer_key",
            "order_date_key",
            value.alias("total_order_value_brl"),
            F.col("_rate.rate_value").alias("brl_to_pln_rate"),
            (value * F.col("_rate.rate_value")).cast(MONEY).alias("total_order_value_pln"),
            F.col("_rate.rate_date").alias("exchange_rate_date"),
        )
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed answers of the rate service, one per file, on any number of lines; a file's time is that of the fetch."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("payload"), F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("fetched_at")
    )
