"""Column expressions shared by the builders. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# State code -> sales region; every other code is 'Unknown'.
REGIONS = {
    "South": ["PR", "SC", "RS"],
    "Southeast": ["SP", "RJ", "MG", "ES"],
    "Northeast": ["BA", "PE", "CE", "PB", "RN", "AL", "SE", "MA", "PI"],
    "North": ["PA", "AM", "RO", "AC", "AP", "RR", "TO"],
    "Center-West": ["DF", "GO", "MT", "MS"],
}

# Sums of decimal(10,2) amounts. Wider than one row's amount, because one order or seller may hold a third of all rows.
MONEY = "decimal(20,2)"
# Scale at which a quotient is rounded first, before it is cut to the scale of the report.
QUOTIENT = "decimal(38,6)"


def region_of(state: Column) -> Column:
    region = F.lit(None).cast("string")
    for name, codes in REGIONS.items():
        region = F.coalesce(region, F.when(state.isin(codes), F.lit(name)))
    return F.coalesce(region, F.lit("Unknown"))


def date_key(ts: Column) -> Column:
    """Timestamp -> yyyymmdd int; NULL stays NULL."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def us_week(day: Column) -> Column:
    """Week of the year where week 1 holds January 1 and weeks start on Sunday (weekofyear would be ISO)."""
    days_into_week_one = F.dayofweek(F.trunc(day, "year")) - 1
    return (F.floor((F.dayofyear(day) - 1 + days_into_week_one) / 7) + 1).cast("int")


def text_length(text: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(text))


def flag(condition: Column) -> Column:
    """Condition -> 1, otherwise (also for NULL) 0."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column, denominator: Column, decimal_type: str) -> Column:
    """numerator / denominator as a decimal; NULL where the denominator is 0."""
    quotient = numerator.cast("decimal(38,4)") / F.nullif(denominator.cast("decimal(38,4)"), F.lit(Decimal(0)))
    return quotient.cast(QUOTIENT).cast(decimal_type)


def percent(part: Column, whole: Column, decimal_type: str = "decimal(5,2)") -> Column:
    return ratio(part.cast("decimal(30,2)") * F.lit(Decimal(100)), whole, decimal_type)


def money_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY)


def mean(value: Column, decimal_type: str) -> Column:
    """Mean of the value as a decimal: an integer mean must not be cut, and a double one must not drift."""
    return F.avg(value.cast(MONEY)).cast(QUOTIENT).cast(decimal_type)


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 hex of the '|'-joined values; NULL and '' give the same text, so they are the same version."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.lit("|")] if parts else []
        parts.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.sha2(F.concat(*parts), 256)


def size_class(weight_g: Column, length_cm: Column) -> Column:
    weight, length = F.coalesce(weight_g, F.lit(0)), F.coalesce(length_cm, F.lit(0))
    return (
        F.when((weight < 500) & (length < 20), "Small")
        .when((weight < 5000) & (length < 50), "Medium")
        .when(weight < 15000, "Large")
        .otherwise("Extra Large")
    )
