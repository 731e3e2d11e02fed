from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from quaystar.functions.columns import (
    REGIONS,
    date_key,
    percent,
    ratio,
    region_of,
    row_hash,
    size_class,
    text_length,
    us_week,
)


def one(spark, expression, **values):
    row = spark.range(1)
    for name, value in values.items():
        row = row.withColumn(name, value)
    return row.select(expression).first()[0]


def test_us_week_counts_from_the_sunday_before_january_first(spark):
    expected = {
        date(2017, 1, 1): 1,
        date(2017, 1, 7): 1,
        date(2017, 1, 8): 2,
        date(2016, 1, 2): 1,
        date(2016, 1, 3): 2,
        date(2016, 12, 31): 53,
    }
    found = spark.createDataFrame([(d,) for d in expected], "d date").select("d", us_week(F.col("d")))
    assert {row[0]: row[1] for row in found.collect()} == expected


def test_date_key_is_null_safe(spark):
    days = spark.createDataFrame([(datetime(2018, 3, 9, 23, 59),), (None,)], "t timestamp_ntz")
    assert [row[0] for row in days.select(date_key(F.col("t"))).collect()] == [20180309, None]


def test_every_state_has_its_region(spark):
    codes = [(code, region) for region, states in REGIONS.items() for code in states]
    codes += [("XX", "Unknown"), (None, "Unknown")]
    found = spark.createDataFrame(codes, "state string, region string").select("region", region_of(F.col("state")))
    assert len(codes) == 29
    assert all(row[0] == row[1] for row in found.collect())


def test_trailing_blanks_do_not_count(spark):
    assert one(spark, text_length(F.lit("  ab  "))) == 4
    assert one(spark, text_length(F.lit("   "))) == 0


def test_ratio_and_percent(spark):
    assert one(spark, ratio(F.lit(10), F.lit(0), "decimal(10,2)")) is None
    assert one(spark, ratio(F.lit(10), F.lit(4), "decimal(10,2)")) == Decimal("2.50")
    assert one(spark, percent(F.lit(2), F.lit(3))) == Decimal("66.67")
    assert one(spark, percent(F.lit(-1), F.lit(8), "decimal(10,2)")) == Decimal("-12.50")


def test_null_and_empty_text_hash_alike(spark):
    versions = spark.createDataFrame([("a", None), ("a", ""), ("", "a")], "x string, y string")
    first, second, third = (row[0] for row in versions.select(row_hash(["x", "y"])).collect())
    assert first == second != third
    assert len(first) == 64


def test_size_class_borders(spark):
    sizes = [
        (499, 19, "Small"),
        (500, 19, "Medium"),
        (499, 20, "Medium"),
        (4999, 49, "Medium"),
        (4999, 50, "Large"),
        (14999, 10, "Large"),
        (15000, 1, "Extra Large"),
        (None, None, "Small"),
    ]
    frame = spark.createDataFrame(sizes, "w int, l int, expected string")
    assert all(row[0] == row[1] for row in frame.select("expected", size_class(F.col("w"), F.col("l"))).collect())
