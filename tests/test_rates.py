import json
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from quaystar.operators import rates
from quaystar.plans.warehouse import Warehouse
from quaystar.schema import TABLES
from quaystar.sources.tables import TableStore

FETCHED = (
    "source_system string, currency_code string, base_currency string, rate_date date, rate_value decimal(18,6), "
    "fetched_at timestamp_ntz"
)


def test_payload_delivers_its_first_rate(spark):
    text = json.dumps(
        {
            "table": "A",
            "code": "brl",
            "rates": [
                {"no": "1/A/NBP/2024", "effectiveDate": "2024-01-02", "mid": 0.81},
                {"effectiveDate": "2024-01-01", "mid": 0.8},
            ],
        }
    )
    frame = spark.createDataFrame([(text, datetime(2024, 1, 2, 12))], "payload string, fetched_at timestamp_ntz")
    assert tuple(rates.parse_payloads(frame).first()) == (
        "NBP",
        "BRL",
        "PLN",
        date(2024, 1, 2),
        Decimal("0.810000"),
        datetime(2024, 1, 2, 12),
    )


def test_landed_payload_files(spark, tmp_path):
    for name, code, value in (("a", "brl", 0.8125), ("b", "usd", 4.01)):
        text = json.dumps({"code": code, "rates": [{"effectiveDate": "2024-01-05", "mid": value}]})
        (tmp_path / f"{name}.json").write_text(text)
    found = rates.parse_payloads(rates.read_payloads(spark, str(tmp_path)))
    assert sorted((r.currency_code, str(r.rate_value)) for r in found.collect()) == [("BRL", "0.812500"), ("USD", "4.010000")]
    assert all(r.fetched_at for r in found.collect())


def one_by_one(table, fetches):
    """The upsert as a sequence of single fetches."""
    for source, code, base, day, value, time in sorted(fetches, key=lambda f: f[5]):
        for key in table:
            if key[:3] == (source, code, base):
                table[key] = (*table[key][:2], 0)
        table[source, code, base, day] = (value, time, 1)
    return table


def test_batch_upsert_equals_one_by_one(spark):
    chance = random.Random(4)
    start = datetime(2024, 1, 1)

    def fetches(count, offset):
        return [
            (
                "NBP",
                chance.choice(["BRL", "BRL", "BRL", "USD", "EUR"]),
                "PLN",
                date(2024, 1, 1) + timedelta(days=chance.randrange(6)),
                Decimal(chance.randrange(1, 999)).scaleb(-2).quantize(Decimal("0.000001")),
                start + timedelta(minutes=offset + i),
            )
            for i in range(count)
        ]

    stored = spark.createDataFrame([], TABLES["dim_exchange_rate"].columns)
    expected = {}
    for count, offset in ((12, 0), (9, 100), (0, 200), (5, 300)):
        batch = fetches(count, offset)
        stored = rates.upsert_rates(stored, spark.createDataFrame(batch, FETCHED))
        expected = one_by_one(expected, batch)
    found = {tuple(row)[:4]: tuple(row)[4:] for row in stored.collect()}
    assert found == expected


def test_keys_stay_and_an_older_date_fetched_last_is_current(spark, tmp_path):
    warehouse = Warehouse(spark, TableStore(spark, str(tmp_path)), {})

    def fetch(day, value, hour):
        row = ("NBP", "BRL", "PLN", date(2024, 1, day), Decimal(value), datetime(2024, 1, 9, hour))
        merged = warehouse.merge_rates(spark.createDataFrame([row], FETCHED))
        return {r.rate_date.day: (r.exchange_rate_key, str(r.rate_value), r.is_current) for r in merged.collect()}

    fetch(2, "0.81", 1)
    fetch(3, "0.82", 2)
    assert fetch(3, "0.83", 3) == {2: (1, "0.810000", 0), 3: (2, "0.830000", 1)}
    assert fetch(1, "0.79", 4) == {1: (3, "0.790000", 1), 2: (1, "0.810000", 0), 3: (2, "0.830000", 0)}
    # The latest date counts for conversions, current or not.
    assert rates.latest_rate(warehouse.table("dim_exchange_rate")).first().rate_date == date(2024, 1, 3)


def test_conversion_without_a_rate_is_empty(spark):
    orders = spark.createDataFrame(
        [("o1", 1, 20180101, Decimal("10.00"))],
        "order_id string, customer_key bigint, order_date_key int, total_order_value decimal(20,2)",
    )
    columns = TABLES["dim_exchange_rate"].columns
    assert rates.orders_pln(orders, spark.createDataFrame([], columns)).isEmpty()
    day, time = date(2024, 1, 2), datetime(2024, 1, 2)
    known = spark.createDataFrame([("NBP", "BRL", "PLN", day, Decimal("0.814500"), time, 0)], columns)
    converted = rates.orders_pln(orders, known).first()
    assert (str(converted.total_order_value_pln), converted.exchange_rate_date) == ("8.15", day)


def test_broken_payloads_are_refused(spark, tmp_path):
    good = {"code": "brl", "rates": [{"effectiveDate": "2024-01-05", "mid": 0.81}]}
    texts = [json.dumps(good, indent=2), "", "no json", "{}", json.dumps({"code": "brl", "rates": []}), json.dumps({**good, "code": None})]
    for number, text in enumerate(texts):
        (tmp_path / f"{number}.json").write_text(text)
    landed = rates.read_payloads(spark, str(tmp_path))
    assert [row.currency_code for row in rates.parse_payloads(landed).collect()] == ["BRL"]
    missing = {row.payload: row.missing for row in rates.refused_payloads(landed).collect()}
    every = "currency_code,rate_date,rate_value"
    assert missing["no json"] == missing["{}"] == every
    assert missing[texts[4]] == "rate_date,rate_value" and missing[texts[5]] == "currency_code"
    assert len(missing) in (4, 5)  # Spark reads an empty file as no row
