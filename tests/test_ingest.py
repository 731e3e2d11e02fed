from decimal import Decimal

from quaystar.operators import ingest
from quaystar.schema import SOURCES

PAYMENTS = SOURCES["order_payments"]
COLUMNS = "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string"


def test_null_tokens_and_quotes(spark, rows):
    frame = spark.createDataFrame([("", "nan", '"x"'), ('""', "NaN", "a\"b")], "a string, b string, c string")
    assert rows(ingest.null_tokens(frame)) == [("", "NaN", 'a"b'), (None, None, "x")]


def test_typed_rows_and_rejects(spark, rows):
    frame = spark.createDataFrame(
        [
            ("o1", "1", "boleto", "2", "10.005"),
            ("o2", "x", "boleto", "2", "10"),
            ("o3", "1", None, "1.5", "ten"),
            ("o" * 33, "1", "voucher", "1", "1"),
        ],
        COLUMNS,
    )
    checked = ingest.typed(frame, PAYMENTS)
    assert rows(ingest.accepted(checked)) == [("o1", 1, "boleto", 2, Decimal("10.01"))]
    assert rows(ingest.rejected(checked), "order_id", "_errors") == [
        ("o2", "payment_sequential"),
        ("o3", "payment_type,payment_installments,payment_value"),
        ("o" * 33, "order_id"),
    ]


def test_first_row_per_key_and_counts(spark, rows):
    frame = spark.createDataFrame(
        [
            ("o1", "1", "boleto", "2", "5"),
            ("o1", "1", "boleto", "1", "9"),
            ("o1", "2", "boleto", "1", "9"),
            ("o1", "2", "boleto", "1", "x"),
        ],
        COLUMNS,
    )
    checked = ingest.typed(frame, PAYMENTS)
    kept = ingest.first_per_key(ingest.accepted(checked), PAYMENTS.key)
    assert rows(kept, "payment_sequential", "payment_installments") == [(1, 1), (2, 1)]
    assert rows(ingest.load_counts(checked, PAYMENTS.key)) == [(2, 1, 1)]


def test_counts_of_an_empty_table(spark, rows):
    empty = ingest.typed(spark.createDataFrame([], COLUMNS), PAYMENTS)
    assert rows(ingest.load_counts(empty, PAYMENTS.key)) == [(0, 0, 0)]


def test_parents(spark, rows):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, p string")
    parents = spark.createDataFrame([("a",), ("a",)], "p string")
    assert rows(ingest.with_parent(children, "p", parents, "p")) == [(1, "a")]
    assert rows(ingest.orphans(children, "p", parents, "p")) == [(2, "b"), (3, None)]


def test_decisions(spark, rows):
    counts = spark.createDataFrame(
        [("same", 5), ("short", 4), ("unknown", 3), ("empty", 0), ("empty_recorded", 0)],
        "table_name string, actual bigint",
    )
    manifest = spark.createDataFrame(
        [("same", 5), ("short", 9), ("empty_recorded", 0)], "table_name string, recorded bigint"
    )

    def actions(**options):
        return dict(rows(ingest.load_decisions(counts, manifest, **options), "table_name", "action"))

    plain = {"same": "skip", "short": "reload", "unknown": "reload", "empty": "load", "empty_recorded": "skip"}
    assert actions() == plain
    assert actions(reload=["same"]) == {**plain, "same": "reload"}
    assert actions(skip_existing=False) == {
        **plain,
        "same": "reload",
        "empty_recorded": "load",
    }


def test_bootstrap(spark, rows):
    counts = spark.createDataFrame([("a", 5), ("b", 4), ("c", 0), ("d", 1)], "table_name string, actual bigint")
    manifest = spark.createDataFrame([("a", 9)], "table_name string, recorded bigint")
    assert rows(ingest.bootstrap_manifest(counts, manifest, ["d"])) == [("a", 9), ("b", 4)]
