"""The warehouse: staging tables -> dimensions -> facts -> monthly aggregate. A load becomes visible as a whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from copy import copy
from dataclasses import dataclass
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.operators import dimensions, facts
from quaystar.operators.numbering import (
    assign_keys,
    assign_keys_in_files,
    highest_key,
    unknown_rows,
)
from quaystar.operators.rates import ORDERS_PLN_VIEW, PAIR, orders_pln, upsert_rates
from quaystar.plans import validation
from quaystar.schema import SOURCES, TABLES
from quaystar.sources.tables import TableStore

Staging = dict[str, Callable[[], DataFrame]]


@dataclass(frozen=True)
class Step:
    """One table of the load: the tables its builder takes, in order."""

    table: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    always: bool = False  # rebuilt by every load


# The order of the load. Dimensions come first, since facts look up their keys.
STEPS = [
    Step("dim_date", dimensions.dim_date, ("spark",)),
    Step("dim_customer", dimensions.dim_customer, ("customers",)),
    Step("dim_seller", dimensions.dim_seller, ("sellers",)),
    Step("dim_product", dimensions.dim_product, ("products", "category_translation")),
    Step("dim_payment_type", dimensions.dim_payment_type, ("spark",)),
    Step("dim_order_status", dimensions.dim_order_status, ("spark",)),
    Step("dim_geolocation", dimensions.dim_geolocation, ("geolocation",)),
    Step(
        "fact_order_items",
        facts.fact_order_items,
        ("order_items", "orders", "dim_customer", "dim_product", "dim_seller", "dim_date"),
    ),
    Step(
        "fact_orders",
        facts.fact_orders,
        ("orders", "order_items", "dim_customer", "dim_order_status", "dim_date"),
    ),
    Step(
        "fact_reviews",
        facts.fact_reviews,
        ("order_reviews", "orders", "order_items", "dim_customer", "dim_product", "dim_seller", "dim_date"),
    ),
    Step("fact_payments", facts.fact_payments, ("order_payments", "orders", "dim_customer", "dim_payment_type", "dim_date")),
    Step(
        "agg_monthly_sales",
        facts.monthly_sales,
        ("fact_order_items", "fact_orders", "dim_date", "dim_product", "fact_reviews"),
        always=True,
    ),
]
QUARANTINE = "fact_orders_quarantine"
SALES = "agg_monthly_sales"
STEP_OF = {step.table: step for step in STEPS}
# Inputs of the aggregate whose rows belong to a month.
DATED = ("fact_order_items", "fact_orders", "fact_reviews")


class Warehouse:
    def __init__(self, spark: SparkSession, store: TableStore, staging: Staging):
        self.spark, self.store, self.staging = spark, store, staging
        self._building = RLock()

    def table(self, name: str) -> DataFrame:
        """A staging or warehouse table; a warehouse table that is missing is built first, and once."""
        if name in self.staging:
            return self.staging[name]()
        with self._building:
            return self.store.read(name) if self.store.exists(name) else self.build(name)

    @contextmanager
    def together(self) -> Iterator[Warehouse]:
        """This warehouse for a load of several tables: it sees what it writes, all others see it when the block ends."""
        with self.store.together() as draft:
            target = copy(self)
            target.store = draft
            yield target

    def insert_rows(self, name: str) -> DataFrame:
        """The rows of a warehouse table as its builder gives them: no surrogate key, no defaults, nothing stored."""
        step = STEP_OF[name]
        return step.build(*[self.spark if i == "spark" else self.table(i) for i in step.inputs])

    def build(self, name: str) -> DataFrame:
        """Build a table anew. Rows of a dimension that were there keep their key, so facts stored before still refer to
        the same customers, products and sellers, whether or not the load gets as far as the facts."""
        if name == "fact_orders":
            return self._build_orders()
        rows, table = self.insert_rows(name), TABLES[name]
        if name.startswith("dim_") and table.identity and table.identity not in rows.columns:
            rows = self.store.written(f"{name}__rows", rows)  # read several times below
            if self.store.exists(name):
                stored = self.store.read(name).select(*table.business_key, table.identity)
                known = rows.join(stored, list(table.business_key))
                fresh = assign_keys(
                    unknown_rows(rows, stored, table.business_key), table.business_key, table.identity, highest_key(stored, table.identity)
                )
                return self.store.replace(name, table.shape(known.unionByName(fresh)))
        if name == SALES:
            return self.store.write_slices(name, table.shape(rows), month_slice())
        return self.store.replace(name, self._keyed(name, rows))

    def _build_orders(self) -> DataFrame:
        """The order fact, and the orders it leaves out for their delivery dates (QUARANTINE), from one run of its joins."""
        inputs = [self.table(name) for name in STEP_OF["fact_orders"].inputs]
        marked = self.store.written("fact_orders__rows", facts.marked_orders(*inputs), [facts.OUTSIDE])
        kept, aside = (marked.where(where).drop(facts.OUTSIDE) for where in (~F.col(facts.OUTSIDE), F.col(facts.OUTSIDE)))
        table = TABLES["fact_orders"]
        with self.store.together() as store:
            store.replace(QUARANTINE, aside)
            store.replace("fact_orders", table.shape(assign_keys_in_files(kept, table.identity)))
        return self.store.read("fact_orders")

    def refresh_sales(self) -> list[str] | None:
        """Bring the aggregate up to date with rows appended to the facts since it was written.

        Only the months of those rows are computed and written again: the months of new orders and lines, and of the
        orders of new reviews. Returns them, or None where all was built: there is no aggregate in slices yet, or a table
        it is made from was replaced since.
        """
        sales = self.store.parts(SALES)
        since = max((part.sequence for part in sales), default=0)
        stored = {name: self.store.parts(name) for name in STEP_OF[SALES].inputs}
        replaced = any(parts and parts[0].sequence > since for parts in stored.values())
        if not sales or replaced or any(part.slice is None for part in sales):
            self.build(SALES)
            return None
        months = set()
        for name, parts in stored.items():
            fresh = [part for part in parts if part.sequence > since and part.rows]
            if not fresh:
                continue
            if name not in DATED:  # a dimension that grew names rows that were there before
                self.build(SALES)
                return None
            rows = self.store.read(name, fresh)
            if name == "fact_reviews":
                rows = self.table("fact_orders").join(rows.select("order_id"), "order_id", "left_semi")
            # One row per calendar month at most.
            months |= {row.month for row in rows.select(F.expr("order_date_key div 100").alias("month")).distinct().collect()}
        if not months:
            return []
        in_months = F.expr("order_date_key div 100").isin(sorted(months))
        inputs = {name: self.table(name) for name in STEP_OF[SALES].inputs}
        for name in ("fact_order_items", "fact_orders"):
            days = F.col("order_date_key").between(min(months) * 100, max(months) * 100 + 99)  # reaches the scan
            inputs[name] = inputs[name].where(days & in_months)
        inputs["fact_reviews"] = inputs["fact_reviews"].join(inputs["fact_orders"].select("order_id"), "order_id", "left_semi")
        touched = [str(month) for month in sorted(months)]
        self.store.write_slices(SALES, TABLES[SALES].shape(facts.monthly_sales(*inputs.values())), month_slice(), touched)
        return touched

    def _keyed(self, name: str, rows: DataFrame, start: Column | int = 0) -> DataFrame:
        """Rows in the shape of the table, with surrogate keys after `start`.

        Keys of dimensions depend on their business keys only. Nothing refers to the keys of facts, so those follow the
        written rows, which spares the largest tables a shuffle; the joins behind a fact run once.
        """
        table = TABLES[name]
        if table.identity and table.identity not in rows.columns:
            if name.startswith("fact_"):
                rows = assign_keys_in_files(self.store.written(f"{name}__rows", rows), table.identity, start)
            else:
                rows = assign_keys(rows, table.business_key, table.identity, start)
        return table.shape(rows)

    def append(self, name: str, new_rows: DataFrame) -> DataFrame:
        """Append rows that are not stored yet; their keys go on after the highest one."""
        identity = TABLES[name].identity
        start = highest_key(self.table(name), identity) if identity else 0
        return self.store.append(name, self._keyed(name, new_rows, start))

    def append_new(self, name: str, rows: DataFrame) -> DataFrame:
        """Append the rows whose business key is not stored yet; stored rows and keys stay as they are."""
        return self.append(name, unknown_rows(rows, self.table(name), TABLES[name].business_key))

    def merge_rates(self, fetched: DataFrame) -> DataFrame:
        """Upsert fetched rates; rows that were there keep their key. Only the fetched currency pairs are read and
        written: each is a slice of its own."""
        name, table = "dim_exchange_rate", TABLES["dim_exchange_rate"]
        if not self.store.exists(name):
            self.store.write_slices(name, self.spark.createDataFrame([], table.schema()), pair_slice())
        elif any(part.slice is None and part.rows for part in self.store.parts(name)):
            self.store.write_slices(name, self.store.read(name), pair_slice())
        # One row per currency pair.
        pairs = [row.pair for row in fetched.select(pair_slice().alias("pair")).distinct().collect()]
        merged = self.store.written(f"{name}__merged", upsert_rates(self.store.read_slices(name, pairs), fetched))
        known = F.col(table.identity).isNotNull()
        fresh = merged.where(~known).drop(table.identity)
        start = highest_key(self.store.read(name), table.identity)
        keyed = merged.where(known).unionByName(assign_keys(fresh, table.business_key, table.identity, start))
        return self.store.write_slices(name, table.shape(keyed), pair_slice(), pairs)

    def register_views(self) -> None:
        """All stored tables as temporary views, and the converted orders as a view of their own, for SQL users."""
        for name in TABLES:
            if self.store.exists(name):
                self.table(name).createOrReplaceTempView(name)
        if self.store.exists("fact_orders") and self.store.exists("dim_exchange_rate"):
            converted = orders_pln(self.table("fact_orders"), self.table("dim_exchange_rate"))
            converted.createOrReplaceTempView(ORDERS_PLN_VIEW)

    def load(self, force: bool = False, log: TableStore | None = None) -> dict[str, str]:
        """Run all steps in order. Tables with rows are skipped unless forced. The tables become visible together, after
        the last step; a step that fails stops the load and leaves all of them as they were.

        Orders that the order fact leaves out for their delivery dates are stored under QUARANTINE. With a `log`, the
        checks run at the end and are recorded there.
        """
        done = {}
        with self.together() as target:
            for step in STEPS:
                if target.store.row_count(step.table) > 0 and not force and not step.always:
                    done[step.table] = "skipped"
                else:
                    target.build(step.table)
                    done[step.table] = "built"
        if log is not None:
            validation.audit(self.table, log)
        return done


def month_slice() -> Column:
    return F.format_string("%04d%02d", "year", "month")


def pair_slice() -> Column:
    return F.md5(F.concat_ws("|", *PAIR))


def staged(store: TableStore) -> Staging:
    """Staging tables as stored by the CSV load."""
    return {name: (lambda name=name: store.read(name)) for name in SOURCES}
