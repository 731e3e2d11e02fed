"""Delta load of a stored warehouse: append the facts of new source rows, then renew the months they touch."""

from __future__ import annotations

from quaystar.operators.delta import new_order_items, new_orders
from quaystar.plans.warehouse import Warehouse

INPUTS = {
    "fact_orders": ("orders", "order_items", "dim_customer", "dim_order_status", "dim_date"),
    "fact_order_items": ("order_items", "orders", "dim_customer", "dim_product", "dim_seller", "dim_date"),
}


def load_delta(warehouse: Warehouse) -> dict[str, int]:
    """Rows appended per fact table; they and the aggregate become visible together. Running it again appends nothing."""
    appended = {}
    with warehouse.together() as target:
        for name, find_new in (("fact_orders", new_orders), ("fact_order_items", new_order_items)):
            stored = target.table(name)
            before = target.store.row_count(name)
            target.append(name, find_new(stored, *[target.table(source) for source in INPUTS[name]]))
            appended[name] = target.store.row_count(name) - before
        target.refresh_sales()
    return appended
