"""The stored product history: first versions from the product dimension, then changes as they come."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystar.operators import scd2
from quaystar.operators.numbering import assign_keys, highest_key
from quaystar.plans.warehouse import Warehouse
from quaystar.schema import TABLES

NAME = "dim_product_scd2"
# Ended versions never change again, so they are only added to; a change rewrites the current ones.
CURRENT, ENDED = "current", "ended"


def _slice() -> Column:
    return F.when(F.col("is_current") == 1, CURRENT).otherwise(ENDED)


def load_history(warehouse: Warehouse) -> DataFrame:
    """The history; an empty one starts with the products as they are."""
    store, table = warehouse.store, TABLES[NAME]
    if store.row_count(NAME) > 0:
        whole = any(part.slice is None for part in store.parts(NAME))
        return store.write_slices(NAME, store.read(NAME), _slice()) if whole else store.read(NAME)
    first = scd2.initial_versions(warehouse.table("dim_product"))
    return store.write_slices(NAME, table.shape(assign_keys(first, table.business_key, table.identity)), _slice())


def change_products(warehouse: Warehouse, changes: DataFrame, change_time: datetime) -> DataFrame:
    """Close the versions the changes end and open the new ones. `changes` has one row per product.

    Current versions are written once, into what stays current and what has ended; new versions are added to them. Both
    become visible together. Versions that ended before are read for their highest key only.
    """
    table = TABLES[NAME]
    load_history(warehouse)
    with warehouse.store.together() as store:
        current = store.read_slices(NAME, [CURRENT])
        store.write_slices(NAME, scd2.close_changed(current, changes, change_time), _slice(), [CURRENT])
        opened = scd2.opened(store.read_slices(NAME, [CURRENT]), changes, change_time)
        opened = store.written(f"{NAME}__opened", opened)
        keyed = assign_keys(opened, table.business_key, table.identity, highest_key(store.read(NAME), table.identity))
        store.write_slices(NAME, table.shape(keyed), _slice(), [])
    return warehouse.store.read(NAME)
