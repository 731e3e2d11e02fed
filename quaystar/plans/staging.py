"""Staging load: delivered CSV files -> typed staging tables, with rejects, and a manifest to resume from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystar.operators.ingest import (
    PLACE,
    accepted,
    bootstrap_manifest,
    first_per_key,
    load_counts,
    load_decisions,
    refuse_orphans,
    rejected,
    typed,
)
from quaystar.schema import SOURCES, Source
from quaystar.sources.csv_files import scan_csv
from quaystar.sources.tables import TableStore

MANIFEST = "load_manifest"


@dataclass(frozen=True)
class Loaded:
    """What a load of one table did; `failure` says why there was none, as when a file or the parent table is missing."""

    table: str
    loaded: int = 0
    duplicates: int = 0
    errors: int = 0
    failure: str | None = None


class StagingLoad:
    def __init__(self, spark: SparkSession, store: TableStore, folder: str):
        self.spark, self.store, self.folder = spark, store, folder.rstrip("/")

    def actual_counts(self) -> DataFrame:
        rows = [(name, self.store.row_count(name)) for name in SOURCES]
        return self.spark.createDataFrame(rows, "table_name string, actual bigint")

    def manifest(self) -> DataFrame:
        if self.store.exists(MANIFEST):
            return self.store.read(MANIFEST)
        return self.spark.createDataFrame([], "table_name string, recorded bigint")

    def _record(self, table: str, rows: int) -> None:
        other = self.manifest().where(F.col("table_name") != table)
        entry = self.spark.createDataFrame([(table, rows)], other.schema)
        self.store.replace(MANIFEST, other.unionByName(entry).coalesce(1))

    def load_table(self, source: Source) -> Loaded:
        """Load one table. Rows that cannot be stored go to <table>__rejects; only a clean load enters the manifest."""
        table = source.table
        scanned = scan_csv(self.spark, f"{self.folder}/{source.files}", source, placed=True)
        checked = typed(scanned, source)
        if source.parent:
            column, parent = source.parent
            checked = refuse_orphans(checked, column, self.store.read(parent), column)
        # Written once, since the counts, the good rows and the rejects are three readings.
        checked = self.store.written(f"{table}__checked", checked)
        counts = load_counts(checked, source.key).first()
        self.store.replace(f"{table}__rejects", rejected(checked).drop(PLACE))
        self.store.replace(table, first_per_key(accepted(checked), source.key))
        loaded, errors = self.store.row_count(table), self.store.row_count(f"{table}__rejects")
        if errors == 0:
            self._record(table, loaded)
        return Loaded(table, loaded, counts.duplicates, errors)

    def load_all(self, skip_existing: bool = True, reload: Sequence[str] = ()) -> list[Loaded]:
        """Load what the manifest does not show as complete, and the tables in `reload`.

        A table that fails does not stop the others; its place in the result says why it failed.
        """
        counts, manifest = self.actual_counts(), self.manifest()
        if reload:
            manifest = self.store.replace(MANIFEST, bootstrap_manifest(counts, manifest, reload).coalesce(1))
        action = {
            row.table_name: row.action for row in load_decisions(counts, manifest, reload, skip_existing).collect()
        }
        return [self._attempt(source) for source in SOURCES.values() if action[source.table] != "skip"]

    def _attempt(self, source: Source) -> Loaded:
        try:
            return self.load_table(source)
        except Exception as failure:  # whatever it is, the other tables are loaded, and the caller is told
            return Loaded(source.table, failure=f"{type(failure).__name__}: {failure}")
