"""Stored tables: Parquet folders that are written once and named by a commit list.

Parquet cannot change rows in place, and a job must not overwrite the folder it reads. So each write goes to a new
folder, and rows appended to the commit list make it visible. A replace starts a table anew, an append adds a folder to
it. A table may be stored in slices (months, current and ended versions), each in folders of its own, and a write may
replace some of them. A job that dies before its commit leaves the tables as they were, and can be run again.

The writes of a `together` block are committed as one file of the commit list, so all of them become visible or none. A
store reads the list when it is opened: it sees those commits and its own, whatever others do meanwhile.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

COMMITS = (
    "sequence bigint, table_name string, mode string, folder string, row_count bigint, committed_at timestamp, slice string"
)
# Kinds of intermediate rows: what follows the table and two underscores in their folder's name.
INTERMEDIATE = ("checked", "rows", "merged", "closed", "opened")
SLICE = "table_slice"
SLICE_NAME = re.compile(r"[A-Za-z0-9.-]+")  # nothing that a folder's name would spell differently


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int
    slice: str | None = None
    sequence: int = 0


@dataclass(frozen=True)
class Write:
    """One row of the commit list. mode: replace (the table), slice (its part of that name), append."""

    table: str
    mode: str
    part: Part


class TableStore:
    """Tables under one root folder, written by one load at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._parts: dict[str, list[Part]] = {}
        self._schemas: dict[str, StructType] = {}
        self._sequence = 0
        for row in self._committed():
            self._apply(Write(row.table_name, row.mode, Part(row.folder, row.row_count, row.slice, row.sequence)))

    def _committed(self) -> list:
        try:
            # One row per table or slice written, so the list is short however large the tables are.
            return self.commits().orderBy("sequence").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []  # nothing was ever written here

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/_commits")

    def _apply(self, write: Write) -> None:
        stored, part = self._parts.get(write.table, []), write.part
        kept = {"append": stored, "slice": [p for p in stored if p.slice != part.slice]}.get(write.mode, [])
        self._parts[write.table] = [*kept, part]
        self._sequence = part.sequence

    def _numbered(self, writes: Sequence[Write]) -> list[Write]:
        return [replace(w, part=replace(w.part, sequence=k)) for k, w in enumerate(writes, self._sequence + 1)]

    def _commit(self, writes: Sequence[Write]) -> None:
        """Make the writes visible, all or none: their rows are one file."""
        writes = self._numbered(writes)
        rows = [
            F.struct(
                F.lit(write.part.sequence).cast("bigint").alias("sequence"),
                F.lit(write.table).alias("table_name"),
                F.lit(write.mode).alias("mode"),
                F.lit(write.part.folder).alias("folder"),
                F.lit(write.part.rows).cast("bigint").alias("row_count"),
                F.current_timestamp().alias("committed_at"),
                F.lit(write.part.slice).cast("string").alias("slice"),
            )
            for write in writes
        ]
        listed = self.spark.range(1).select(F.inline(F.array(*rows)))
        listed.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        for write in writes:
            self._apply(write)

    @contextmanager
    def together(self) -> Iterator[TableStore]:
        """A store that sees its own writes; they are committed as one when the block ends, and not at all if it fails.

        Until then this store, and any that is opened, has the tables as they were.
        """
        draft = _Draft(self)
        yield draft
        if draft.writes:
            self._commit(draft.writes)
            self._schemas.update(draft.own_schemas)

    def written(self, table: str, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Intermediate rows, read back from the shared folder, one subfolder per value of `by`; they are no table."""
        return self._put(f"{table}/{uuid.uuid4().hex}", rows, by)

    def _put(self, folder: str, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        rows.write.partitionBy(*by).parquet(f"{self.root}/{folder}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")

    def _write(self, table: str, rows: DataFrame, mode: str) -> DataFrame:
        folder, counted = f"{table}/{uuid.uuid4().hex}", Observation()
        self._put(folder, rows.observe(counted, F.count(F.lit(1)).alias("rows")))
        self._schemas[table] = rows.schema
        self._commit([Write(table, mode, Part(folder, counted.get["rows"]))])
        return self.read(table)

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        return self._write(table, rows, "replace")

    def append(self, table: str, rows: DataFrame) -> DataFrame:
        return self._write(table, rows, "append")

    def write_slices(self, table: str, rows: DataFrame, by: Column, replaced: Collection[str] | None = None) -> DataFrame:
        """Store rows by slice: `by` names the slice of a row, from few names in all, as each is listed here.

        The slices in `replaced` hold these rows only, so those without rows are emptied; rows of other slices are added
        to them. Without `replaced` the whole table is replaced. Files of slices that get no rows stay as they are.
        """
        folder = f"{table}/{uuid.uuid4().hex}"
        # Rows of one slice come to few tasks, large slices to several.
        sliced = rows.withColumn(SLICE, by).hint("rebalance", F.col(SLICE))
        sliced.write.partitionBy(SLICE).parquet(f"{self.root}/{folder}")
        schema = StructType([*rows.schema, StructField(SLICE, StringType())])
        counts = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}").groupBy(SLICE).count().collect()
        found = {row[SLICE]: row["count"] for row in counts}
        odd = [name for name in (*found, *(replaced or ())) if not name or not SLICE_NAME.fullmatch(name)]
        if odd:
            raise ValueError(f"{table}: no slice can be named {odd[0]!r}")
        parts = [Part(f"{folder}/{SLICE}={name}", found[name], name) for name in sorted(found)]
        empty = sorted(set(replaced or ()) - set(found)) if replaced is not None else [] if found else [None]
        if empty:
            none = f"{table}/{uuid.uuid4().hex}"
            self._put(none, rows.limit(0))
            parts += [Part(none, 0, name) for name in empty]
        if replaced is None:
            modes = ["replace"] + ["append"] * (len(parts) - 1)
        else:
            modes = ["slice" if part.slice in replaced else "append" for part in parts]
        self._schemas[table] = rows.schema
        if parts:
            self._commit([Write(table, mode, part) for mode, part in zip(modes, parts)])
        return self.read(table)

    def vacuum(self) -> list[str]:
        """Delete the folders of tables that no commit names any more: replaced tables and intermediate rows.

        A folder written in slices goes when none of them is in use. For times when nothing reads or writes the store;
        frames made before may read folders that go. Returns them.
        """
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.root)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        named = {"/".join(part.folder.split("/")[:2]) for parts in self._parts.values() for part in parts}
        tables = set(self._parts) | {f"{table}__{kind}" for table in self._parts for kind in INTERMEDIATE}
        gone = []
        for table in sorted(tables):
            path = hadoop.Path(root, table)
            for status in system.listStatus(path) if system.exists(path) else []:
                folder = f"{table}/{status.getPath().getName()}"
                if folder not in named and system.delete(status.getPath(), True):
                    gone.append(folder)
        return gone

    def row_count(self, table: str) -> int:
        """Rows as recorded by the commits; 0 for an unknown table."""
        return sum(part.rows for part in self._parts.get(table, []))

    def exists(self, table: str) -> bool:
        return table in self._parts

    def parts(self, table: str) -> list[Part]:
        """The folders a table consists of now, in the order of their commits."""
        return list(self._parts.get(table, []))

    def read(self, table: str, parts: Sequence[Part] | None = None) -> DataFrame:
        """The table, or the rows of some of its parts."""
        folders = dict.fromkeys(f"{self.root}/{part.folder}" for part in (self._parts[table] if parts is None else parts))
        reader = self.spark.read
        if table in self._schemas:
            reader = reader.schema(self._schemas[table])
        return reader.parquet(*folders)

    def read_slices(self, table: str, names: Collection[str]) -> DataFrame:
        """The rows of some slices; other slices are not read."""
        chosen = [part for part in self._parts[table] if part.slice in names]
        return self.read(table, chosen) if chosen else self.read(table).limit(0)


class _Draft(TableStore):
    """Writes that are not committed yet, over the tables of a store."""

    def __init__(self, store: TableStore):
        self.spark, self.root, self.writes = store.spark, store.root, []
        self._parts, self._schemas, self._sequence = dict(store._parts), dict(store._schemas), store._sequence

    @property
    def own_schemas(self) -> dict[str, StructType]:
        return {write.table: self._schemas[write.table] for write in self.writes}

    def _commit(self, writes: Sequence[Write]) -> None:
        for write in self._numbered(writes):
            self.writes.append(write)
            self._apply(write)
