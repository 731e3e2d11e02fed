"""Staging load steps: null tokens, typed columns with rejects, key and foreign-key checks, load counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystar.schema import Source

# Texts that stand for NULL.
NULL_TOKENS = ["", "nan"]
# Where a scanned row stands: file, block of the file, row or line in it. Rows that have it keep it until first_per_key.
PLACE = "_place"


def null_tokens(rows: DataFrame) -> DataFrame:
    """Null tokens become NULL; other values lose surrounding double quotes."""
    return rows.select(
        *[
            F.col(name) if name == PLACE else F.when(~F.col(name).isin(NULL_TOKENS), F.btrim(F.col(name), F.lit('"'))).alias(name)
            for name in rows.columns
        ]
    )


def typed(rows: DataFrame, source: Source) -> DataFrame:
    """Text columns -> declared types, plus `_errors`: the columns whose value cannot be stored, as a list text.

    A value is refused if it cannot be cast, is no finite number, is longer than the column, or is NULL in a NOT NULL
    column.
    """
    values, errors = [], []
    for column in source.columns:
        raw = F.col(column.name)
        value = raw if column.type == "string" else raw.try_cast(column.type)
        refused = raw.isNotNull() & value.isNull()
        if column.type in ("double", "float"):
            refused = refused | F.isnan(value) | (F.abs(value) == float("inf"))
        if not column.nullable:
            refused = refused | raw.isNull()
        if column.max_length:
            refused = refused | (F.length(raw) > column.max_length)
        values.append(value.alias(column.name))
        errors.append(F.when(refused, F.lit(column.name)))
    place = [PLACE] if PLACE in rows.columns else []
    return rows.select(*values, *place, F.concat_ws(",", *errors).alias("_errors"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("_errors") == "").drop("_errors")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("_errors") != "")


def first_per_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the first by its place in the files, which goes; without one, in the order of all other columns.

    Spark keeps one row per key and task before the shuffle, so a key that holds a large share of the rows is no burden.
    """
    others = [PLACE] if PLACE in rows.columns else [name for name in rows.columns if name not in key]
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*others))
    return rows.withColumn("_position", position).where(F.col("_position") == 1).drop("_position", PLACE)


def refuse_orphans(checked: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Typed rows whose parent is missing are refused like those with a bad value, with the column as their error.

    This goes before first_per_key: a refused row must not take the place of a good one with the same key.
    """
    known = parent.select(F.col(parent_key).alias("_parent")).where(F.col("_parent").isNotNull()).distinct()
    astray = (F.col("_errors") == "") & F.col(column).isNotNull() & F.col("_parent").isNull()
    return checked.join(known, F.col(column) == F.col("_parent"), "left").select(
        *[c for c in checked.columns if c != "_errors"], F.when(astray, column).otherwise(F.col("_errors")).alias("_errors")
    )


def with_parent(rows: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return rows.join(parent.select(F.col(parent_key).alias(column)), column, "left_semi").select(*rows.columns)


def orphans(rows: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return rows.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti").select(*rows.columns)


def load_counts(checked: DataFrame, key: Sequence[str]) -> DataFrame:
    """loaded / duplicates / errors of one typed table in one pass over (key, error flag).

    Rows are first counted per key, so a repeated key is one row per task when it is shuffled.
    """
    refused = F.col("_errors") != ""
    per_key = checked.groupBy(*[F.when(~refused, F.col(c)).alias(c) for c in key], refused.alias("_refused")).agg(
        F.count("*").alias("_rows")
    )
    good = ~F.col("_refused")
    return per_key.agg(
        F.count_if(good).alias("loaded"),
        _zero(F.sum(F.when(good, F.col("_rows") - 1))).alias("duplicates"),
        _zero(F.sum(F.when(F.col("_refused"), F.col("_rows")))).alias("errors"),
    )


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def load_decisions(
    counts: DataFrame, manifest: DataFrame, reload: Sequence[str] = (), skip_existing: bool = True
) -> DataFrame:
    """What to do with each table: `counts` (table_name, actual) against `manifest` (table_name, recorded).

    skip: recorded = actual; reload: rows are there but not the recorded number, or a reload is asked for; load: empty.
    """
    forced = F.col("table_name").isin(list(reload)) if reload else F.lit(False)
    complete = F.col("recorded").isNotNull() & (F.col("recorded") == F.col("actual"))
    skip = complete & ~forced if skip_existing else F.lit(False)
    return counts.join(manifest, "table_name", "left").select(
        "table_name",
        "actual",
        "recorded",
        F.when(skip, "skip").when(F.col("actual") > 0, "reload").otherwise("load").alias("action"),
    )


def bootstrap_manifest(counts: DataFrame, manifest: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Manifest plus the non-empty tables it does not name yet; tables in `exclude` are left out of the addition."""
    added = counts.join(manifest, "table_name", "left_anti").where(F.col("actual") > 0)
    if exclude:
        added = added.where(~F.col("table_name").isin(list(exclude)))
    return manifest.unionByName(added.select("table_name", F.col("actual").alias("recorded")))
