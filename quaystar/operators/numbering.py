"""Numbering over whole tables without a single-task sort.

A window without PARTITION BY sorts the whole table in one task. The operators here number in balanced tasks: keys by
hash bucket, or by place in files already written; ordered positions, over the table or inside groups, by range
partition. Each has one plan for every size of table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quaystar.session import shared_folder

# Hex digits of the hash that make a bucket: 16**4 = 65,536 buckets, about 1.5 million rows each for 10**11 rows.
BUCKET_DIGITS = 4


def hash_bucket(columns: Sequence[str], digits: int = BUCKET_DIGITS) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns])), 1, digits)


def assign_keys(
    rows: DataFrame, business_key: Sequence[str], key: str, start: Column | int = 0, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Dense surrogate keys start+1, start+2, … in the order (hash bucket, business key).

    The bucket sizes (at most 16**digits rows) are summed up and broadcast, and the rows are numbered per bucket. The
    result depends on the rows only, so a lost executor recomputes the same keys. The input is read twice: hand in a
    stored table rather than a long join.
    """
    bucketed = rows.withColumn("_bucket", hash_bucket(business_key, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    start = F.lit(start) if isinstance(start, int) else start
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*business_key))
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .select((start + F.col("_offset") + F.col("_position")).cast("long").alias(key), *rows.columns)
    )


def assign_keys_in_files(written: DataFrame, key: str, start: Column | int = 0) -> DataFrame:
    """Dense surrogate keys for Parquet rows as read from their files: no shuffle and no sort of the rows.

    Written files do not change, so file name and row index are a fixed place. The offsets have one row per file.
    """
    file, row = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy(file).count().select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    start = F.lit(start) if isinstance(start, int) else start
    return (
        written.select("*", file, row)
        .join(F.broadcast(offsets), "_file")  # one row per written file
        .select((start + F.col("_offset") + F.col("_row") + 1).cast("long").alias(key), *written.columns)
    )


def unknown_rows(rows: DataFrame, existing: DataFrame, business_key: Sequence[str]) -> DataFrame:
    """The rows whose business key is not there yet."""
    return rows.join(existing.select(*business_key), list(business_key), "left_anti").select(*rows.columns)


def highest_key(existing: DataFrame, key: str) -> Column:
    return existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()


def append_keys(new_rows: DataFrame, existing: DataFrame, business_key: Sequence[str], key: str) -> DataFrame:
    """Keys for the rows whose business key is not there yet; they go on after the highest key in use."""
    unknown = unknown_rows(new_rows, existing, business_key)
    return assign_keys(unknown, business_key, key, highest_key(existing, key))


def global_positions(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """1, 2, 3, … over the whole table in the given (ascending) order.

    Range partition, sort, checkpoint: the sampled range bounds are fixed once written, so the partition sizes and the
    positions are taken from the same partitions even when an executor is lost.
    """
    shared_folder(rows.sparkSession)
    written = rows.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    part = F.spark_partition_id()
    placed = written.withColumn("_part", part).withColumn(
        "_index", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *rows.columns, (F.col("_offset") + F.col("_index") + 1).alias(name)
    )


def tile_of(position: Column, rows: int, tiles: int) -> Column:
    """NTILE from a position: the first rows % tiles tiles hold one row more than the others."""
    small, larger_tiles = divmod(rows, tiles)
    in_larger = larger_tiles * (small + 1)
    return (
        F.when(position <= in_larger, F.ceil(position / (small + 1)))
        .otherwise(larger_tiles + F.ceil((position - in_larger) / max(small, 1)))
        .cast("int")
    )


def ntile_over_all(rows: DataFrame, order: Sequence[str], tiles: int, name: str, row_count: int) -> DataFrame:
    """NTILE over the whole table. `order` must end in a unique column, so that ties have one result."""
    placed = global_positions(rows, order, "_position")
    return placed.withColumn(name, tile_of(F.col("_position"), row_count, tiles)).drop("_position")


def positions_in_group(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """row_number() per group, also when one group, NULL too, holds a large share of the table.

    The rows are range partitioned by group and order and checkpointed, so a large group lies in several partitions. Rows
    are numbered per partition and group; before those come the rows of the group in earlier partitions, which only
    groups at the edge of a partition have: two rows per partition at most.
    """
    shared_folder(rows.sparkSession)
    written = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).checkpoint()
    placed = written.withColumn("_part", F.spark_partition_id()).withColumn("_index", F.monotonically_increasing_id())
    of_part = placed.groupBy("_part", F.col(group).alias("_group")).agg(F.count("*").alias("_rows"), F.min("_index").alias("_from"))
    in_part = Window.partitionBy("_part")
    edges = of_part.withColumn("_first", F.min("_from").over(in_part)).withColumn("_last", F.max("_from").over(in_part))
    edges = edges.where((F.col("_from") == F.col("_first")) | (F.col("_from") == F.col("_last")))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = edges.select("_group", F.col("_part").alias("_of"), F.sum("_rows").over(earlier).alias("_before"))
    before = F.broadcast(before.where("_before > 0"))
    # The rows of a group lie next to each other in a partition, so they are numbered where they are, without a shuffle.
    inside = placed.mapInArrow(_numbered_runs(group), StructType([*placed.schema.fields, StructField("_inside", LongType())]))
    return (
        inside.join(before, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")), "left")
        .select(*rows.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("int").alias(name))
    )


def _numbered_runs(group: str):
    """1, 2, 3, … along each run of equal `group` values (NULL equal to NULL) in a partition, also across its batches."""

    def number(batches):
        last, carried = None, 0  # the group value that ended the batch before, and its rows so far
        for batch in batches:
            keys, n = batch.column(group), batch.num_rows
            if n == 0:
                yield batch.append_column("_inside", pa.array([], pa.int64()))
                continue
            previous = keys.slice(0, 1) if last is None else last
            before = pa.concat_arrays([previous, keys.slice(0, n - 1)])
            differs = pc.fill_null(pc.not_equal(keys, before), pc.xor(pc.is_null(keys), pc.is_null(before)))
            starts = np.asarray(differs.to_numpy(zero_copy_only=False), dtype=bool)
            if last is None:
                starts[0] = True
            index = np.arange(n)
            position = index - np.maximum.accumulate(np.where(starts, index, 0)) + 1
            if not starts[0]:
                first_run = np.argmax(starts) if starts.any() else n
                position[:first_run] += carried
            last, carried = keys.slice(n - 1, 1), int(position[-1])
            yield batch.append_column("_inside", pa.array(position, pa.int64()))

    return number
