"""CSV scan: header, UTF-8 with byte-order mark, doubled quotes, values with line breaks. All columns come as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaystar.operators.ingest import PLACE, null_tokens
from quaystar.schema import Source
from quaystar.session import shared_folder

OPTIONS = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
BYTE_ORDER_MARK = "﻿"


# A field of a line that is not inside a quoted value. A quote opens a value only where the field begins, and closes it
# only before a comma or the end; inside, it is doubled, or else stands for itself.
_INSIDE = r'[^"]*+(?:(?:""|"(?![",]|\z))[^"]*+)*+"'
_FIELD = rf'(?:"{_INSIDE}(?=,|\z)|(?!")[^,]*+)'
ENDS_OUTSIDE = rf"^(?:{_FIELD},)*+{_FIELD}\z"
CLOSES = rf"^{_INSIDE}(?:,{_FIELD})*+\z"


def scan_csv(spark: SparkSession, path: str, source: Source, placed: bool = False) -> DataFrame:
    """The source's columns by header name, null tokens resolved; header names may carry quotes or the mark. With `placed`
    also PLACE, which sorts the rows as they stand in the files, and the files by path.

    Every file is read by its own header, so files may differ in the order of their columns. The headers are read file by
    file, one row each; files of the same header are scanned together.
    """
    scans = None
    for columns, files in _files_by_header(spark, path).items():
        if source.free_text:
            rows, place = scan_split_csv(spark, files, list(columns), placed), F.col(PLACE)
        else:
            # A block is read from its start to its end by one task, so the numbers within it rise.
            rows, place = spark.read.options(header=True, **OPTIONS).csv(files), _place(F.monotonically_increasing_id())
        named = {name.strip(BYTE_ORDER_MARK).strip('"'): F.col(f"`{name}`") for name in rows.columns}
        missing = [column.name for column in source.columns if column.name not in named]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)}")
        chosen = [named[column.name].alias(column.name) for column in source.columns]
        scan = null_tokens(rows.select(*chosen, *([place.alias(PLACE)] if placed else [])))
        scans = scan if scans is None else scans.unionByName(scan)
    return scans


def _place(number: Column) -> Column:
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return F.struct(file, block, number.alias("number"))


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files listed, not read: the content column is left out."""
    found: dict[tuple[str, ...], list[str]] = {}
    for row in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect():
        columns = spark.read.options(header=True, **OPTIONS).csv(row.path).columns
        found.setdefault(tuple(columns), []).append(row.path)
    return found


def _states(rows: DataFrame, partition: list[str], order: str, out0: str, out1: str) -> DataFrame:
    """`rows` plus from0 and from1: the state (1: inside a quoted value) before each row, if the partition begins outside
    or inside one.

    A row ends in the state out0 or out1, if it begins outside or inside. It keeps the state, turns it round, or sets it
    whatever it was; so the state comes from the last row that set it and the number of turns since.
    """
    window = Window.partitionBy(*partition).orderBy(order)
    sets = F.col(out0) == F.col(out1)
    turn = F.when((F.col(out0) == 1) & (F.col(out1) == 0), 1).otherwise(0)
    counted = rows.withColumn("_turns", F.sum(turn).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(sets, F.struct(F.col(out0).alias("state"), F.col("_turns").alias("turns"))), ignorenulls=True)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("_turns") - turn
    known = counted.withColumn("_set", last.over(before))
    since = (F.col("_set.state") + turns - F.col("_set.turns")) % 2
    return (
        known.withColumn("from0", F.coalesce(since, turns % 2).cast("int"))
        .withColumn("from1", F.coalesce(since, (turns + 1) % 2).cast("int"))
        .drop("_turns", "_set")
    )


def scan_split_csv(spark: SparkSession, files: str | list[str], columns: list[str], placed: bool = False) -> DataFrame:
    """CSV whose quoted values hold line breaks, read in blocks like any text file.

    The multiLine option reads a file in one task. Here every line is read on its own; a line starts a record if it does
    not begin inside a quoted value. Per block the lines are followed for both states in which it may begin, the blocks
    of a file are chained (one row per block), and only records of several lines are grouped. A quote in a value that is
    not quoted is an ordinary character. A file that ends inside a quoted value is refused. With `placed` the rows come
    with PLACE, that of their first line.
    """
    text = F.regexp_replace("value", "\\r\\z", "")
    after = [F.when(text.rlike(pattern), 0).otherwise(1) for pattern in (ENDS_OUTSIDE, CLOSES)]
    lines = (
        spark.read.option("lineSep", "\n")
        .text(files)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            after[0].alias("out0"),
            after[1].alias("out1"),
        )
    )
    in_block = Window.partitionBy("file", "block").orderBy("position")
    numbered = _states(lines.withColumn("line", F.row_number().over(in_block)), ["file", "block"], "line", "out0", "out1")
    # Written once: a second scan could cut the files into other blocks, if executors have come or gone meanwhile.
    shared_folder(spark)
    numbered = numbered.drop("position").checkpoint()

    def end(state: str) -> Column:
        return F.max_by(F.when(F.col(state) == 0, F.col("out0")).otherwise(F.col("out1")), "line")

    # Blocks are bounded by spark.sql.files.maxPartitionBytes, so this table has one row per that many bytes.
    blocks = numbered.groupBy("file", "block").agg(
        end("from0").alias("end0"),
        end("from1").alias("end1"),
        F.max(F.when(F.col("from0") == 0, F.col("line"))).alias("last0"),
        F.max(F.when(F.col("from1") == 0, F.col("line"))).alias("last1"),
    )
    of_file = Window.partitionBy("file").orderBy("block")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    begins_outside = F.col("from0") == 0  # a file begins outside
    chained = _states(blocks, ["file"], "block", "end0", "end1")
    chained = (
        chained.withColumn("ends", F.when(begins_outside, F.col("end0")).otherwise(F.col("end1")))
        .withColumn("file_ends", F.last("ends").over(of_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("last_line", F.when(begins_outside, F.col("last0")).otherwise(F.col("last1")))
        .withColumn("last_start", F.when(F.col("last_line").isNotNull(), F.struct("block", "last_line")))
        .withColumn("carried", F.last("last_start", ignorenulls=True).over(earlier))
        .select(
            "file",
            "block",
            F.col("from0").alias("block_state"),
            "carried",
            F.when(F.col("file_ends") == 1, F.raise_error(F.concat(F.lit("unpaired quote in "), "file")))
            .otherwise(F.lit(0))
            .alias("refused"),
        )
    )
    state = F.when(F.col("block_state") == 0, F.col("from0")).otherwise(F.col("from1"))
    lines_at = (
        numbered.join(chained, ["file", "block"])
        .withColumn("starts", state + F.coalesce("refused", F.lit(0)) == 0)
        .where(~((F.col("block") == 0) & (F.col("line") == 1)))  # the header
    )
    whole = F.col("starts") & (F.col("out0") == 0)
    alone = lines_at.where(whole).select("value", F.struct("file", "block", F.col("line").cast("long").alias("number")).alias(PLACE))
    # The start of the record a line belongs to: in its block, or carried over from an earlier one.
    up_to_here = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    start = F.max(F.when(F.col("starts"), F.col("line"))).over(up_to_here)
    pieces = lines_at.withColumn("start", start).where(~whole)
    joined = (
        pieces.withColumn(
            "record",
            F.when(F.col("start").isNull(), F.col("carried")).otherwise(
                F.struct(F.col("block"), F.col("start").alias("last_line"))
            ),
        )
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
        .select(
            F.array_join(F.col("lines.value"), "\n").alias("value"),
            F.struct("file", F.col("record.block").alias("block"), F.col("record.last_line").cast("long").alias("number")).alias(PLACE),
        )
    )
    schema = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    records = (
        alone.unionByName(joined)
        .select(F.regexp_replace("value", "\\r\\z", "").alias("value"), PLACE)
        .where(F.col("value") != "")
    )
    # As a generator, each record is parsed once; as a plain expression it would be once per use of a column.
    parsed = F.from_csv("value", schema, {**OPTIONS, "multiLine": "true"})
    if placed:
        return records.select(F.inline(F.array(parsed)), PLACE).toDF(*columns, PLACE)
    return records.select(F.inline(F.array(parsed))).toDF(*columns)
