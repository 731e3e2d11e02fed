"""What the operators of this package share: words of a text, free column names, stored intermediates, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quaystar.session import shared_folder

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free_name(rows: DataFrame, wanted: str) -> str:
    """`wanted`, or that name with underscores before it until no column of `rows` has it (case does not count)."""
    taken = {name.lower() for name in rows.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and not again when an executor is lost."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def bucketed(rows: DataFrame, name: str, column: str) -> DataFrame:
    """Like `stored`, as a table in buckets by `column`: joins and groups on that column read it where it lies, so the side
    of these rows is not shuffled again for each of them. Rows are written by the tasks that made them, not moved first."""
    spark = rows.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/llm/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, column).format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name).select(*rows.columns)


def written_place() -> Column:
    """Where a row of a written Parquet table stands: the number of its part file, that file's name, the row in it."""
    file = F.col("_metadata.file_name")
    part = F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("long")
    return F.struct(part.alias("part"), file.alias("file"), F.col("_metadata.row_index").alias("row"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: bytes.split() parts at exactly these six characters."""
    return text.split()


def with_text_columns(
    rows: DataFrame, text: str, added: StructType, measure: Callable[[list[bytes]], Sequence[Sequence]]
) -> DataFrame:
    """`rows` plus the columns `added`, which `measure` gives for a batch of texts, one list for each column.

    The other columns go through unchanged as Arrow buffers. The names in `added` must be free.
    """
    at = rows.columns.index(text)

    def run(batches: Batches) -> Batches:
        from pyspark.sql.pandas.types import to_arrow_schema

        new = to_arrow_schema(added)
        for batch in batches:
            values = measure(utf8(batch.column(at)))
            arrays = [pa.array(value, kind) for value, kind in zip(values, new.types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *new.names])

    return rows.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in rows.schema] + list(added)))


def connected(links: DataFrame) -> DataFrame:
    """node, root: for the nodes of the links a, b (bigint), the smallest node that can be reached.

    Large-star and small-star steps in turn until the links no longer change: each node links to the smallest node it
    knows, so a chain of n nodes takes about log n rounds. The smallest neighbours come from an aggregate, which Spark
    reduces before the shuffle, so a node with very many links is no burden. Every round is a stored table.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    before = None
    while True:
        # Large star: every larger neighbour of a node links to the smallest of them all.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: the smaller neighbours of a node, and the node, link to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        edges = stored(small, "links")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first())
        # All links in stars (each node has one link, and it links to a root) and nothing moved.
        if state[:2] == before:
            break
        before = state[:2]
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
