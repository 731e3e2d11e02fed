"""Best-fit packing of documents into training sequences of a fixed number of words, under conflicts.

A sequence (bin) holds at most one piece of each source and of each cluster of duplicates. Bins are ordered by what room
they have left and carry a bitmap of sources and one of clusters; the search for a piece starts at the tightest bin that
has the room and goes on to the next until one has no conflict. Pieces are dealt to shards of about the same size, by a
hash or, where the documents have an order, as runs of it, and each shard is packed by itself, largest piece first: a
shard is a fixed number of narrow rows at any volume.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quaystar.llm.common import stored, with_text_columns, words_of, written_place

CAPACITY = 2048
SHARD_PIECES = 4096
RESULT = "doc_id {id}, source {source}, start long, n_words long, bin string, bin_start long"


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset in the bin of each piece. A null source or cluster conflicts with nothing."""
    bit = {source: 1 << k for k, source in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    repeated = [c for c, n in Counter(clusters).items() if n > 1 and c is not None]
    cluster_bit = {cluster: 1 << k for k, cluster in enumerate(repeated)}
    room: list[tuple[int, int]] = []  # (words left, bin), in order
    bin_sources: list[int] = []
    bin_clusters: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size, source, cluster = sizes[item], bit.get(sources[item], 0), cluster_bit.get(clusters[item], 0)
        at = bisect_left(room, (size, -1))
        while at < len(room) and (bin_sources[room[at][1]] & source or bin_clusters[room[at][1]] & cluster):
            at += 1
        if at < len(room):
            left, chosen = room.pop(at)
        else:
            left, chosen = capacity, len(bin_sources)
            bin_sources.append(0)
            bin_clusters.append(0)
        bins[item], offsets[item] = chosen, capacity - left
        bin_sources[chosen] |= source
        bin_clusters[chosen] |= cluster
        insort(room, (left - size, chosen))
    return bins, offsets


def with_length_and_cluster(docs: DataFrame, text: str) -> DataFrame:
    """`docs` plus n_words and cluster: equal where texts differ in case and white space only."""
    added = StructType([StructField("n_words", LongType()), StructField("cluster", LongType())])

    def measure(texts: list[bytes]) -> list[list[int]]:
        words = [words_of(text.lower()) for text in texts]
        hashes = [xxhash.xxh3_64_intdigest(b" ".join(w)) for w in words]
        return [[len(w) for w in words], np.array(hashes, np.uint64).view(np.int64)]

    return with_text_columns(docs, text, added, measure)


def pieces(
    docs: DataFrame, capacity: int, text: str = "text", doc_id: str = "doc_id", source: str = "source", order: Column | None = None
) -> DataFrame:
    """doc_id, source, cluster, ordinal, start, n_words: a document longer than a bin is cut into full bins and a rest."""
    ordinal = F.lit(None).cast("long") if order is None else order
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), ordinal.alias("ordinal"), F.col(text).alias("text")
    )
    rows = with_length_and_cluster(slim, "text").drop("text")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_words") - 1, F.lit(0)), F.lit(capacity).cast("long"))
    kept = ("doc_id", "source", "cluster", "ordinal")
    return rows.select(*kept, F.explode(starts).alias("start"), F.col("n_words").alias("whole")).select(
        *kept, "start", F.least(F.col("whole") - F.col("start"), F.lit(capacity)).alias("n_words")
    )


def _numbered(cut: DataFrame) -> DataFrame:
    """The pieces plus place, their number (from 0) in the order of ordinal and start.

    They are written in that order; the number is then the row in the part file and what the files before it hold, and
    only the counts of the files go through the driver.
    """
    ordered = stored(cut.orderBy("ordinal", "start"), "ordered_pieces")
    at = ordered.withColumn("at", written_place())
    files = sorted(tuple(row) for row in at.groupBy("at.part", "at.file").count().collect())
    before, offsets = 0, []
    for _, file, rows in files:
        offsets.append((file, before))
        before += rows
    known = cut.sparkSession.createDataFrame(offsets, "file string, before long")
    joined = at.join(F.broadcast(known), F.col("at.file") == F.col("file"))
    return joined.withColumn("place", F.col("before") + F.col("at.row")).drop("at", "file", "before")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    order: Column | None = None,
) -> DataFrame:
    """doc_id, source, start, n_words, bin, bin_start: where each piece of each document goes.

    All words of all documents are packed. A text without words, or null, is a piece of no words. A null source conflicts
    with none. Repeated rows are pieces of their own, of one cluster, and so never share a bin. An empty table gives an
    empty result. Pieces are written once before they are dealt out, so a lost executor finds the same shards again.

    With `order`, a value of each row of `docs` that is never the same for two, shards are runs of pieces in that order,
    and the names of bins sort by their first piece. Without it the pieces are dealt to shards by a hash.
    """
    cut = stored(pieces(docs, capacity, text, doc_id, source, order), "pieces")
    total = cut.count()
    shards = max(1, -(-total // shard_pieces))
    if order is None:
        place = F.xxhash64("doc_id", "start", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
        dealt = cut.select("*", F.pmod(place, F.lit(shards)).alias("shard"), place.alias("place"))
    else:
        dealt = _numbered(cut).withColumn("shard", F.expr(f"place * {shards} div {max(total, 1)}"))
    dealt = dealt.drop("ordinal")
    ordered, shard_digits, bin_digits = order is not None, len(str(shards - 1)), len(str(shard_pieces))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), ("place", "ascending")])
        bins, offsets = best_fit(*[table.column(c).to_pylist() for c in ("n_words", "source", "cluster")], capacity)
        shard = table.column("shard")[0].as_py()
        names = [f"{shard}-{b}" for b in bins]
        if ordered:
            first = dict.fromkeys(b for _, b in sorted(zip(table.column("place").to_pylist(), bins, strict=True)))
            number = {b: k for k, b in enumerate(first)}
            names = [f"{shard:0{shard_digits}d}-{number[b]:0{bin_digits}d}" for b in bins]
        return pa.table(
            [*[table.column(c) for c in ("doc_id", "source", "start", "n_words")], names, pa.array(offsets, pa.int64())],
            names=["doc_id", "source", "start", "n_words", "bin", "bin_start"],
        )

    result = RESULT.format(id=cut.schema["doc_id"].dataType.simpleString(), source=cut.schema["source"].dataType.simpleString())
    return dealt.groupBy("shard").applyInArrow(run, result)
