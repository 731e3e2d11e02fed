"""Near-duplicates by SimHash: 64-bit fingerprints of word shingles, linked at a small Hamming distance.

The comparison is exact and tiled: numpy exclusive-or and bit counts over pairs of tiles, and pairs of tiles whose
population counts differ by more than the radius are skipped. Comparing every tile of a corpus with every other grows
with the square of the corpus, so tiles are cut inside blocks: with the 64 bits cut into radius + 2 bands, two
fingerprints within the radius have two bands in common, so a block is a pair of bands and their bits, and no link is
lost. Each pair of tiles sends on a spanning forest of its links, not the links themselves.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quaystar.llm.common import Batches, connected, free_name, stored, with_text_columns, words_of

RADIUS = 3
SHINGLE_WORDS = 3
TILE = 1024
CHUNK = 1 << 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint as a signed long. A text without words has fingerprint 0."""
    words = words_of(text.translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - width, 0)
    first, stop = starts[: last + 1].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), CHUNK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first[at : at + CHUNK], stop[at : at + CHUNK], strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first)).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` plus the fingerprint (bigint) of each text; null texts are empty. Returns its name as well."""
    name = free_name(docs, "fingerprint")
    added = StructType([StructField(name, LongType())])
    return with_text_columns(docs, text, added, lambda texts: [[fingerprint(text) for text in texts]]), name


def _bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 2 bands."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph between two tiles (or in one, if they are the same)."""
    both = np.concatenate((a, b))
    bits = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :])  # of signed numbers it counts |x|
    near = bits <= radius
    left, right = np.nonzero(near)
    right = right + len(a)
    label = np.arange(len(both))
    while len(left):
        lower = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, lower)
        np.minimum.at(new, right, lower)
        np.minimum.at(new, label[left], lower)
        np.minimum.at(new, label[right], lower)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = label != np.arange(len(both))
    return both[away], both[label[away]]


def links(fingerprints: DataFrame, name: str, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """a, b: links that connect all distinct fingerprints (column `name`) that a chain of close ones connects."""
    bands = _bands(radius)

    def band(first: int, bits: int):
        return F.shiftrightunsigned(F.col(name), 64 - first - bits).bitwiseAND(F.lit((1 << bits) - 1))

    blocks = [
        F.struct(F.lit(k).alias("pair"), band(*x).alias("x"), band(*y).alias("y")) for k, (x, y) in enumerate(combinations(bands, 2))
    ]
    keyed = fingerprints.select(name, F.explode(F.array(*blocks)).alias("block")).select(
        name, "block.*", F.bit_count(name).alias("ones")
    )
    # A block is numbered by population count and cut into tiles by a hash where one count holds more than a tile.
    sizes = keyed.groupBy("pair", "x", "y", "ones").count()
    sizes = sizes.withColumn("rows", F.sum("count").over(Window.partitionBy("pair", "x", "y"))).where("rows > 1")
    parts = F.ceil(F.col("count") / tile).cast("long")
    sized = sizes.select("pair", "x", "y", "ones", parts.alias("parts"))
    tiled = keyed.join(sized, ["pair", "x", "y", "ones"]).withColumn("part", F.pmod(F.xxhash64(F.col(name), F.lit(7)), F.col("parts")))
    tiles = tiled.groupBy("pair", "x", "y", "ones", "part").agg(F.collect_list(name).alias("members"))
    # A tile is paired with the tiles of its block whose population counts are within the radius, each pair once.
    other = tiles.select(
        "pair", "x", "y", F.col("ones").alias("other_ones"), F.col("part").alias("other_part"), F.col("members").alias("others")
    )
    reach = tiles.withColumn("other_ones", F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)))
    pairs = (
        reach.join(other, ["pair", "x", "y", "other_ones"])
        .where((F.col("other_ones") > F.col("ones")) | (F.col("other_part") >= F.col("part")))
        .select("members", "others")
    )

    def compare(batches: Batches) -> Batches:
        for batch in batches:
            a, b = [], []
            for members, others in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (v.values.to_numpy(zero_copy_only=False) for v in (members, others))
                found = _forest(x, y, radius)
                a.append(found[0])
                b.append(found[1])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return pairs.repartition(F.expr("xxhash64(members[0], others[0])")).mapInArrow(compare, "a long, b long")


def classes(fingerprints: DataFrame, name: str, doc_id: str, radius: int = RADIUS) -> DataFrame:
    """fingerprint, class_root, component_id: one row for each distinct fingerprint of `fingerprints`.

    component_id is the smallest doc_id of all documents that can be reached; class_root tells components apart where
    no document has an id.
    """
    distinct = stored(fingerprints.groupBy(F.col(name).alias("fingerprint")).agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = connected(links(distinct.select("fingerprint"), "fingerprint", radius)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("class_root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("class_root").agg(F.min("least").alias("component_id"))
    return stored(rooted.select("fingerprint", "class_root").join(least, "class_root"), "fingerprint_classes")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (bigint), component_id of each document.

    Null and empty texts have fingerprint 0 and are one component with each other. A null doc_id takes part but never
    names a component unless all ids are null. Repeated rows each get their row. An empty table gives an empty result.
    """
    rows, name = with_fingerprint(docs.select(doc_id, text), text)
    rows = stored(rows.select(F.col(doc_id).alias("doc_id"), F.col(name).alias("fingerprint")), "document_fingerprints")
    found = classes(rows, "fingerprint", "doc_id", radius)
    return rows.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; ties go to the smallest text, then any row."""
    slim, name = with_fingerprint(docs.select(doc_id, text), text)
    found = classes(slim.select(F.col(name).alias("fingerprint"), F.col(doc_id).alias("least_id")), "fingerprint", "least_id", radius)
    rows, name = with_fingerprint(docs, text)
    root, place, known = free_name(rows, "class_root"), free_name(rows, "place"), free_name(rows, "known")
    joined = rows.join(found.select(F.col("fingerprint").alias(known), F.col("class_root").alias(root)), F.col(name) == F.col(known))
    # Spark keeps one row of a component for each task before it shuffles them.
    first = F.row_number().over(Window.partitionBy(root).orderBy(F.col(doc_id).asc_nulls_last(), F.col(text)))
    return joined.withColumn(place, first).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_digits(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))
