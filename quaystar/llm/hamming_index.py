"""Nearest neighbours by multi-index hashing.

A vector's code is the signs of its coordinates after learned rotations. The vectors are dealt into blocks, and each block
indexes every byte of its codes by value. Two codes within a Hamming radius r differ by at most r / bytes bits in some
byte, so looking up the values that near to each byte of the query's code retrieves every code of the block within r;
those are reranked by the distance of the vectors themselves. Where the looked-up values hold as many entries as there are
codes, as at the radius of `Index`, the codes are compared one by one, which finds the same and reads less. A block with fewer codes in the radius than neighbours
wanted is probed again with a larger one, up to all of it.

The queries, a stated share of the rows, meet the blocks as packed arrays, read where they were stored: nothing is copied
for each pair of blocks, neither to the driver nor in a shuffle. A task holds some blocks of vectors against some blocks of
queries, and only the nearest few of a query come back from it. The number of tasks has a bound (`Index.block_tasks`,
`query_tasks`), whatever the number of pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from quaystar.llm.common import Batches, stored


@dataclass(frozen=True)
class Index:
    neighbours: int = 10
    query_step: int = 100  # rows whose id is divisible by this are queries
    fit_rows: int = 10_000  # the rotations are learned from a random sample of about so many rows, twice as many at most
    rotations: int = 4
    fit_rounds: int = 30
    radius: float = 0.45  # share of the code's bits
    block_rows: int = 8192
    query_rows: int = 1024
    block_tasks: int = 128  # the blocks of vectors are dealt to so many tasks at most, and the blocks of queries
    query_tasks: int = 64  # to so many at most: what the driver keeps of tasks doesn't grow with the pairs
    query_blocks: int = 16  # blocks of queries that a task meets, as long as query_tasks allows it


@dataclass
class Rotations:
    centre: np.ndarray
    turns: np.ndarray  # dimensions x bits

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as bytes, one row for each vector; bits that fill up the last byte are 0."""
        return np.packbits((vectors - self.centre) @ self.turns > 0, axis=1)


def learn(vectors: np.ndarray, how: Index) -> Rotations:
    """Rotations that bring the vectors close to the corners of a cube: corners and rotation are fitted in turn."""
    centre = vectors.mean(0)
    x, turns = vectors - centre, []
    for seed in range(how.rotations):
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1],) * 2))[0]
        for _ in range(how.fit_rounds):
            left, _, right = np.linalg.svd(x.T @ np.where(x @ turn > 0, 1.0, -1.0))
            turn = left @ right
        turns.append(turn)
    return Rotations(centre, np.concatenate(turns, 1))


def _masks(bits: int) -> np.ndarray:
    """All bytes with at most so many bits."""
    return np.array([sum(1 << b for b in chosen) for n in range(bits + 1) for chosen in combinations(range(8), n)], np.intp)


def _words(codes: np.ndarray) -> np.ndarray:
    """Eight bytes of each code at a time, filled up with 0: one row for each eighth byte, one column for each code."""
    whole = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    whole[:, : codes.shape[1]] = codes
    return np.ascontiguousarray(whole.view(np.uint64).T)


class _Block:
    """Codes of a block, with an index of each of their bytes: rows in the order of the value, and where a value begins."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.words = codes, _words(codes)
        self.rows = [np.argsort(codes[:, k], kind="stable") for k in range(codes.shape[1])]
        self.begins = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, k], minlength=256)))) for k in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius."""
        size = self.codes.shape[1]
        masks = _masks(min(radius // size, 8))
        probes = [masks ^ int(code[k]) for k in range(size)]
        counts = [self.begins[k][values + 1] - self.begins[k][values] for k, values in enumerate(probes)]
        if sum(int(n.sum()) for n in counts) >= len(self.codes):  # the index would be read oftener than there are codes
            return np.flatnonzero(self._distances(slice(None), code) <= radius)
        seen = np.zeros(len(self.codes), bool)
        for k, values in enumerate(probes):
            first, n = self.begins[k][values], counts[k]
            at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            seen[self.rows[k][at]] = True
        rows = np.flatnonzero(seen)
        return rows[self._distances(rows, code) <= radius]

    def _distances(self, rows, code: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.words[:, rows] ^ _words(code[None])).sum(0, dtype=np.int64)


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _packed(rows: DataFrame, size: int, name: str, kind: str, most: int = 1024) -> DataFrame:
    """block, ids, vectors: the rows (id, vector) as packed arrays of about `size` rows, dealt out evenly; kind: the type of
    the numbers. At most so many tasks deal them out, each into several blocks if there are more."""
    blocks = max(1, -(-rows.count() // size))

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId() << 32, 0
        names, numbers = np.empty(0, np.int64), None

        def block(count: int) -> pa.RecordBatch:
            columns = [[part + seq], [names[:count].tobytes()], [numbers[:count].tobytes()]]
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "ids", "vectors"])

        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(ids), -1)
            names, numbers = np.concatenate([names, ids]), vectors if numbers is None else np.concatenate([numbers, vectors])
            while len(names) >= 2 * size:
                yield block(size)
                names, numbers, seq = names[size:], numbers[size:], seq + 1
        if len(names) > 1.5 * size:
            half = len(names) // 2
            yield block(half)
            names, numbers, seq = names[half:], numbers[half:], seq + 1
        if len(names):
            yield block(len(names))

    return stored(rows.repartition(min(blocks, most)).mapInArrow(run, "block long, ids binary, vectors binary"), name)


def _unpacked(ids: pa.Scalar, vectors: pa.Scalar, kind: str) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids.as_buffer(), np.int64)
    return names, np.frombuffer(vectors.as_buffer(), kind).astype(np.float64).reshape(len(names), -1)


def _sampled(rows: DataFrame) -> np.ndarray:
    """The vectors of some rows, brought to the driver as packed doubles."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if len(batch):
                values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64()), pa.array([values.tobytes()], pa.binary())], names=["n", "values"])

    parts = [np.frombuffer(row["values"], np.float64).reshape(row["n"], -1) for row in rows.select("vector").mapInArrow(run, "n long, values binary").collect()]
    return np.concatenate(parts) if parts else np.empty((0, 0))


def _ranked(query: np.ndarray, ids: np.ndarray, distance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query so many different ids at most, by distance and then by id, each with its smallest distance."""
    order = np.lexsort((distance, ids, query))
    order = order[np.append(True, (np.diff(query[order]) != 0) | (np.diff(ids[order]) != 0))[: len(order)]]
    order = order[np.lexsort((ids[order], distance[order], query[order]))]
    first = np.flatnonzero(np.append(True, np.diff(query[order]) != 0)[: len(order)])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[rank < most]
    return query[order], ids[order], distance[order]


def _others(ids: np.ndarray, query_id: int) -> int:
    """How many different ids there are besides the query's."""
    found = np.unique(ids)
    return len(found) - int(query_id in found)


def nearest(rows: DataFrame, how: Index = Index(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the nearest rows found for each query, nearest first.

    Vectors that are null, zero or hold null or non-finite components take no part, and neither do rows without an id
    (nothing could name them) or with another number of components than most rows have (of equally frequent numbers the
    smaller one stands). Rows with the id of the query are not its candidates. A query whose id is repeated stands once,
    with the smallest of its vectors; a neighbour whose id is repeated stands once, with the nearest of them. Equal
    distances go by the smaller id.
    Vectors are taken as doubles. With fewer candidates than neighbours wanted, all are returned. An empty table gives
    an empty result.
    """
    good = rows.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
    kind, numbers = ("f4", "array<float>") if isinstance(good.schema[vector].dataType.elementType, FloatType) else ("f8", "array<double>")
    good = good.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(numbers).alias("vector"))
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    result = "query_id long, vec_id long, score double"
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = stored(good.where(F.size("vector") == sizes["size"]), "usable_vectors")
    # About fit_rows rows reach the driver, whatever the number of partitions.
    share = min(1.0, how.fit_rows / good.count())
    sample = _sampled(good.sample(share, seed=0).limit(2 * how.fit_rows))
    model = learn(sample if len(sample) else _sampled(good.limit(1)), how)
    radius = int(how.radius * model.turns.shape[1])

    blocks = _packed(good, how.block_rows, "vector_blocks", kind)
    asked = good.where(F.col("id") % how.query_step == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = _packed(asked, how.query_rows, "query_blocks", kind)
    n_blocks, n_queries = blocks.count(), queries.count()
    sent = queries.select(F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))
    sent = sent.coalesce(max(1, min(-(-n_queries // how.query_blocks), how.query_tasks)))
    # The hint keeps Spark from sending the queries through the driver. A task reads each of its blocks once, then its queries.
    pairs = blocks.coalesce(min(n_blocks, how.block_tasks)).crossJoin(sent.hint("shuffle_replicate_nl"))

    def search(batches: Batches) -> Batches:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        at_block = None
        for batch in batches:
            for number, names, packed, query_block, query_names, query_packed in zip(*batch.columns, strict=True):
                if number.as_py() != at_block:
                    at_block = number.as_py()
                    ids, vectors = _unpacked(names, packed, kind)
                    block, once = _Block(model.codes(vectors)), len(np.unique(ids)) == len(ids)
                query_ids, queries = _unpacked(query_names, query_packed, kind)
                found = [best[query_block.as_py()]] if query_block.as_py() in best else []
                for query_id, query, code in zip(query_ids, queries, model.codes(queries), strict=True):
                    reach = radius
                    at = block.within(code, reach)
                    while (not once or len(at) <= how.neighbours) and _others(ids[at], query_id) < how.neighbours and reach < 8 * len(code):
                        reach += max(len(code), 1)
                        at = block.within(code, reach)
                    at = at[ids[at] != query_id]
                    distance = np.sqrt(((vectors[at] - query) ** 2).sum(1))
                    if once and len(at) > how.neighbours:  # no id stands for several vectors: farther ones can't be among them
                        near = distance <= np.partition(distance, how.neighbours - 1)[how.neighbours - 1]
                        at, distance = at[near], distance[near]
                    order = np.lexsort((ids[at], distance))
                    order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])[: how.neighbours]]
                    found.append((np.full(len(order), query_id), ids[at][order], distance[order]))
                best[query_block.as_py()] = _ranked(*(np.concatenate(part) for part in zip(*found)), how.neighbours)
        for columns in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    near = pairs.select("block", "ids", "vectors", "query_block", "query_ids", "queries").mapInArrow(search, result).repartition("query_id")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= how.neighbours).select("query_id", "rank", "vec_id", "score")
