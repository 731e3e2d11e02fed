import math

import numpy as np
from pyspark.sql import functions as F

from quaystar.llm import hamming_index
from quaystar.llm.hamming_index import Index


def brute_force(rows, step=100, k=10):
    out = {}
    for query, q in rows:
        if query % step == 0:
            near = sorted((float(np.sqrt(((np.array(v, float) - np.array(q, float)) ** 2).sum())), i) for i, v in rows if i != query)
            out[query] = [(i, d) for d, i in near[:k]]
    return out


def by_query(found):
    out = {}
    for row in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


def test_pigeonhole_finds_every_code_in_the_radius():
    codes = np.random.default_rng(2).integers(0, 256, (3_000, 4), np.uint8)
    block = hamming_index._Block(codes)
    for radius in (0, 1, 3, 4, 7, 11, 16, 31, 32):
        distance = np.bitwise_count(codes ^ codes[5]).sum(1)
        assert block.within(codes[5], radius).tolist() == np.flatnonzero(distance <= radius).tolist()


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute_force([(row.vec_id, row.embedding) for row in rows.collect()], 10)
    found = by_query(hamming_index.nearest(rows, Index(query_step=10, block_rows=200, query_rows=20)))
    assert found.keys() == expected.keys() and all(len(near) == 10 for near in found.values())
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 10 for q in expected]) >= 0.9
    distances = {(q, i): d for q in expected for i, d in expected[q]}
    assert all(d == distances[q, i] for q in found for i, d in found[q] if (q, i) in distances)


def test_odd_vectors_and_ties(spark):
    pick = np.random.default_rng(5)
    good = [(k, [1.0, 2.0, 3.0]) for k in range(40)] + [(k, pick.normal(size=3).tolist()) for k in range(100, 130)]
    odd = [
        (200, None), (300, [0.0, 0.0, 0.0]), (301, [1.0, None, 2.0]), (302, [math.nan, 1.0, 1.0]), (303, [math.inf, 1.0, 1.0]),
        (304, []), (400, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]),
    ]
    rows = spark.createDataFrame([(*row, 0, "x") for row in good + odd], "vec_id long, embedding array<double>, score int, Rank string")
    found = by_query(hamming_index.nearest(rows, Index(block_rows=16, query_rows=1)))
    assert found == brute_force(good) | {}
    assert [i for i, _ in found[0]] == list(range(1, 11))
    few = by_query(hamming_index.nearest(rows.where("vec_id in (0, 1, 2, 100)")))
    assert [len(near) for near in few.values()] == [3, 3]
    assert hamming_index.nearest(rows.limit(0)).count() == 0
    assert hamming_index.nearest(rows.where("vec_id = 5")).count() == 0


def test_repeated_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    near = hamming_index.nearest(rows).where(F.col("query_id") == 0).collect()
    assert all(row.vec_id != 0 for row in near)


def test_repeated_queries_and_neighbours(spark):
    """Each id is ranked once: a repeated query by its smallest vector, a repeated neighbour by its nearest."""
    pick = np.random.default_rng(7)
    good = [(k, pick.normal(size=4).tolist()) for k in range(40)]
    lower = [-9.0, *good[0][1][1:]]
    rows = good + good + good[:20] + [(0, lower), (5, [9.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for how in (Index(), Index(block_rows=16, query_rows=1)):
        found = by_query(hamming_index.nearest(frame, how))
        best = {}
        for i, v in rows:
            d = float(np.sqrt(((np.array(v) - np.array(lower)) ** 2).sum()))
            best[i] = min(best.get(i, d), d)
        expected = sorted((d, i) for i, d in best.items() if i != 0)[:10]
        assert len({i for i, _ in found[0]}) == 10 and sorted(found[0], key=lambda x: x[1]) == found[0]
        assert len({i for i, _ in found[0]} & {i for _, i in expected}) >= 9
        assert all(d == best[i] for i, d in found[0])


def test_queries_do_not_pass_through_the_driver(spark):
    """Blocks of queries are neither broadcast nor copied by a shuffle for each block, and tasks don't grow with the pairs."""
    pick = np.random.default_rng(9)
    rows = [(k, pick.normal(size=4).tolist()) for k in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    how = Index(query_step=10, radius=1.0, block_rows=10, query_rows=2, block_tasks=3, query_tasks=2)  # 40 blocks, 20 of queries
    found = hamming_index.nearest(frame, how)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" in plan and "Coalesce 3" in plan and "Coalesce 2" in plan
    assert plan.count("Exchange") == 1  # what was found, by its query
    assert by_query(found) == brute_force(rows, 10)


def test_blocks_of_bounded_tasks(spark):
    """More blocks than tasks that deal them out: every row in one block, and blocks of about the size asked for."""
    rows = spark.range(1000).selectExpr("id", "array(id * 1.0D, 1.0D) vector")
    blocks = hamming_index._packed(rows, 30, "test_blocks", "f8", most=4).collect()
    assert len({row.block for row in blocks}) == len(blocks) and all(15 <= len(row.ids) // 8 <= 60 for row in blocks)
    held = [(i, tuple(v)) for row in blocks for i, v in zip(np.frombuffer(row.ids, "i8").tolist(), np.frombuffer(row.vectors).reshape(-1, 2).tolist(), strict=True)]
    assert sorted(held) == [(k, (float(k), 1.0)) for k in range(1000)]
