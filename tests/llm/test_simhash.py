import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from quaystar.llm import simhash
from quaystar.llm.common import connected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "One", "One two", "A B c d e É", "x y z " * 30, None])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) % (1 << 64) == fingerprint(text)


def test_links_lose_nothing(spark):
    """Random chains around a few centres, in tiles of a few rows, against all pairs."""
    pick = random.Random(4)
    values = {0}
    for _ in range(4):
        value = pick.getrandbits(64)
        for _ in range(60):
            values.add(value)
            for bit in pick.sample(range(64), pick.randint(1, 4)):
                value ^= 1 << bit
    values |= {pick.getrandbits(64) for _ in range(100)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    found = connected(simhash.links(spark.createDataFrame([(v,) for v in signed], "f long"), "f", tile=8))
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3]
    expected = components({n for link in near for n in link}, near)
    assert {row.node: row.root for row in found.collect()} == expected


def test_long_chain_is_one_component(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    assert {row.node: row.root for row in connected(links).collect()} == {**dict.fromkeys(range(300), 0), 1000: 1000, 1001: 1000}


def test_whole_operator(edge_docs, edge_rows, no_docs):
    found = simhash.near_duplicates(edge_docs).select("doc_id", simhash.hex_digits("fingerprint").alias("f"), "component_id").collect()
    prints = [(row[0], fingerprint(row[1])) for row in edge_rows]
    near = [(a, b) for a in {f for _, f in prints} for b in {f for _, f in prints} if a < b and (a ^ b).bit_count() <= 3]
    root = components({f for _, f in prints}, near)
    least = {}
    for doc_id, f in prints:
        ids = [x for x in (least.get(root[f]), doc_id) if x is not None]
        least[root[f]] = min(ids) if ids else None
    expected = [(doc_id, f"{f:016x}", least[root[f]]) for doc_id, f in prints]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len(set(root.values()))
    assert {row.doc_id for row in kept.collect()} == {v for v in least.values()}
    assert simhash.near_duplicates(no_docs).count() == 0 == simhash.keep_one(no_docs).count()


def test_all_of_one_text(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("the same text here").alias("text"))
    assert simhash.near_duplicates(docs).where("component_id = 0").count() == 500
    assert [row.doc_id for row in simhash.keep_one(docs).collect()] == [0]
