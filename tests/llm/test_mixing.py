import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quaystar.llm import mixing

WEIGHTS = {"a": 6, "b": 4, "c": 10}


def documents(spark, sizes):
    rows = [(f"{source}{k}", source) for source, n in sizes.items() for k in range(n)]
    return spark.createDataFrame(rows, "doc_id string, source string")


def blocks_of(found):
    """One row for each block, by slot."""
    rows = found[0].select(f"{found[1]}.*").collect()
    blocks = {(row.stream, row.block): row for row in rows}
    for row in rows:
        assert blocks[row.stream, row.block].slot == row.slot
    assert len({row.position for row in rows}) == len(rows)
    return sorted(blocks.values(), key=lambda row: row.slot), Counter((row.stream, row.block) for row in rows)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 61, "b": 200, "c": 90, "d": 33}, {"a": 3, "c": 400}, {"b": 1}, {"d": 50}, {"a": 40, "b": 40, "c": 40, None: 40}],
)
def test_schedule(spark, sizes):
    found = mixing.scheduled(documents(spark, sizes), WEIGHTS, 3, block_docs=4)
    blocks, members = blocks_of(found)
    streams = {source if source in WEIGHTS else mixing.REST: n for source, n in sizes.items()}
    assert Counter({stream: n for (stream, _), n in members.items()}) or not members
    docs = Counter()
    for (stream, block), n in members.items():
        docs[stream] += n
        assert n == 4 or block == -(-streams[stream] // 4) - 1
    assert docs == streams
    assert [row.slot for row in blocks] == list(range(len(blocks)))
    assert all(row.release <= row.slot < row.deadline for row in blocks)
    # Until the first stream runs out, each has had less than one block more or less than its weight asks for.
    parts = {stream: {**WEIGHTS, mixing.REST: 3}[stream] for stream in streams}
    total, had, left = sum(parts.values()), Counter(), {s: -(-n // 4) for s, n in streams.items()}
    for slot, row in enumerate(blocks, 1):
        had[row.stream] += 1
        assert all(abs(had[s] - slot * part / total) < 1 for s, part in parts.items())
        assert row.block == had[row.stream] - 1
        if had[row.stream] == left[row.stream]:
            break


def test_earliest_deadline_first(spark):
    """The schedule is that of a simulation, slot by slot, over several phases."""
    sizes = {"a": 30, "b": 9, "c": 70}
    blocks, _ = blocks_of(mixing.scheduled(documents(spark, sizes), WEIGHTS, 1, block_docs=2))
    left = {0: 0, 1: 15, 2: 5, 3: 35}  # blocks by stream number; the rest comes first and has none
    parts, names, expected = {0: 1, 1: 6, 2: 4, 3: 10}, {1: "a", 2: "b", 3: "c"}, []
    common = 1
    while any(left.values()):
        share = {s: parts[s] // common for s in left if left[s]}
        total, done = sum(share.values()), Counter()
        for slot in range(10**6):
            if slot % total == 0:
                cycle = Counter()
                if any(left[s] == done[s] for s in share):
                    break
            due = [(-(-(cycle[s] + 1) * total // n), s) for s, n in share.items() if cycle[s] < n and cycle[s] * total // n <= slot % total]
            stream = min(due)[1]
            expected.append(names[stream])
            cycle[stream] += 1
            done[stream] += 1
            if left[stream] == done[stream] and any(left[s] - (done[s] - cycle[s]) < share[s] for s in share):
                break
        left = {s: n - done[s] for s, n in left.items()}
    assert [row.stream for row in blocks] == expected


def test_order_in_a_stream_is_that_of_the_hash(spark):
    found, mix = mixing.scheduled(documents(spark, {"a": 50, "b": 20}), WEIGHTS, 1, block_docs=4)
    order = defaultdict(list)
    for row in found.orderBy(F.col(mix)["position"]).collect():
        order[row.source].append(row.doc_id)
    for names in order.values():
        assert names == sorted(names, key=lambda name: hashlib.md5(name.encode()).hexdigest())


def test_whole_operator(edge_docs, edge_rows, no_docs):
    weights = {"src0": 5, "src1": 2}
    found, mix = mixing.scheduled(edge_docs.withColumn("mix", F.lit(1)), weights, 1, 2)
    assert mix == "_mix" and found.columns[:-1] == [*edge_docs.columns, "mix"]
    rows = found.collect()
    assert sorted(row["quality"] for row in rows) == sorted(row[6] for row in edge_rows)
    assert all(row[mix]["stream"] == (row.source if row.source in weights else mixing.REST) for row in rows)
    ordered = mixing.mixed(edge_docs, weights, 1, 2)
    assert ordered.columns == edge_docs.columns
    places = {row["quality"]: row[mix]["position"] for row in rows}
    got = [places[row["quality"]] for row in ordered.collect()]
    # Rows that repeat an id (here 4 and null) may change places with each other.
    assert sorted(got) == sorted(places.values()) and sum(a > b for a, b in zip(got, got[1:])) <= 2
    assert mixing.scheduled(no_docs, weights, 1)[0].count() == 0
    assert mixing.scheduled(edge_docs, {}, 1)[0].count() == len(edge_rows)


def test_weights_are_checked():
    for weights, rest in (({"a": 0}, 1), ({"a": 1.5}, 1), ({"a": 1}, 0), ({"a": 10**6}, 1)):
        with pytest.raises(ValueError):
            mixing._parts(weights, rest)
