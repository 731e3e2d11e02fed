import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quaystar.llm import packing


def plain_best_fit(sizes, sources, clusters, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = [
            (capacity - sum(sizes[k] for k in members), b)
            for b, members in enumerate(bins)
            if sum(sizes[k] for k in members) + sizes[item] <= capacity
            and all(sources[k] != sources[item] or sources[k] is None for k in members)
            and all(clusters[k] != clusters[item] for k in members)
        ]
        if fits:
            out[item] = min(fits)[1]
        else:
            out[item] = len(bins)
            bins.append([])
        bins[out[item]].append(item)
    return out


def test_best_fit():
    pick = random.Random(3)
    for _ in range(30):
        n = pick.randint(0, 60)
        sizes = [pick.choice((0, pick.randint(1, 50), 50)) for _ in range(n)]
        sources = [pick.choice((None, "hot", "hot", pick.randint(0, 6))) for _ in range(n)]
        clusters = [pick.randint(0, 30) for _ in range(n)]
        bins, offsets = packing.best_fit(sizes, sources, clusters, 50)
        assert bins == plain_best_fit(sizes, sources, clusters, 50)
        used = defaultdict(list)
        for b, offset, size in zip(bins, offsets, sizes):
            used[b].append((offset, size))
        for parts in used.values():
            end = 0
            for offset, size in sorted(parts, key=lambda p: (p[0], p[1])):
                assert offset == end
                end += size
            assert end <= 50


def test_whole_operator(edge_docs, edge_rows, no_docs):
    rows = packing.pack(edge_docs, capacity=100, shard_pieces=8).collect()
    words = Counter()
    for row in rows:
        words[row.doc_id] += row.n_words
        assert 0 <= row.bin_start <= row.bin_start + row.n_words <= 100
    expected = Counter()
    for row in edge_rows:
        expected[row[0]] += len((row[1] or "").encode().split())
    assert words == expected
    bins = defaultdict(list)
    for row in rows:
        bins[row.bin].append(row)
    for members in bins.values():
        sources = [row.source for row in members if row.source is not None]
        assert len(sources) == len(set(sources))
        end = 0
        for row in sorted(members, key=lambda r: (r.bin_start, r.n_words)):
            assert row.bin_start == end
            end += row.n_words
    long = sorted(row.start for row in rows if row.doc_id == 11)
    assert long == list(range(0, 8000, 100))
    # The two equal rows of document 4, and documents 1 and 2 of one text, are never together.
    assert len({row.bin for row in rows if row.doc_id == 4}) == 2
    assert not {row.bin for row in rows if row.doc_id == 1} & {row.bin for row in rows if row.doc_id == 2}
    assert packing.pack(no_docs).count() == 0


def test_copies_and_one_source_keep_apart(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit(None).cast("string").alias("source"))
    assert packing.pack(docs, 100).select("bin").distinct().count() == 300
    docs = docs.withColumn("text", F.concat_ws(" ", "text", "doc_id")).withColumn("source", F.lit("one"))
    assert packing.pack(docs, 100).select("bin").distinct().count() == 300
    assert packing.pack(docs.withColumn("source", F.lit(None).cast("string")), 100).select("bin").distinct().count() == 12
