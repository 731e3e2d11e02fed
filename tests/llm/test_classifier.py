import zlib

import numpy as np

from quaystar.llm import classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = classifier.scored(docs, labels).collect()
    known = {row.doc_id: row.quality for row in labels.collect()}
    assert len(rows) == docs.count()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in rows)
    apart = [(row.score, known[row.doc_id]) for row in rows if row.held_out and row.doc_id in known]
    right = np.mean([(score >= 0.5) == label for score, label in apart])
    pairs = [(a > b) + 0.5 * (a == b) for a, x in apart for b, y in apart if x > y]
    assert right > 0.95 and np.mean(pairs) > 0.97


def test_pairs_are_learned():
    """A label that only two features together tell."""
    pick = np.random.default_rng(1)
    x = np.zeros((4_000, len(classifier.FEATURES)))
    x[:, :3] = pick.uniform(-1, 1, (4_000, 3))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    model = classifier.fit(x[:3_000], y[:3_000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3_000:]) >= 0.5) == y[3_000:]) > 0.9


def test_whole_operator(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (9, 0), (None, 1), (4, None), (12, 0)], "doc_id long, quality int")
    rows = classifier.scored(edge_docs, labels).collect()
    assert sorted((row.doc_id for row in rows), key=str) == sorted((row[0] for row in edge_rows), key=str)
    assert len({row.score for row in rows if row.doc_id == 4}) == 1
    assert all(not row.held_out for row in rows if row.doc_id is None)
    unlabelled = classifier.scored(edge_docs, labels.limit(0)).collect()
    assert {row.score for row in unlabelled} == {0.5}
    assert classifier.scored(no_docs, labels).count() == 0


def test_the_bound_of_the_sample_holds(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    from pyspark.sql import functions as F

    measured = docs.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), F.array_repeat(F.lit(0.0), len(classifier.FEATURES)).alias("features")
    )
    x, y = classifier.training_rows(measured, labels, "quality", classifier.Fit(sample_rows=17))
    assert x.shape == (17, len(classifier.FEATURES)) and y.shape == (17,)
