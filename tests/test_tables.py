import pytest
from pyspark.sql import functions as F

from quaystar.sources.tables import TableStore


def test_replace_append_and_reopen(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("t") and store.row_count("t") == 0
    store.replace("t", spark.createDataFrame([(1,), (2,)], "n int"))
    store.append("t", spark.createDataFrame([(3,)], "n int"))
    assert rows(store.read("t")) == [(1,), (2,), (3,)]
    reopened = TableStore(spark, str(tmp_path))
    assert reopened.row_count("t") == 3 and rows(reopened.read("t")) == [(1,), (2,), (3,)]
    # A table may be replaced by rows read from itself.
    reopened.replace("t", reopened.read("t").where("n > 1"))
    assert rows(TableStore(spark, str(tmp_path)).read("t")) == [(2,), (3,)]


def test_rows_without_a_commit_are_not_seen(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(1,)], "n int"))
    store.written("t", spark.createDataFrame([(9,)], "n int"))
    assert rows(TableStore(spark, str(tmp_path)).read("t")) == [(1,)]


def test_empty_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.replace("t", spark.createDataFrame([], "n int")).isEmpty()
    assert store.exists("t") and store.row_count("t") == 0


def test_vacuum_deletes_what_no_commit_names(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for count in (3, 5):
        store.replace("a", store.written("a__rows", spark.range(count).toDF("n")))
    store.append("a", spark.range(2).toDF("n"))
    store.replace("b", spark.range(1).toDF("n"))
    gone = store.vacuum()
    assert sorted(folder.split("/")[0] for folder in gone) == ["a", "a__rows", "a__rows"]
    again = TableStore(spark, str(tmp_path))
    assert again.read("a").count() == 7 and again.read("b").count() == 1 and again.vacuum() == []


def test_joint_commit_is_all_or_none(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("a", spark.range(1).toDF("n"))
    store.replace("b", spark.range(2).toDF("n"))
    with pytest.raises(RuntimeError), store.together() as draft:
        draft.replace("a", spark.range(5).toDF("n"))
        draft.append("b", spark.range(5).toDF("n"))
        assert draft.read("a").count() == 5 and draft.row_count("b") == 7
        raise RuntimeError
    for seen in (store, TableStore(spark, str(tmp_path))):
        assert seen.read("a").count() == seen.row_count("a") == 1 and seen.read("b").count() == 2
    with store.together() as draft:
        draft.replace("a", spark.range(5).toDF("n"))
        with draft.together() as inner:  # committed with the outer one
            inner.append("a", spark.range(1).toDF("n"))
            inner.replace("c", spark.range(4).toDF("n"))
        opened = TableStore(spark, str(tmp_path))
        assert store.row_count("a") == opened.row_count("a") == 1 and not opened.exists("c")
        assert draft.row_count("a") == 6
    again = TableStore(spark, str(tmp_path))
    assert [part.sequence for part in again.parts("a")] == [3, 4] and again.parts("a") == store.parts("a")
    assert again.read("a").count() == 6 and again.read("c").count() == 4 and again.read("b").count() == 2
    assert opened.row_count("a") == 1  # as it was when it was opened
    # The writes of a block are one file.
    assert again.commits().inputFiles().__len__() == 3


def test_slices(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    frame = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 4)], "s string, n int")
    store.write_slices("t", frame, F.col("s"))
    parts = {part.slice: part for part in store.parts("t")}
    assert {name: part.rows for name, part in parts.items()} == {"x": 2, "y": 1, "z": 1}
    # y gets other rows, z none, x one more; the files of x stay.
    store.write_slices("t", spark.createDataFrame([("y", 9), ("x", 8)], "s string, n int"), F.col("s"), ["y", "z"])
    for seen in (store, TableStore(spark, str(tmp_path))):
        assert rows(seen.read("t")) == [("x", 1), ("x", 2), ("x", 8), ("y", 9)] and seen.row_count("t") == 4
        assert rows(seen.read_slices("t", ["x"])) == [("x", 1), ("x", 2), ("x", 8)]
        assert rows(seen.read_slices("t", ["z"])) == [] and rows(seen.read_slices("t", ["none"])) == []
        assert parts["x"] in seen.parts("t") and parts["y"] not in seen.parts("t")
    store.vacuum()
    assert rows(store.read("t")) == [("x", 1), ("x", 2), ("x", 8), ("y", 9)]
    store.write_slices("t", frame.limit(0), F.col("s"))
    reopened = TableStore(spark, str(tmp_path))
    assert rows(reopened.read("t")) == [] and reopened.read("t").columns == ["s", "n"]
    for name in ("a/b", None):
        with pytest.raises(ValueError):
            store.write_slices("t", frame, F.lit(name).cast("string"))
