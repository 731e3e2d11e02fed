import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quaystar.operators.numbering import (
    append_keys,
    assign_keys,
    assign_keys_in_files,
    global_positions,
    ntile_over_all,
    positions_in_group,
    tile_of,
)


def test_keys_are_dense_and_depend_on_the_rows_only(spark, rows):
    ids = [(f"id{i}",) for i in range(1000)]
    keyed = rows(assign_keys(spark.createDataFrame(ids, "id string"), ["id"], "key"), "id", "key")
    shuffled = spark.createDataFrame(random.Random(3).sample(ids, len(ids)), "id string").repartition(7)
    assert sorted(key for _, key in keyed) == list(range(1, 1001))
    assert rows(assign_keys(shuffled, ["id"], "key"), "id", "key") == keyed


def test_appended_keys_go_on_and_old_ones_stay(spark, rows):
    old = assign_keys(spark.createDataFrame([(f"id{i}",) for i in range(50)], "id string"), ["id"], "key")
    everything = spark.createDataFrame([(f"id{i}",) for i in range(80)], "id string")
    fresh = rows(append_keys(everything, old, ["id"], "key"), "key", "id")
    assert sorted(key for key, _ in fresh) == list(range(51, 81))
    assert {name for _, name in fresh} == {f"id{i}" for i in range(50, 80)}
    grown = old.select("key", "id").unionByName(spark.createDataFrame(fresh, "key bigint, id string"))
    assert append_keys(everything, grown, ["id"], "key").isEmpty()


def test_first_append_starts_at_one(spark, rows):
    nothing = spark.createDataFrame([], "key bigint, id string")
    fresh = append_keys(spark.createDataFrame([("a",), ("b",)], "id string"), nothing, ["id"], "key")
    assert sorted(row[0] for row in rows(fresh, "key")) == [1, 2]


def test_global_positions_follow_the_order(spark):
    chance = random.Random(5)
    # A third of the rows share one value; the id keeps the order total.
    values = [(7 if chance.random() < 0.33 else chance.randrange(100), i) for i in range(3000)]
    placed = global_positions(spark.createDataFrame(values, "v int, id int").repartition(5), ["v", "id"], "position")
    found = {(row.v, row.id): row.position for row in placed.collect()}
    assert found == {pair: i for i, pair in enumerate(sorted(values), 1)}


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 9, 100, 101, 102, 103])
def test_tiles_match_ntile(spark, count):
    numbers = spark.range(1, count + 1).select(F.col("id").alias("position"))
    distributed = numbers.select("position", tile_of(F.col("position"), count, 4).alias("tile"))
    plain = numbers.withColumn("tile", F.ntile(4).over(Window.orderBy("position")))
    assert sorted(map(tuple, distributed.collect())) == sorted(map(tuple, plain.collect()))
    placed = ntile_over_all(numbers, ["position"], 4, "tile", count)
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, plain.collect()))


def test_ntile_of_ties(spark, rows):
    chance = random.Random(8)
    frame = spark.createDataFrame([(chance.randrange(5), i) for i in range(1003)], "v int, id int")
    plain = frame.withColumn("tile", F.ntile(4).over(Window.orderBy("v", "id")))
    assert rows(ntile_over_all(frame, ["v", "id"], 4, "tile", 1003)) == rows(plain)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_positions_in_a_hot_group(spark, partitions):
    chance = random.Random(11)
    groups = [None if chance.random() < 0.2 else "hot" if chance.random() < 0.4 else f"g{chance.randrange(40)}" for _ in range(2000)]
    values = [(group, chance.random(), i) for i, group in enumerate(groups)]
    frame = spark.createDataFrame(values, "g string, v double, id int").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = {row.id: row.n for row in positions_in_group(frame, "g", ["v", "id"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected, seen = {}, {}
    for group, value, number in sorted(values, key=lambda row: (str(row[0]), *row[1:])):
        seen[group] = seen.get(group, 0) + 1
        expected[number] = seen[group]
    assert found == expected


def test_keys_in_files(spark, tmp_path):
    frame = spark.range(1000).repartition(7)
    frame.write.option("maxRecordsPerFile", 60).parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    keyed = assign_keys_in_files(written, "key", 100)
    found = keyed.collect()
    assert sorted(row.key for row in found) == list(range(101, 1101))
    assert sorted(row.id for row in found) == list(range(1000))
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, found))


def test_positions_in_group_do_not_shuffle_all_rows_again(spark):
    """Rows lie by group after the range partitioning; numbering them there needs no second shuffle of all rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        keys = [None, None, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 2, 3, None]
        frame = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, order_key long")
        numbered = positions_in_group(frame, "order_key", ["id"], "n")
        found = {row.id: row.n for row in numbered.collect()}
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    seen, expected = {}, {}
    for i, k in enumerate(keys):
        seen[k] = seen.get(k, 0) + 1
        expected[i] = seen[k]
    assert found == expected
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # The counts per partition and group are shuffled; before, all rows were too, once more, for a window.
    assert len([line for line in shuffles if "order_key#" in line and "_part#" in line]) == 1, shuffles
