import csv
import random

import pytest

from quaystar.schema import SOURCES, Source, text
from quaystar.operators.ingest import PLACE, first_per_key
from quaystar.sources.csv_files import scan_csv, scan_split_csv

NOTES = Source("notes", "*.csv", (text("id"), text("note"), text("tail")), ("id",), free_text=True)
LINES = Source("lines", "*.csv", (text("id"), text("note"), text("tail")), ("id",))


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, header, values, line_end="\n"):
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.writer(file, lineterminator=line_end)
        writer.writerow(header)
        writer.writerows(values)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_split_scan_finds_every_record(spark, rows, tmp_path, small_blocks, line_end):
    chance = random.Random(2)
    texts = ["plain", 'say "hi"', "two\nlines", 'a,b\n\n"x"\nend', "ąę \n", '"', "\n\n\n" * 900, "x" * 5000]
    expected = []
    for part in range(2):
        values = [(f"{part}-{i}", chance.choice(texts), chance.choice(["1", 'q"'])) for i in range(700)]
        write(tmp_path / f"{part}.csv", ["id", "note", "tail"], values, line_end)
        expected += values
    assert rows(scan_split_csv(spark, str(tmp_path), ["id", "note", "tail"])) == sorted(expected, key=str)


def test_both_scans_resolve_tokens_and_map_columns_by_name(spark, rows, tmp_path):
    values = [("nan", "", "1"), ("t", 'quo"te', "2"), ("a, b", "nan", "3")]
    write(tmp_path / "x.csv", ["tail", "note", "id"], values)
    expected = [("1", None, None), ("2", 'quo"te', "t"), ("3", None, "a, b")]
    assert rows(scan_csv(spark, str(tmp_path), LINES)) == expected
    assert rows(scan_csv(spark, str(tmp_path), NOTES)) == expected


def test_quoted_header_short_and_empty_lines(spark, rows, tmp_path):
    (tmp_path / "x.csv").write_text('﻿"id","note","tail"\n"1","a","b"\n\n2,c\n3,d,e\n', encoding="utf-8")
    expected = [("1", "a", "b"), ("2", "c", None), ("3", "d", "e")]
    assert rows(scan_csv(spark, str(tmp_path), LINES)) == expected
    assert rows(scan_csv(spark, str(tmp_path), NOTES)) == expected


def test_unpaired_quote_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,note,tail\n1,"open,b\n2,c,d\n', encoding="utf-8")
    with pytest.raises(Exception, match="unpaired quote"):
        scan_split_csv(spark, str(tmp_path), ["id", "note", "tail"]).collect()


def test_quotes_in_unquoted_values_lose_nothing(spark, rows, tmp_path, small_blocks):
    """As the csv module reads them: a quote that does not begin a field is an ordinary character."""
    chance = random.Random(6)
    notes = ['a 5" shelf', 'another 7" one', '"two\nlines, quoted"', 'plain', '""', '"say ""hi"""', 'end"', '"\n\n"', '" led by"']
    lines = [f"{k},{chance.choice(notes)},{chance.choice(['1', '12 inch'])}" for k in range(400)]
    text = "\n".join(["id,note,tail", *lines]) + "\n"
    (tmp_path / "x.csv").write_text(text, encoding="utf-8")
    expected = [tuple(value or None for value in row) for row in csv.reader(text.splitlines(keepends=True))][1:]
    found = rows(scan_csv(spark, str(tmp_path), NOTES))
    assert len(found) == 400 and [row[0] for row in found] == sorted((row[0] for row in expected))
    strip = lambda found: sorted((row[0], (row[1] or "").strip('"'), row[2]) for row in found)
    assert strip(found) == strip(expected)


@pytest.mark.parametrize("source", [LINES, NOTES])
def test_files_of_different_column_order(spark, rows, tmp_path, source):
    write(tmp_path / "a.csv", ["id", "note", "tail"], [("1", "n1", "t1")])
    write(tmp_path / "b.csv", ["tail", "id", "extra", "note"], [("t2", "2", "e", "n2")])
    assert rows(scan_csv(spark, str(tmp_path), source)) == [("1", "n1", "t1"), ("2", "n2", "t2")]


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "x.csv").write_text("seller_id\n1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="seller_city"):
        scan_csv(spark, str(tmp_path), SOURCES["sellers"])


def test_places_follow_the_files(spark, tmp_path, small_blocks):
    """Rows of two files, cut into many blocks, come in the order of their places as they were written; so do records of
    several lines, and the first of a key is the first in the files."""
    records = [(f"k{k % 40}", f"{(7 * k) % 400:03}", f"a\nb{k}" if k % 3 else "c") for k in range(1200)]
    for name, part in (("a.csv", records[:750]), ("b.csv", records[750:])):
        text = "".join(f'{a},{b},"{c}"\n' for a, b, c in part)
        (tmp_path / name).write_text("id,note,tail\n" + text)
    whole = NOTES, records
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.csv").write_text("id,note,tail\n" + "".join(f"{a},{b},{c[:1]}\n" for a, b, c in records))
    flat = LINES, [(a, b, c[:1]) for a, b, c in records]
    for folder, (source, expected) in ((f"{tmp_path}/*.csv", whole), (str(plain), flat)):
        scanned = scan_csv(spark, folder, source, placed=True)
        assert scanned.select(f"{PLACE}.block").distinct().count() > 2
        assert [tuple(row) for row in scanned.orderBy(PLACE).drop(PLACE).collect()] == expected
        first = first_per_key(scanned, ["id"])
        assert sorted(map(tuple, first.collect())) == sorted(expected[:40]) and PLACE not in first.columns
