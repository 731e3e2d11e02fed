"""The pipeline, stage by stage, against plain versions of each stage, and its registration."""

import subprocess
import sys
import textwrap
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from quaystar.llm import private_data
from quaystar.llm.common import stored, table
from quaystar.llm.oracle import ORACLES, QUALITY
from tests.llm.test_private_data import base
from tests.llm.test_simhash import components, fingerprint

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent.parent


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and gave, as rows."""
    docs, out = table(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, FOLDER), f"test-{name}")
        out[name] = docs.collect(), after
        docs = after
    return out


def test_columns_of_documents(spark, stages):
    columns = table(spark, FOLDER, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "private_data", "mixing", "packing"]
    for name, (_, after) in stages.items():
        assert name == "packing" or after.columns == columns


def test_quality(stages):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    kept = {row[0] for row in connection.sql(f"SELECT doc_id FROM ({QUALITY}) WHERE kept").fetchall()}
    before, after = stages["quality"]
    assert {row.doc_id for row in after.collect()} == kept
    assert 0 < len(kept) < len(before)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    prints = {row.doc_id: fingerprint(row.text) for row in before}
    values = set(prints.values())
    near = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    root = components(values, near)
    least = {}
    for doc_id in sorted(prints):
        least.setdefault(root[prints[doc_id]], doc_id)
    assert {row.doc_id for row in after.collect()} == set(least.values())
    assert len(least) < len(before)


def test_private_data(stages):
    before, after = stages["private_data"]
    texts = {row.doc_id: row for row in after.collect()}
    assert len(texts) == len(before)
    found = 0
    for row in before:
        text, end, parts = row.text, 0, []
        for start, kind, stop in base(text):
            if start >= end:
                parts += [text[end:start], private_data.MARKS[private_data.KINDS[kind]]]
            end = max(end, stop)
        expected = "".join(parts) + text[end:]
        found += expected != text
        got = texts[row.doc_id].text
        # Disclosing words may be gone as well.
        assert got == expected or len(got) < len(expected) + 2 and "[TERM]" in got + "[TERM]"
        assert not base(got) and texts[row.doc_id].n_chars == len(got)
    assert found


def test_mixing(stages):
    before, after = stages["mixing"]
    rows = after.collect()
    assert Counter(map(tuple, before)) == Counter(map(tuple, rows))


def test_packing(stages):
    before, after = stages["packing"]
    words, bins = Counter(), defaultdict(list)
    for row in after.collect():
        words[row.doc_id] += row.n_words
        bins[row.bin].append(row)
    assert words == Counter({row.doc_id: len(row.text.encode().split()) for row in before})
    for members in bins.values():
        assert sum(row.n_words for row in members) <= 2048
        assert len({row.source for row in members}) == len(members)


def test_run_gives_the_pieces_of_the_same_documents(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    pieces = Counter((row.doc_id, row.start, row.n_words) for row in found.collect())
    assert pieces == Counter((row.doc_id, row.start, row.n_words) for row in stages["packing"][1].collect())


def test_every_dealt_operator_is_registered():
    sys.path.insert(0, str(REPO))
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_the_rest_works_without_this_part(tmp_path):
    """A copy of the repository without the text operators still has the other queries."""
    for name in ("quaystar", "oracles", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(REPO / name) if name != "quaystar" else None
    (tmp_path / "quaystar").mkdir()
    for part in (REPO / "quaystar").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "quaystar" / part.name).symlink_to(part)
    code = """
        import sys; sys.path.insert(0, ".")
        import importlib.util as u
        spec = u.spec_from_file_location("entry", "entry.py"); m = u.module_from_spec(spec); spec.loader.exec_module(m)
        assert "rpt_seller_rank" in m.queries() and not any(n.startswith("op") and n[2].isdigit() for n in m.queries())
        assert set(m.queries()) == set(m.oracle_sql())
    """
    (tmp_path / "entry.py").write_text((REPO / "__spark_entry__.py").read_text())
    (tmp_path / "__spark_entry__.py").unlink()
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, check=True, timeout=120)


def test_the_mix_decides_which_bins_a_source_reaches_first(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.lit("a b"), F.col("id")).alias("text"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("source"),
    )

    def packed(weights):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        mixed = stored(corpus_pipeline.mix(spark, docs, FOLDER), "test-mix")
        return corpus_pipeline.pack(spark, mixed, FOLDER).collect(), [row.doc_id for row in mixed.orderBy("_metadata.file_name", "_metadata.row_index").collect()]

    early = {}
    for weights in ({"even": 9, "odd": 1}, {"even": 1, "odd": 9}):
        rows, mix = packed(weights)
        place = {doc_id: k for k, doc_id in enumerate(mix)}
        assert sorted(place) == sorted(row.doc_id for row in rows) == list(range(9000))
        shards, first = defaultdict(list), {}
        for row in rows:
            shards[row.bin.split("-")[0]].append(place[row.doc_id])
            first[row.bin] = min(first.get(row.bin, 9000), place[row.doc_id])
        # Shards are runs of the mix, and the bins of all shards are named in its order.
        assert len(shards) == 3
        assert [x for _, places in sorted(shards.items()) for x in sorted(places)] == list(range(9000))
        assert [first[name] for name in sorted(first)] == sorted(first.values())
        start = [row.source for row in rows if row.bin < "1"]
        early[weights["even"]] = start.count("even") / len(start)
    assert early[9] > 0.8 and early[1] < 0.2
