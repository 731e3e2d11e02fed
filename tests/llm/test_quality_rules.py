import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quaystar.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The definition, word by word."""
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(line in lines[:k] for k, line in enumerate(lines)),
        len(covered),
    )


@pytest.mark.parametrize("text", ["", "a", "a b", "a a a a", "a b c a b c d", "é 😀 x y | <b>\n\n x\n x\n\x0b", "a\x1cb c\x85d " * 9])
def test_base_figures(text):
    assert tuple(rules.measure(text.encode())[0]) == base(text)


def test_repeats_beyond_a_million_distinct_words():
    import numpy as np

    ids = np.array([5, 6, 7, 8, 5, 6, 7, 9])
    assert rules.repeat_words(ids, 1 << 40) == rules.repeat_words(ids, 10) == 6


def test_divergence(spark):
    def entropy(p):
        return -sum(x * math.log2(x) for x in p if x)

    p, q = [3, 0, 1], [1, 1, 2]
    x, y = [v / 4 for v in p], [v / 4 for v in q]
    expected = entropy([(a + b) / 2 for a, b in zip(x, y)]) - (entropy(x) + entropy(y)) / 2
    row = spark.createDataFrame([(p, q, [0, 0, 0])], "p array<long>, q array<long>, none array<long>")
    found = row.select(rules.divergence(F.col("p"), F.col("q")), rules.divergence(F.col("none"), F.col("q"))).first()
    assert found[0] == pytest.approx(expected) and found[1] == 0


def test_whole_operator(edge_docs, edge_rows, no_docs):
    found, verdict = rules.judged(edge_docs)
    assert found.columns[:-1] == edge_docs.columns and verdict not in edge_docs.columns
    assert verdict == "_quality"
    rows = {row["quality"]: row for row in found.collect()}
    assert len(rows) == len(edge_rows)
    for row in edge_rows:
        value = rows[row[6]][verdict]
        figures = base(row[1])
        assert tuple(value[c] for c in rules.BASE) == figures
        assert value["base_failed"] == (figures[0] < 50 or 100 * figures[4] > 50 * figures[0])
        assert not (value["kept"] and value["base_failed"])
    assert rows["q0"][verdict]["kept"] and rows["q1"][verdict]["kept"]
    kept = {row["quality"] for row in rules.keep_good(edge_docs).collect()}
    assert kept == {name for name, row in rows.items() if row[verdict]["kept"]}
    assert rules.keep_good(edge_docs).columns == edge_docs.columns
    assert rules.judged(no_docs)[0].count() == 0


def test_other_alphabets_of_signs_are_rejected(spark):
    from tests.llm.conftest import prose

    rows = [(k, prose(100 + k, 200), "en") for k in range(40)]
    rows += [(50, " ".join(w + "%%%" for w in prose(7, 200).split()), "en"), (51, " | ".join(f"zu{k}ro" for k in range(200)), "en")]
    found, verdict = rules.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {row.doc_id for row in found.collect() if not row[verdict]["kept"]} == {50, 51}
