import hashlib
import random

import numpy as np
import pytest

from quaystar.llm import substring_dedup as passages
from tests.llm.conftest import prose


def brute_force(rows):
    """doc_id, words, removed, sha of what is kept, window by window."""
    order = {k: (row[0] is None, row[0] or 0) for k, row in enumerate(rows)}
    texts = [(row[1] or "").encode().split() for row in rows]
    first = {}
    for k, words in enumerate(texts):
        for s in range(len(words) - 19):
            window, place = tuple(words[s : s + 20]), (order[k], s)
            first[window] = min(first.get(window, place), place)
    out = []
    for k, words in enumerate(texts):
        gone = set()
        for s in range(len(words) - 19):
            if first[tuple(words[s : s + 20])] < (order[k], s):
                gone.update(range(s, s + 20))
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((rows[k][0], len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def results(docs, **options):
    found = passages.repeated_passages(docs, **options)
    return sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_all_kinds(spark, seed):
    pick = random.Random(seed)
    shared = [prose(1000 + k, pick.choice((19, 20, 21, 45))).split() for k in range(8)]
    rows = []
    for k in range(120):
        words = []
        for _ in range(pick.randint(0, 5)):
            words += pick.choice(shared) if pick.random() < 0.5 else prose(pick.randint(0, 10**9), pick.randint(1, 40)).split()
        if pick.random() < 0.1:
            words = ["a", "b"] * pick.randint(0, 40)
        rows.append((pick.choice((k, k, k, None)) if pick.random() < 0.1 else k, pick.choice((" ", "\n", "  ")).join(words)))
    rows += [(500 + k, rows[k][1]) for k in range(0, 30, 3)] + [(700, rows[0][1] + " " + rows[5][1])] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert results(docs, block_chars=5_000) == brute_force(rows)


def test_whole_operator(edge_docs, edge_rows, no_docs):
    assert results(edge_docs) == brute_force(edge_rows)
    assert passages.repeated_passages(no_docs).count() == 0


def test_spans_are_copies_of_what_they_refer_to(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a), (2, b), (3, "new words " + " ".join(a.split()[10:40]) + " between " + " ".join(b.split()[:25])), (4, "x " + a + " x")]
    texts = {k: t.split() for k, t in rows}
    found = {row.doc_id: row.spans or [] for row in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.end, s.reference, s.reference_start) for s in found[3]] == [(2, 32, 1, 10), (33, 58, 2, 0)]
    for doc, spans in found.items():
        for s in spans:
            assert texts[doc][s.start : s.end] == texts[s.reference][s.reference_start : s.reference_start + s.end - s.start]


def test_window_hash_depends_on_the_words_of_the_window_only():
    ids = np.random.default_rng(1).integers(0, 1 << 63, 64, np.uint64)
    twice = np.concatenate((ids, ids))
    for length in (1, 2, 8, 13, 20):
        hashes = passages._sequences(twice, length, 0x9E3779B97F4A7C15)
        assert len(hashes) == len(twice) - length + 1
        assert (hashes[: 64 - length + 1] == hashes[64 : 128 - length + 1]).all()
        assert len(np.unique(hashes[:64])) == 64


def test_entries_survive_their_packing():
    pick = np.random.default_rng(3)
    for size in (0, 1, 500):
        entries = np.empty(size, passages.ENTRY)
        for field, top in (("high", 1 << 63), ("low", 1 << 32), ("doc", 5), ("start", 1 << 32)):
            entries[field] = pick.integers(0, top, size, np.uint64)
        assert sorted(passages._entries_of(passages._entry_bytes(entries)).tolist()) == sorted(entries.tolist())
