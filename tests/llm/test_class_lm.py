"""Class bigrams against counts by dictionaries, every move against the likelihood, and better held-out scores than the base."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quaystar.llm import class_lm as lm
from quaystar.llm.common import table

NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def tokens_of(text):
    return [*(text or "").encode().lower().split(), lm.END]


def base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score of (doc_id, text) rows."""
    held = [zlib.crc32(str("" if doc is None else doc).encode()) % 7 == 2 for doc, _ in rows]
    seen = Counter(t for (_, text), out in zip(rows, held) if not out for t in tokens_of(text))
    n, v = sum(seen.values()), len(seen)
    out = []
    for (doc, text), left in zip(rows, held):
        tokens = tokens_of(text)
        score = sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((doc, left, len(tokens), sum(seen[t] > 0 for t in tokens), n, score))
    return out


def check_base(found, rows):
    key = lambda row: (row[0] is None, row[0], row[2], row[5])
    got, want = sorted((tuple(row) for row in found), key=key), sorted(base(rows), key=key)
    assert [row[:5] for row in got] == [row[:5] for row in want]
    assert [row[5] for row in got] == pytest.approx([row[5] for row in want], rel=1e-9)
    assert all(math.isfinite(row[6]) and row[6] <= 1e-9 for row in got)


def phrases(seed, docs):
    """Sentences in which kinds of words follow each other, so that classes tell more than single words."""
    pick = random.Random(seed)
    kinds = [[f"{kind}{k}" for k in range(40)] for kind in "abcd"]
    return [(d, " ".join(pick.choice(kinds[k % 4]) for k in range(pick.randint(0, 60)))) for d in range(docs)]


def test_edge_rows(spark, edge_docs, edge_rows):
    found = lm.scored(edge_docs, model=lm.Classes(least=3, words=6, block_tokens=500))
    assert found.columns == NAMES
    check_base(found.collect(), [row[:2] for row in edge_rows])


def test_empty_table(no_docs):
    assert lm.scored(no_docs).collect() == []


def test_no_training_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    from pyspark.sql import functions as F

    found = sorted(tuple(row) for row in lm.scored(docs, F.lit(True)).collect())
    assert [row[:6] for row in found] == [(1, True, 3, 0, 0, 0.0), (2, True, 1, 0, 0, 0.0)]


def test_classes_find_structure(spark):
    rows = phrases(1, 700)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = lm.Classes(words=8, least=3, rounds=5, block_tokens=2000)
    found = lm.scored(docs, model=model).collect()
    check_base(found, rows)
    held = [row for row in found if row.held_out]
    assert sum(row.score for row in held) > 0.8 * sum(row.base_score for row in held)  # log10: nearer to 0 is likelier


def test_scores_of_given_texts_by_hand(spark, monkeypatch):
    """The model's tables and the scores rebuilt from the classes that were found, with dictionaries."""
    rows = phrases(2, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = lm.Classes(words=5, least=4, rounds=1, block_tokens=700)
    kept = {}
    original = lm._scores
    monkeypatch.setattr(lm, "_scores", lambda blocks, counts, classes, of: kept.update(blocks=blocks, classes=classes) or original(blocks, counts, classes, of))
    found = {row.doc_id: row.score for row in lm.scored(docs, model=model).collect()}
    words = {row.block: [bytes(entry.word) for entry in row.entries] for row in kept["blocks"].collect()}
    cls = {}
    for row in kept["classes"].where("pos is not null").collect():
        for pos, c in zip(lm._unpack(bytes(row.pos), "i4"), lm._unpack(bytes(row.cls), "u2")):
            assert cls.setdefault(words[row.block][pos], int(c)) == c
    seen = Counter()
    pairs = Counter()
    class_of = lambda t: 0 if t == lm.END else cls.get(t, 1)
    held = {row[0] for row in base(rows) if row[1]}
    for doc, text in rows:
        if doc not in held:
            tokens = tokens_of(text)
            seen.update(tokens)
            pairs.update(zip(map(class_of, [lm.END, *tokens]), map(class_of, tokens)))
    count = model.all
    of_class = [sum(pairs[c, d] for c in range(count)) for d in range(count)]
    share = [(n + 1) / (sum(of_class) + count) for n in of_class]
    slots = Counter(class_of(t) for t in seen)
    slots[1] += 1

    def score(text):
        out, before = 0.0, 0
        for t in tokens_of(text):
            c = class_of(t)
            out += math.log10((pairs[before, c] + count * share[c]) / (sum(pairs[before, d] for d in range(count)) + count))
            out += math.log10((seen[t] + 1) / (of_class[c] + slots[c]))
            before = c
        return out

    assert set(cls) == {t for t, n in seen.items() if n >= 4 and t != lm.END}
    for doc, text in rows:
        assert found[doc] == pytest.approx(score(text), rel=1e-9)


def test_each_move_is_the_best_one():
    pick = random.Random(3)
    size, words = 6, 20
    text = [0] + [x for _ in range(60) for x in (*(pick.randint(1, words - 1) for _ in range(9)), 0)]
    cls = [0] + [pick.randint(1, size - 1) for _ in range(words - 1)]

    def matrix_with(classes):
        out = np.zeros((size, size), "i8")
        for a, b in zip(text, text[1:]):
            out[classes[a], classes[b]] += 1
        return out

    for word in range(1, words):
        if cls[word] < lm.FIRST:
            continue
        vec = np.zeros(2 * size + 1, "i8")
        for a, b in zip(text, text[1:]):
            vec[cls[b]] += a == word
            vec[size + cls[a]] += b == word
            vec[2 * size] += a == b == word
        state = matrix_with(cls)
        to = int(lm.best_classes(state, np.array([cls[word]]), vec[None])[0])
        options = {c: lm.likelihood(matrix_with([*cls[:word], c, *cls[word + 1 :]])) for c in range(lm.FIRST, size)}
        assert options[to] == pytest.approx(max(options.values()))
        lm.moved(state, cls[word], to, vec)
        cls[word] = to
        assert (state == matrix_with(cls)).all()


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(4)
    matrix = rng.integers(0, 9, (5, 5))
    of = lm.tables(matrix, np.array([0, 3, 2, 1, 4]), int(matrix.sum()), 11)
    assert (10**of.transitions).sum(1) == pytest.approx(np.ones(5))


def test_whole_table(spark):
    frame = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(row) for row in frame.select("doc_id", "text").collect()]
    check_base(lm.scored(frame).collect(), rows)


def test_blocks_are_not_shuffled_for_each_round(spark):
    """The stored blocks lie in buckets by block: the join of each round moves only their pieces, and scores stay whole."""
    rows = phrases(7, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.Classes(least=3, words=6, block_tokens=500)
    blocks = lm.encoded(docs, ~lm.held_out(), model)
    classes = lm.counted(blocks, model).drop("all_pos", "n", "sums")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # pieces of large tables are not broadcast
    try:
        plan = lm.contexts(blocks, classes, model, words=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(block") == 1
    check_base(lm.scored(docs, model=model).collect(), rows)


def test_every_training_word_has_a_class(spark, monkeypatch):
    """Words that are seen once are classed as well, each by one class in all blocks; only words never seen are not."""
    rows = [(doc, f"{text} once{doc} twice{doc // 2}") for doc, text in phrases(5, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {}
    original = lm._scores
    monkeypatch.setattr(lm, "_scores", lambda blocks, counts, classes, of: kept.update(blocks=blocks, classes=classes, of=of) or original(blocks, counts, classes, of))
    check_base(lm.scored(docs, model=lm.Classes(words=5, block_tokens=700)).collect(), rows)
    words = {row.block: [bytes(entry.word) for entry in row.entries] for row in kept["blocks"].collect()}
    cls = {}
    for row in kept["classes"].where("pos is not null").collect():
        for pos, c in zip(lm._unpack(bytes(row.pos), "i4"), lm._unpack(bytes(row.cls), "u2")):
            assert cls.setdefault(words[row.block][pos], int(c)) == c >= lm.FIRST
    held = {row[0] for row in base(rows) if row[1]}
    seen = Counter(t for doc, text in rows if doc not in held for t in tokens_of(text))
    assert held and set(cls) == set(seen) - {lm.END}
    unseen = 1 / (kept["of"].tokens + len(seen) + 1)  # as single words have it
    assert 10 ** kept["of"].transitions[:, lm.RARE] == pytest.approx(np.full(7, unseen))
    assert (10 ** kept["of"].transitions).sum(1) == pytest.approx(np.ones(7))


def test_moves_of_several_words_add_up():
    rng = np.random.default_rng(6)
    matrix, vecs = rng.integers(50, 90, (6, 6)), rng.integers(0, 4, (20, 13))
    old, new = rng.integers(2, 6, 20), rng.integers(2, 6, 20)
    one, all_ = matrix.copy(), matrix.copy()
    for k in range(20):
        lm.moved(one, old[k], new[k], vecs[k])
    lm.moved(all_, old, new, vecs)
    assert (one == all_).all()
