"""Brown class-based bigrams: words get classes by exchange, and log P(text) = sum of log P(class | class before) + log P(word | class).

How it is spread over a cluster:

1. Tasks cut the documents into blocks of about a million tokens and number the words of each block. Blocks are stored:
   what follows moves numbers, one for each word of a block, never one for each token.
2. Words meet by a shuffle and their training counts are added up over all blocks; a word has one row in each block at
   most, so the most frequent word has no more rows than there are blocks. Counts go back to the blocks in packed pieces.
3. A round of exchange: every block gives the class matrix and, for each of its words seen in training, how often each class
   stands before and after it, packed by parts of the vocabulary. A part's pieces meet in one task, which moves each word to
   the class that raises the likelihood most, given the matrix and the moves made there before (few words, or words of a
   small share of the tokens, are judged at a time). Tasks don't see each other's moves, as in other distributed exchange
   clusterings, so the next round starts from the true matrix, and the round of the highest likelihood is taken at the end.
4. Blocks look up their counts and classes and score their documents.

All that reaches the driver is the matrix of classes and one sum for each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystar.llm.common import Batches, bucketed, stored, utf8, words_of

END = b" "  # the token after the last word; no word has a space
ENDING, RARE, FIRST = 0, 1, 2  # class of END; of words rarer than `least`, unseen ones included; first class of the others
PART = 400_000  # words of blocks that are counted together, and later judged by one task at a time


@dataclass(frozen=True)
class Classes:
    """`words` classes of words counted `least` times or more, by default of all that training documents hold; rarer words
    share one; rounds of exchange."""

    words: int = 32
    least: int = 1
    rounds: int = 2
    block_tokens: int = 1 << 20

    @property
    def all(self) -> int:
        return FIRST + self.words

    @property
    def slots(self) -> int:
        """Counts of a word: by the class after it, by the class before it, and after itself."""
        return 2 * self.all + 1


# --- blocks -----------------------------------------------------------------------------------------------------------


def _pack(values, kind: str) -> bytes:
    return zstandard.compress(np.asarray(values, kind).tobytes(), 1)


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


def encoded(docs: DataFrame, training: Column, model: Classes) -> DataFrame:
    """Stored blocks: block, doc_ids, train (a flag each), sizes (tokens each), codes, and words with their training counts."""
    rows = docs.select("doc_id", training.alias("train"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    limit = model.block_tokens

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        names = ["block", "doc_ids", "train", "sizes", "codes", "entries"]
        entry = pa.struct([("word", pa.binary()), ("seen", pa.int64())])
        ids, codes, doc_ids, train, doc_kind = {END: 0}, [], [], [], None

        def block() -> pa.RecordBatch:
            sizes = [len(code) for code in codes]
            every = np.concatenate(codes)
            seen = np.bincount(every[np.repeat(train, sizes)], minlength=len(ids))
            entries = pa.StructArray.from_arrays([pa.array(list(ids), pa.binary()), pa.array(seen, pa.int64())], fields=list(entry))
            columns = [
                pa.array([(part << 32) + seq], pa.int64()),
                pa.array([doc_ids], pa.list_(doc_kind)),
                pa.array([_pack(train, "u1")], pa.binary()),
                pa.array([_pack(sizes, "i8")], pa.binary()),
                pa.array([_pack(every, "i4")], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        tokens = 0
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, len(whole), 256)):
            doc_kind = batch.schema.field(0).type
            for doc_id, flag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                code = [ids.setdefault(word, len(ids)) for word in words_of(text.lower())]
                code.append(0)
                codes.append(np.array(code, "i4"))
                doc_ids.append(doc_id)
                train.append(flag)
                tokens += len(code)
                if tokens >= limit:
                    yield block()
                    ids, codes, doc_ids, train, tokens, seq = {END: 0}, [], [], [], 0, seq + 1
        if codes:
            yield block()

    schema = f"block long, doc_ids array<{kind}>, train binary, sizes binary, codes binary, entries array<struct<word: binary, seen: long>>"
    return bucketed(rows.mapInArrow(run, schema), "lm_blocks", "block")


# --- words of all blocks ----------------------------------------------------------------------------------------------


def _whole_groups(batches: Batches, column: int, rows: int = 100_000) -> Iterator[list[pa.Array]]:
    """The columns of sorted batches, in pieces of about so many rows that never cut a run of equal values of one column."""
    waiting, held, due = [], 0, rows
    for batch in batches:
        waiting.append(batch)
        held += len(batch)
        if held >= due:
            whole = pa.Table.from_batches(waiting).combine_chunks()
            start = pc.index(whole.column(column), whole.column(column)[-1]).as_py()
            if start:
                yield [value.chunk(0) for value in whole.slice(0, start).columns]
            waiting, held = whole.slice(start).to_batches(), len(whole) - start
            due = max(rows, 2 * held)
    if held:
        yield [value.chunk(0) for value in pa.Table.from_batches(waiting).combine_chunks().columns]


def _groups(values: pa.Array) -> np.ndarray:
    """The number of the run of equal values that each row is in."""
    if len(values) < 2:
        return np.zeros(len(values), "i8")
    new = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(new)])


def _by_block(block: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Each block with its part of the columns."""
    order = np.argsort(block, kind="stable")
    found, starts = np.unique(block[order], return_index=True)
    for one, rows in zip(found, np.split(order, starts[1:]), strict=True):
        yield int(one), *(column[rows] for column in columns)


CLASSED = "block long, part long, pos binary, cls binary, key binary, sizes binary"
CLASSED_KIND = pa.schema([("block", pa.int64()), ("part", pa.int64())] + [(name, pa.binary()) for name in ("pos", "cls", "key", "sizes")])
COUNTED = f"{CLASSED}, all_pos binary, n binary, sums binary"
COUNTED_KIND = pa.schema([*CLASSED_KIND, *((name, pa.binary()) for name in ("all_pos", "n", "sums"))])


def first_class(n: np.ndarray, key: np.ndarray, model: Classes) -> np.ndarray:
    """Words are first classed by the logarithm of their counts; those of one size are dealt over four classes."""
    return FIRST + ((2 * np.log2(n / model.least)).astype("i8") + key % 4) % model.words


def counted(blocks: DataFrame, model: Classes) -> DataFrame:
    """Stored: for pieces of blocks, numbers (all_pos) and training counts (n) of words, and the first class of frequent ones.

    Frequent words get a number of their own, `key`. All rows of a word are in one part. sums: training tokens, distinct
    ones, words of the class RARE.
    """
    entries = blocks.select("block", F.posexplode("entries").alias("pos", "entry")).select("block", "pos", "entry.word", "entry.seen")

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        key = part = TaskContext.get().partitionId() << 32
        for block, pos, word, seen in _whole_groups(batches, 2, PART):
            block, pos = block.to_numpy(), pos.to_numpy()
            group = _groups(word)
            n = np.bincount(group, weights=seen.to_numpy()).astype("i8")
            first = np.flatnonzero(np.diff(group, prepend=-1))
            end = pc.equal(word, END).to_numpy(zero_copy_only=False)[first]
            frequent = (n >= model.least) & ~end
            keys = key + np.cumsum(frequent)
            cls = first_class(np.maximum(n, model.least), keys, model)
            key = int(keys[-1])
            sums = np.array([n.sum(), (n > 0).sum(), ((n > 0) & ~frequent & ~end).sum()])
            rows = [
                {"block": one, "all_pos": _pack(places, "i4"), "n": _pack(counts, "i8"), "sums": (sums if k == 0 else np.zeros(0)).astype("i8").tobytes()}
                for k, (one, places, counts) in enumerate(_by_block(block, pos, n[group]))
            ]
            some = frequent[group]
            if some.any():
                of = group[some]
                sizes = np.bincount(cls[frequent], minlength=model.all)
                for one, places, classes, names in _by_block(block[some], pos[some], cls[of], keys[of]):
                    steps = np.diff(names, prepend=0)  # keys ascend, so steps are small
                    packed = {"pos": _pack(places, "i4"), "cls": _pack(classes, "u2"), "key": _pack(steps, "i8")}
                    rows.append({"block": one, "part": part, **packed, "sizes": sizes.astype("i8").tobytes()})
                    sizes = np.zeros(0)  # they go with the first row
                part += 1
            yield pa.RecordBatch.from_pylist(rows, schema=COUNTED_KIND)

    return stored(entries.repartition("word").sortWithinPartitions("word").mapInArrow(run, COUNTED), "lm_counts")


def _with_pieces(blocks: DataFrame, pieces: DataFrame, names: list[str], name: str) -> DataFrame:
    """The blocks with a list of their pieces."""
    some = pieces.where(F.col(names[0]).isNotNull()).groupBy("block").agg(F.collect_list(F.struct(*names)).alias(name))
    return blocks.join(some, "block", "left")


def _together(pieces, name: str, kind: str) -> np.ndarray:
    """One packed column of all pieces of a block. pieces: a list scalar."""
    if not pieces.is_valid:
        return np.empty(0, kind)
    return np.concatenate([np.empty(0, kind), *(_unpack(piece[name].as_py(), kind) for piece in pieces.values)])


def _classes_of(pieces, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each word of a block, and the numbers of its frequent words."""
    cls = np.full(size, RARE, "i8")
    cls[0] = ENDING
    pos = _together(pieces, "pos", "i4")
    cls[pos] = _together(pieces, "cls", "u2")
    return cls, pos


def summed(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """The sum of packed vectors of so many numbers (or of none): one row for each number reaches the driver."""

    def add(batches: Batches) -> Batches:
        total = np.zeros(size, "i8")
        for batch in batches:
            for vector in batch.column(0):
                values = np.frombuffer(vector.as_py(), "i8")
                total[: len(values)] += values
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total[cells], pa.int64())], names=["cell", "n"])

    cells = rows.where(F.col(column).isNotNull()).select(column).mapInArrow(add, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size, "i8")
    for row in cells.collect():
        out[row.cell] = row.n
    return out


# --- exchange ---------------------------------------------------------------------------------------------------------


def pairs_of(codes: np.ndarray, sizes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each training token and the one before it; documents begin after an END."""
    after = codes[np.repeat(train.astype(bool), sizes)]
    return np.concatenate([np.zeros(1, after.dtype), after[:-1]]) if len(after) else after, after


FOUND = "block long, part long, pos binary, cls binary, key binary, cells binary, slots binary, n binary, matrix binary"


def contexts(blocks: DataFrame, classes: DataFrame, model: Classes, words: bool) -> DataFrame:
    """matrix: the class matrix of a block. With words instead, for each block and part the rows of its words as in CLASSED,
    and their counts: the number of counts of each word (cells), and the slot and count of each."""
    count, slots = model.all, model.slots
    kinds = [("block", pa.int64()), ("part", pa.int64())] + [(name, pa.binary()) for name in ("pos", "cls", "key", "cells", "slots", "n", "matrix")]

    def run(batches: Batches) -> Batches:
        schema = pa.schema(kinds)
        for batch in batches:
            for block, train, sizes, codes, known in zip(*batch.columns, strict=True):
                flags, lengths, code = _unpack(train.as_py(), "u1"), _unpack(sizes.as_py(), "i8"), _unpack(codes.as_py(), "i4")
                cls, pos = _classes_of(known, int(code.max()) + 1)
                before, after = pairs_of(code, lengths, flags)
                rank = np.full(len(cls), -1, "i8")
                rank[pos] = np.arange(len(pos))
                matrix, table = np.zeros(count * count, "i8"), np.zeros(len(pos) * slots if words else 0, "i4")
                for at in range(0, len(after), 1 << 18):  # a slice of the tokens at a time, to hold little
                    some = slice(at, at + (1 << 18))
                    one, two = cls[before[some]], cls[after[some]]
                    if words:
                        left, right, same = rank[before[some]], rank[after[some]], before[some] == after[some]
                        np.add.at(table, (left * slots + two)[left >= 0], 1)
                        np.add.at(table, (right * slots + count + one)[right >= 0], 1)
                        np.add.at(table, (left * slots + 2 * count)[same & (left >= 0)], 1)
                    else:
                        matrix += np.bincount(one * count + two, minlength=count * count)
                if not words:
                    yield pa.RecordBatch.from_pylist([{"block": block.as_py(), "matrix": matrix.tobytes()}], schema=schema)
                    continue
                at, rows, held = 0, [], 0
                for piece in known.values if known.is_valid else []:
                    row = {"block": block.as_py(), **piece.as_py()}
                    size = len(_unpack(row["pos"], "i4"))
                    part = table[at * slots : (at + size) * slots]
                    cells = np.flatnonzero(part)
                    row |= {"cells": _pack(np.bincount(cells // slots, minlength=size), "u2"), "slots": _pack(cells % slots, "u2"), "n": _pack(part[cells], "u4")}
                    at, held = at + size, held + size
                    rows.append(row)
                    if held >= PART:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    names = ["part", "pos", "cls", "key"] if words else ["pos", "cls"]
    return _with_pieces(blocks.select("block", "train", "sizes", "codes"), classes, names, "known").mapInArrow(run, FOUND)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """What the classes contribute to the log likelihood of the training text."""
    return float(xlogx(matrix).sum() - xlogx(matrix.sum(0)).sum() - xlogx(matrix.sum(1)).sum())


def best_classes(matrix: np.ndarray, cls: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """For each word the class of highest likelihood, the other words staying where they are; its own one if none is better.

    Only the cells of the matrix that a word has counts for change, so a rare word has few to look at.
    """
    size, word = len(matrix), np.arange(len(cls))
    after, before, same = vecs[:, :size].copy(), vecs[:, size : 2 * size].copy(), vecs[:, -1]
    n = after.sum(1)
    after[word, cls] -= same
    before[word, cls] -= same
    total = np.repeat(matrix.sum(1)[None], len(cls), 0)
    total[word, cls] -= n
    inner = np.repeat(np.diagonal(matrix)[None], len(cls), 0)
    inner[word, cls] -= after[word, cls] + before[word, cls] + same
    gain = xlogx(inner + after + before + same[:, None]) - xlogx(inner) - 2 * (xlogx(total + n[:, None]) - xlogx(total))
    for counts, others, cells in ((after, before, matrix.T), (before, after, matrix)):
        of, to = np.nonzero(counts)
        if not len(of):
            continue
        k, added, own = np.arange(len(of)), counts[of, to], cls[of]
        rest = cells[to]  # the matrix without the word
        rest[k, own] -= added
        rest[to == own] -= others[of[to == own]]
        change = xlogx(rest + added[:, None]) - xlogx(rest)
        change[k, to] = 0  # these cells are the inner ones
        first = np.flatnonzero(np.diff(of, prepend=-1))
        gain[of[first]] += np.add.reduceat(change, first)
    to = FIRST + np.argmax(gain[:, FIRST:], 1)
    return np.where(gain[word, to] > gain[word, cls] + 1e-9, to, cls)


def moved(matrix: np.ndarray, cls, to, vec: np.ndarray) -> None:
    """Changes the matrix as a word moves from one class to another, or as several do."""
    size = len(matrix)
    cls, to, vec = np.atleast_1d(cls), np.atleast_1d(to), np.atleast_2d(vec)
    after, before, same, word = vec[:, :size].copy(), vec[:, size : 2 * size].copy(), vec[:, -1], np.arange(len(vec))
    after[word, cls] -= same
    before[word, cls] -= same
    for where, sign in ((cls, -1), (to, 1)):
        np.add.at(matrix, where, sign * after)
        np.add.at(matrix.T, where, sign * before)
        np.add.at(matrix, (where, where), sign * same)


def _moves(state: np.ndarray, old: np.ndarray, vecs: np.ndarray, at_once: int, tokens: int) -> np.ndarray:
    """New classes of words. Judged together are at_once words, or up to 512 that are seen `tokens` times in all; the state
    takes their moves before the next are judged."""
    new, seen, at = old.copy(), np.cumsum(vecs[:, : len(state)].sum(1)), 0
    while at < len(old):
        till = int(np.searchsorted(seen, (seen[at - 1] if at else 0) + tokens, "right"))
        some = slice(at, max(at + at_once, min(till, at + 512)))
        new[some] = best_classes(state, old[some], vecs[some])
        gone = at + np.flatnonzero(new[some] != old[some])
        moved(state, old[gone], new[gone], vecs[gone])
        at = some.stop
    return new


def exchanged(found: DataFrame, matrix: np.ndarray, model: Classes, at_once: int = 8) -> DataFrame:
    """Stored rows of CLASSED after every frequent word has moved to its best class; at_once: words judged together, or words
    that hold a thousandth of the tokens."""
    slots, tokens = model.slots, int(matrix.sum()) // 1000

    def part_of(state: np.ndarray, rows: list[dict]) -> Iterator[dict]:
        keys = [np.cumsum(_unpack(row["key"], "i8")) for row in rows]
        names, word = np.unique(np.concatenate(keys), return_inverse=True)
        new = np.empty(len(names), "i8")
        new[word] = np.concatenate([_unpack(row["cls"], "u2") for row in rows])
        of_cell = np.repeat(word, np.concatenate([_unpack(row["cells"], "u2") for row in rows]))
        order = np.argsort(of_cell, kind="stable")
        of_cell = of_cell[order]
        slot, n = (np.concatenate([_unpack(row[name], kind) for row in rows])[order] for name, kind in (("slots", "u2"), ("n", "u4")))
        for at in range(0, len(names), 10_000):  # so many words' counts as a table
            start, stop = np.searchsorted(of_cell, [at, at + 10_000])
            size = min(10_000, len(names) - at)
            vecs = np.bincount((of_cell[start:stop] - at) * slots + slot[start:stop], weights=n[start:stop], minlength=size * slots)
            new[at : at + size] = _moves(state, new[at : at + size], vecs.astype("i8").reshape(-1, slots), at_once, tokens)
        sizes, at = np.bincount(new, minlength=model.all).astype("i8").tobytes(), 0
        for row, key in zip(rows, keys, strict=True):
            yield {name: row[name] for name in ("block", "part", "pos", "key")} | {"cls": _pack(new[word[at : at + len(key)]], "u2"), "sizes": sizes}
            at, sizes = at + len(key), b""

    def run(batches: Batches) -> Batches:
        state = matrix.copy()
        for columns in _whole_groups(batches, 1, 1):
            rows = pa.RecordBatch.from_arrays(columns, names=["block", "part", "pos", "cls", "key", "cells", "slots", "n"])
            starts = np.flatnonzero(np.diff(_groups(columns[1]), prepend=-1))
            for at, till in zip(starts, [*starts[1:], len(rows)], strict=True):
                part = rows.slice(at, till - at).to_pylist()
                yield pa.RecordBatch.from_pylist(list(part_of(state, part)), schema=CLASSED_KIND)

    rows = found.select("block", "part", "pos", "cls", "key", "cells", "slots", "n").repartition("part").sortWithinPartitions("part")
    return stored(rows.mapInArrow(run, CLASSED), "lm_classes")


# --- scores -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tables:
    """What scores need: training tokens and distinct ones, log10 of transitions, and of each class tokens plus slots."""

    tokens: int
    distinct: int
    transitions: np.ndarray
    masses: np.ndarray


def tables(matrix: np.ndarray, sizes: np.ndarray, tokens: int, distinct: int, all_classed: bool = False) -> Tables:
    """sizes: words of each class. Counts of words get one added; RARE has one more slot, for all words never seen.

    A transition mixes what was seen after the class with the share of the class, which weighs as much as one pair a class.
    With all words of training documents in the other classes, no text tells what RARE follows: a word never seen then has
    the probability that single words give it.
    """
    count = len(matrix)
    of_class = matrix.sum(0)
    share = (of_class + 1) / (of_class.sum() + count)
    mixed = (matrix + count * share) / (matrix.sum(1, keepdims=True) + count)
    if all_classed and tokens:
        unseen = 1 / (tokens + distinct + 1)
        mixed *= ((1 - unseen) / (1 - mixed[:, RARE]))[:, None]
        mixed[:, RARE] = unseen
    slots = sizes + 0
    slots[ENDING] = 1
    slots[RARE] += 1
    return Tables(tokens, distinct, np.log10(mixed), of_class + slots)


def token_scores(codes: np.ndarray, cls: np.ndarray, n: np.ndarray, of: Tables) -> np.ndarray:
    """log10 probability of each token of documents that end with END."""
    classes = cls[codes]
    before = np.concatenate([[ENDING], classes[:-1]])
    return of.transitions[before, classes] + np.log10((n[codes] + 1) / of.masses[classes])


def _scores(blocks: DataFrame, counts: DataFrame, classes: DataFrame, of: Tables) -> DataFrame:
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for doc_ids, train, sizes, codes, known, numbers in zip(*batch.columns, strict=True):
                lengths, code, counts = _unpack(sizes.as_py(), "i8"), _unpack(codes.as_py(), "i4"), _together(numbers, "n", "i8")
                counts[_together(numbers, "all_pos", "i4")] = counts.copy()
                cls, _ = _classes_of(known, len(counts))
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                base = np.log10((counts + 1) / (of.tokens + of.distinct + 1))[code]
                columns = [
                    doc_ids.values,
                    pa.array(_unpack(train.as_py(), "u1") == 0),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((counts > 0)[code].astype("i8"), starts)),
                    pa.array(np.full(len(lengths), of.tokens)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(token_scores(code, cls, counts, of), starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = _with_pieces(blocks.drop("entries"), classes, ["pos", "cls"], "known")
    rows = _with_pieces(rows, counts, ["all_pos", "n"], "numbers").select("doc_ids", "train", "sizes", "codes", "known", "numbers")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out() -> Column:
    """Documents that nothing is learned from; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def scored(docs: DataFrame, left_out: Column | None = None, model: Classes = Classes()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities), one row for each row of docs.

    Null and empty texts have one token, the end. Repeated rows are counted and reported as often as they stand there. Other
    columns are not looked at. Without training documents every token is unseen. An empty table gives no rows.
    """
    left_out = held_out() if left_out is None else left_out
    blocks = encoded(docs, ~left_out, model)
    counts = counted(blocks, model)
    tokens, distinct, rare = (int(value) for value in summed(counts, "sums", 3))
    best, classes = None, counts.drop("all_pos", "n", "sums")
    for k in range(model.rounds + 1):
        matrix = summed(contexts(blocks, classes, model, words=False), "matrix", model.all**2).reshape(model.all, model.all)
        if best is None or likelihood(matrix) > best[0]:
            best = likelihood(matrix), matrix, classes
        if k < model.rounds:
            classes = exchanged(contexts(blocks, classes, model, words=True), matrix, model)
    _, matrix, classes = best
    sizes = summed(classes, "sizes", model.all)
    sizes[RARE] = rare
    return _scores(blocks, counts, classes, tables(matrix, sizes, tokens, distinct, model.least <= 1))
