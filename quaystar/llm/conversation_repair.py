"""Conversation structure repair: Wagner-Fischer alignment of turns to the alternating grammar `(s?(ua)+)?`.

The grammar has at most one string of each length between two of its states, so an alignment is found by trying every
feasible length: a banded edit matrix for each target string, the band and the lengths cut by the cheapest cost found so
far (Ukkonen), and among equally cheap alignments the one whose backtraced audit is least.

A conversation may be as long as the table, so it is not one task's work. Turns are sorted by range over the whole table,
cut into blocks of a bounded number of turns, and every block is aligned for each pair of grammar states it may begin and
end in. Blocks of one conversation are then chained: the state between two blocks is all that passes from one to the next,
and equally cheap audits of one block are never prefixes of each other (the same letters cost the same), so the least
audit of the whole consists of least audits of its blocks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaystar.llm.common import Batches, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # what the edits cost
VISIBLE = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
BLOCK_TURNS = 32  # turns of a block that are not deleted for sure
KNOWN_SHAPES = 50_000  # alignments that a task remembers
ROLES = {"s": "system", "u": "user", "a": "assistant"}
STATES = ("", "s", "u", "a")  # the last role given out; "" at the beginning
NEXT = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
LEGAL = frozenset(("su", "ua", "au"))


# --- faults -----------------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(`conv_id:turn`) % 20 prescribes; nulls count as one space."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(what == 1, F.lit("")).when(what == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(what == 4, F.lit("user")).otherwise(text_of("role"))
    copies = F.when(what == 0, 0).when(what == 3, 2).otherwise(1)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies")).where("copies > 0")


def marked(rows: DataFrame) -> DataFrame:
    """One row for equal turns (`copies` of them), with the first fault of the first copy: blank, duplicate, truncated or ''.

    A turn is a duplicate if its conversation has the same role and text at an earlier turn; copies are duplicates of
    each other. Both are aggregates, which Spark reduces before the shuffle, so neither a conversation nor a turn that
    makes up a large part of the table meets in one task.
    """
    turns = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = F.sha2(F.concat(F.col("role"), F.lit("\n"), F.length("role").cast("string"), F.lit("\n"), F.col("text")), 256)
    turns = turns.withColumn("said", said)
    first = turns.groupBy(F.col("conv_id").alias("in_conv"), F.col("said").alias("first_said")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    )
    turns = turns.join(first, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("said") == F.col("first_said")))
    earlier = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(VISIBLE), "blank")
        .when(earlier, "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return turns.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


# --- alignment of a block ---------------------------------------------------------------------------------------------


def target(entry: str, leave: str, length: int) -> str | None:
    """The only string of this length that leads from one state to the other; None if there is none."""
    out, state = "", entry
    if length and entry == "":
        # From the beginning, 's' comes first or not, whichever makes the last letter right.
        plain = "".join("ua"[k % 2] for k in range(length))
        out = plain if plain[-1] == leave else "s" + plain[: length - 1]
        return out if out[-1] == leave else None
    for _ in range(length):
        state = NEXT[state][0]
        out += state
    return out if state == leave else None


@dataclass(frozen=True)
class Turn:
    """A turn that may stay; `gone`: so many turns after it are deleted for sure."""

    role: str
    truncated: bool
    gone: int = 0

    @property
    def initial(self) -> str:
        return self.role[:1]


def drift(d: int) -> int:
    """The least cost of coming d letters further in the target than in the turns."""
    return d * INSERT if d > 0 else -d * DELETE


def align(turns: list[Turn], goal: str, limit: int) -> tuple[int, str] | None:
    """The least cost of editing the turns into the goal and its least audit; None above the limit.

    best[i][j]: the cost of the turns from i on against the goal from j on. Only cells on diagonals that an alignment
    within the limit can touch are filled.
    """
    n, size = len(turns), len(goal)
    # Diagonals j - i whose way there and back to the end stays within the limit.
    ends = size - n
    low, high = 0, 0
    if drift(ends) > limit:
        return None
    while drift(low - 1) + drift(ends - low + 1) <= limit:
        low -= 1
    while drift(high + 1) + drift(ends - high - 1) <= limit:
        high += 1
    low, high = min(low, ends), max(high, ends)
    far = limit + 1
    best: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = best[i], best[i + 1] if i < n else {}
        turn = turns[i] if i < n else None
        more = TRUNCATED if turn and turn.truncated else 0
        for j in range(min(size, i + high), max(0, i + low) - 1, -1):
            if i == n and j == size:
                row[j] = 0
                continue
            cost = row.get(j + 1, far) + INSERT if j < size and goal[j] != "s" else far
            if turn:
                cost = min(cost, below.get(j, far) + DELETE)
                if j < size:
                    if turn.initial == goal[j]:
                        cost = min(cost, below.get(j + 1, far) + KEEP + more)
                    elif goal[j] != "s":
                        cost = min(cost, below.get(j + 1, far) + REROLE + more)
            if cost <= limit:
                row[j] = cost
    if 0 not in best[0]:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < size:
        left, below = best[i][j], best[i + 1] if i < n else {}
        turn = turns[i] if i < n else None
        more = TRUNCATED if turn and turn.truncated else 0
        if turn and below.get(j, far) + DELETE == left:  # in the order of the letters: D, I, K, R
            audit.append("D")
            i += 1
        elif j < size and goal[j] != "s" and best[i].get(j + 1, far) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turn.initial == goal[j] else "R")
            i, j = i + 1, j + 1
    return best[0][0], "".join(audit)


def cheapest(turns: list[Turn], entry: str, leave: str) -> tuple[int, str] | None:
    """The cheapest way from one state to the other through the turns, the least audit among the cheapest ones."""
    n = len(turns)
    shortest = next((k for k in range(3) if target(entry, leave, k) is not None), None)
    if shortest is None:
        return None
    # Nothing costs more than to delete all and insert the shortest string, or to keep one turn of it that can't be inserted.
    limit = n * DELETE + shortest * INSERT
    found: tuple[int, str] | None = None
    for step in range(n + limit // INSERT + 1):
        for length in {n - step, n + step}:
            goal = target(entry, leave, length) if length >= 0 and drift(length - n) <= limit else None
            if goal is not None and (got := align(turns, goal, limit)) and (found is None or got < found):
                found, limit = got, got[0]
        if drift(step) > limit and drift(-step) > limit:
            break
    return found


# --- blocks -----------------------------------------------------------------------------------------------------------


@dataclass
class Block:
    """Consecutive turns of one conversation, and what its neighbours need to know of them."""

    lead: int = 0  # turns at the beginning that are deleted for sure
    turns: list[Turn] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0))
    low: int | None = None
    high: int | None = None
    first: tuple | None = None  # initial and turn of the first row
    last: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str) -> None:
        initial = role[:1]
        if self.last:
            self.counts["illegal"] += self.last[0] + initial not in LEGAL
        self.counts["distinct"] += turn is not None and (self.last is None or self.last[1] != turn)
        self.counts["illegal"] += (copies - 1) * (initial + initial not in LEGAL)
        if turn is not None:
            self.low, self.high = turn if self.low is None else min(self.low, turn), turn if self.high is None else max(self.high, turn)
        self.first, self.last = self.first or (initial, turn), (initial, turn)
        if fault in ("blank", "duplicate"):
            self.counts[fault] += copies
            gone = copies
        else:
            self.counts["duplicate"] += copies - 1
            self.counts["truncated"] += fault == "truncated"
            self.turns.append(Turn(role, fault == "truncated"))
            self.texts.append(text)
            gone = copies - 1
        if gone and self.turns:
            self.turns[-1] = Turn(self.turns[-1].role, self.turns[-1].truncated, self.turns[-1].gone + gone)
        else:
            self.lead += gone

    def way(self, entry: str, leave: str, known: dict) -> tuple[int, str] | None:
        """Least cost and least audit from one state to the other. known: alignments found before, by what they depend on."""
        shape = entry, leave, *((turn.initial, turn.truncated) for turn in self.turns)
        if shape not in known:
            if len(known) >= KNOWN_SHAPES:
                known.clear()
            known[shape] = cheapest(self.turns, entry, leave)
        if not known[shape]:
            return None
        cost, letters = known[shape]
        # Certain deletions follow their turn at once, as D comes before I.
        audit, left = ["D" * self.lead], iter(self.turns)
        for letter in letters:
            audit.append(letter if letter == "I" else letter + "D" * next(left).gone)
        sure = DELETE * (self.lead + sum(turn.gone for turn in self.turns))
        return cost + sure, "".join(audit)

    def ways(self, known: dict) -> dict[tuple[str, str], tuple[int, str]]:
        return {(entry, leave): way for entry in STATES for leave in STATES if (way := self.way(entry, leave, known))}

    def packed(self) -> str:
        turns = [[turn.role, turn.truncated, turn.gone, text] for turn, text in zip(self.turns, self.texts, strict=True)]
        return json.dumps([self.lead, turns, self.counts, self.low, self.high])

    @staticmethod
    def unpacked(packed: str) -> "Block":
        lead, turns, counts, low, high = json.loads(packed)
        return Block(lead, [Turn(*turn[:3]) for turn in turns], [turn[3] for turn in turns], counts, low, high)

    def steps(self, audit: str) -> Iterator[tuple[str, Turn | None, str]]:
        """The letters of the audit that are no certain deletion, each with the turn it edits."""
        at, skip = 0, self.lead
        for letter in audit:
            if skip:
                skip -= 1
            elif letter == "I":
                yield letter, None, ""
            else:
                yield letter, self.turns[at], self.texts[at]
                at, skip = at + 1, self.turns[at].gone

    def repaired(self, audit: str, entry: str) -> list[tuple[str, str]]:
        """Role and text of the turns that the audit of this block leaves, in order."""
        left = [step for step in self.steps(audit) if step[0] != "D"]
        system = not entry and left and left[0][0] == "K" and left[0][1].initial == "s"
        state, out = entry, []
        for k, (letter, turn, text) in enumerate(left):
            state = "s" if system and k == 0 else "u" if state != "u" else "a"
            out.append((turn.role if letter == "K" else ROLES[state], text))
        return out


def blocks_of(rows: Iterable[tuple], size: int = BLOCK_TURNS) -> Iterator[tuple]:
    """(conv_id, block, whether the block is certainly the whole conversation) for the sorted rows of one partition.

    The first and the last conversation may go on in the partitions beside this one.
    """
    block, conv, begins_inside, parts = None, None, False, 0
    for conv_id, *turn in rows:
        new = block is not None and conv_id != conv
        if new:
            yield conv, block, begins_inside and not parts
            block, begins_inside, parts = None, True, 0
        elif block is not None and len(block.turns) >= size:
            yield conv, block, False
            block, parts = None, parts + 1
        if block is None:
            block, conv = Block(), conv_id
        block.add(*turn)
    if block is not None:
        yield conv, block, False


# --- chains of blocks -------------------------------------------------------------------------------------------------


class Chain:
    """The cheapest way to each state over the blocks seen so far; what all ways share is given out at once."""

    def __init__(self) -> None:
        self.ways: dict[str, tuple[int, str, tuple]] = {"": (0, "", ())}  # state: cost, audit, (entry, audit) of each open block
        self.open: list = []  # labels of the blocks that are not given out yet

    def add(self, label, table: dict[tuple[str, str], tuple[int, str]]) -> Iterator[tuple]:
        """(label, entry, audit) of the blocks that are decided now."""
        new: dict[str, tuple[int, str, tuple]] = {}
        for (entry, leave), (cost, audit) in table.items():
            if entry in self.ways:
                before = self.ways[entry]
                way = (before[0] + cost, before[1] + audit, (*before[2], (entry, audit)))
                if leave not in new or way[:2] < new[leave][:2]:
                    new[leave] = way
        self.ways = new
        self.open.append(label)
        paths = [way[2] for way in new.values()]
        shared = 0
        while shared < len(self.open) and len({path[shared] for path in paths}) == 1:
            shared += 1
        yield from self.give(paths[0], shared)

    def give(self, path: tuple, count: int) -> Iterator[tuple]:
        yield from ((label, *step) for label, step in zip(self.open[:count], path[:count], strict=True))
        gone = sum(len(audit) for _, audit in path[:count])
        self.open = self.open[count:]
        # What goes is the same in all ways but for its cost, which still decides between them.
        self.ways = {state: (cost, audit[gone:], steps[count:]) for state, (cost, audit, steps) in self.ways.items()}

    def end(self) -> Iterator[tuple]:
        way = min(self.ways[state] for state in ("", "a") if state in self.ways)
        yield from self.give(way[2], len(self.open))


# --- the operator -----------------------------------------------------------------------------------------------------

COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")
REPAIRED = "part int, seq int, entry string, cost long, audit string, turns array<struct<role: string, text: string>>, " + ", ".join(
    f"{name} long" for name in (*COUNTS, "low", "high")
)


def _kind(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def _records(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 256) -> Batches:
    """Rows as record batches of a few hundred, as they come."""
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield _batch(some, schema)
            some = []
    if some:
        yield _batch(some, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _mapped(rows: DataFrame, schema: str, work) -> DataFrame:
    """work: from an iterator of tuples to an iterator of tuples, one call for each partition."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Batches) -> Batches:
        yield from _batches(work(_records(batches)), kind)

    return rows.mapInArrow(run, schema)


def _outcome(block: Block, entry: str, cost: int, audit: str, extra: tuple[int, int] = (0, 0)) -> tuple:
    """The columns of REPAIRED from `cost` on. extra: an illegal pair and a turn shared with the block before."""
    counts = block.counts | {"illegal": block.counts["illegal"] + extra[0], "distinct": block.counts["distinct"] - extra[1]}
    turns = [{"role": role, "text": text} for role, text in block.repaired(audit, entry)]
    return entry, cost, audit, turns, *(counts[name] for name in COUNTS), block.low, block.high


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id and REPAIRED, one row for each block of consecutive turns, in order of part and seq.

    rows: conv_id, turn (long), role, text without nulls but for conv_id and turn, and copies (how often the row stands
    there). Turns are in order of turn (nulls first), then role and text. Equal rows are copies, hence duplicates. A null
    conv_id is a conversation of its own. A role whose initial is not s, u or a, or that is empty, can't stay as it is.
    An empty table gives no rows.
    """
    order = ("conv_id", "turn", "role", "text")
    turns = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = _kind(rows)

    def cut(records: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part, known = TaskContext.get().partitionId(), {}
        for seq, (conv, block, whole) in enumerate(blocks_of(records)):
            if whole:
                cost, audit = min(way for leave in ("", "a") if (way := block.way("", leave, known)))
                yield conv, part, seq, *_outcome(block, "", cost, audit), None, None
            else:
                table = [[*pair, *way] for pair, way in block.ways(known).items()]
                yield conv, part, seq, None, None, None, None, *[None] * 7, json.dumps([block.first, block.last, table]), block.packed()

    found = stored(_mapped(turns, f"{kind}, {REPAIRED}, ways string, packed string", cut), "turn_blocks")
    whole, parted = found.where("packed is null").drop("ways", "packed"), found.where("packed is not null")
    return whole.unionByName(_chained(parted))


def _chained(blocks: DataFrame) -> DataFrame:
    """Blocks of conversations that have several, or that lie at the end of a partition."""
    kind = _kind(blocks)

    def decide(records: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(records, key=lambda row: row[0]):
            chain, last = Chain(), None
            for _, part, seq, ways in group:
                first, final, table = json.loads(ways)
                extra = (last[0] + first[0] not in LEGAL, first[1] is not None and last[1] == first[1]) if last else (0, 0)
                last = final
                costs = {(entry, leave): (cost, audit) for entry, leave, cost, audit in table}
                yield from chain.add((part, seq, *map(int, extra), costs), costs)
            yield from chain.end()

    def decided(records: Iterator[tuple]) -> Iterator[tuple]:
        for (part, seq, illegal, same, costs), entry, audit in decide(records):
            cost = next(way[0] for pair, way in costs.items() if pair[0] == entry and way[1] == audit)
            yield part, seq, illegal, same, entry, cost, audit

    ways = blocks.select("conv_id", "part", "seq", "ways").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    chosen = _mapped(ways, "part int, seq int, illegal int, same int, entry string, cost long, audit string", decided)

    def mend(records: Iterator[tuple]) -> Iterator[tuple]:
        for conv, part, seq, packed, illegal, same, entry, cost, audit in records:
            yield conv, part, seq, *_outcome(Block.unpacked(packed), entry, cost, audit, (illegal, same))

    both = blocks.select("conv_id", "part", "seq", "packed").join(chosen, ["part", "seq"])
    both = both.select("conv_id", "part", "seq", "packed", "illegal", "same", "entry", "cost", "audit")
    return _mapped(both, f"{kind}, {REPAIRED}", mend)


def summed_up(blocks: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    A hash of a whole text follows its order, so the blocks of a conversation pass through one task, one after another;
    no more than one batch of them is held.
    """

    def digest(records: Iterator[tuple]) -> Iterator[tuple]:
        for conv, group in groupby(records, key=lambda row: row[0]):
            sums, lows, highs, audits, cost = dict.fromkeys(COUNTS, 0), [], [], [], 0
            text, begun = hashlib.sha256(), False
            for _, _, _, _, more, audit, turns, *counts, low, high in group:
                for name, count in zip(COUNTS, counts, strict=True):
                    sums[name] += count
                lows, highs = ([f(known)] if (known := [x for x in (*old, x) if x is not None]) else [] for f, old, x in ((min, lows, low), (max, highs, high)))
                audits.append(audit)
                cost += more
                for turn in turns:
                    text.update(f"{chr(10) * begun}{turn['role']}:{turn['text']}".encode())
                    begun = True
            gaps = min(highs[0] - lows[0] + 1 - sums["distinct"], 2**63 - 1) if lows else 0
            yield conv, gaps, *(sums[name] for name in COUNTS[:4]), cost, "".join(audits), text.hexdigest()

    rows = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    longs = ", ".join(f"{name} long" for name in ("gaps", *COUNTS[:4], "cost"))
    return _mapped(rows, f"{_kind(blocks)}, {longs}, audit string, repaired_sha256 string", digest)


def repair_report(conversations: DataFrame, damage=damaged) -> DataFrame:
    """What `summed_up` tells of every conversation of the table, after the damage.

    A conversation that lost all its rows has zeros, an empty audit and the hash of the empty string; a null conv_id is
    one conversation, reported with a null conv_id. Other columns of the table are not looked at.
    """
    found = summed_up(repaired(damage(conversations)))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    values = [F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name) for name in ("gaps", *COUNTS[:4], "cost")]
    empty = hashlib.sha256().hexdigest()
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *values, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")
    )
