"""Conversation repair against brute force: every string of the grammar by a plain walk over its states."""

import hashlib
import random
import zlib

import pytest

from quaystar.llm import conversation_repair as repair
from quaystar.llm.common import table

BLANKS = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        what = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if what == 0:
            continue
        if what == 1:
            text = ""
        if what == 2:
            text = "".join(c for c in text if c not in ".!?")
        if what == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if what == 3 else 1)


def audited(rows):
    """Cost, audit and repaired turns of the rows (role, text, fault): the least of all ways, kept for each state."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(3):  # more than a full round of insertions is never cheaper
            for state, (cost, audit, out) in list(ways.items()):
                for c in after[state]:
                    if c != "s":
                        way = (cost + 5, audit + "I", (*out, (names[c], "")))
                        if c not in ways or way[:2] < ways[c][:2]:
                            ways[c] = way
        return ways

    ways = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}

        def offer(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, out) in ways.items():
            offer(state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for c in after[state]:
                if role[:1] == c:
                    offer(c, (cost + more, audit + "K", (*out, (role, text))))
                elif c != "s":
                    offer(c, (cost + 1 + more, audit + "R", (*out, (names[c], text))))
        ways = inserted(new)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda way: way[:2])


def expected(rows):
    convs = {row[0]: [] for row in rows}
    for row in damage(rows):
        convs[row[0]].append(row[1:])
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, marked = set(), []
        for _, role, text in turns:
            body = text.strip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, left = audited(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (gaps, *(sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def found(frame):
    rows = repair.repair_report(frame).collect()
    assert len({row[0] for row in rows}) == len(rows)
    return {row[0]: tuple(row)[1:] for row in rows}


def made(seed, convs, turns):
    pick = random.Random(seed)
    rows = []
    for conv in range(convs):
        for k in range(pick.randint(1, turns)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ursa"])
            text = pick.choice(["Yes.", "No!", "Why?", "so", "", " \t", None, f"text {k}.", f"text {k}", "end. ", "end. \n"])
            rows.append((conv if conv else None, pick.choice([k, k, k, k * 3, None]), role, text))
    return rows


def test_faults_and_audits(spark):
    rows = made(1, 120, 14)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)


def test_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_TURNS", 4)
    monkeypatch.setattr(repair.blocks_of, "__defaults__", (4,))
    rows = made(2, 4, 300)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7)) == expected(rows)


def test_whole_table(spark):
    frame = table(spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(row) for row in frame.select("conv_id", "turn", "role", "text").collect()]
    assert found(frame) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA + ", copies int, fault string, said int, id int, audit int")
    assert repair.repair_report(empty).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found(empty) == {}
    rows = made(3, 5, 6)
    wide = spark.createDataFrame([(*row, 7, "x", 1, 2, 3) for row in rows], empty.schema)
    assert found(wide) == expected(rows)


@pytest.mark.parametrize(
    ("roles", "audit", "cost"),
    [("", "", 0), ("ua", "KK", 0), ("sua", "KKK", 0), ("uu", "KR", 1), ("u", "D", 2), ("au", "RR", 2), ("aua", "DKK", 2), ("sss", "KRR", 2)],
)
def test_small_alignments(roles, audit, cost):
    turns = [repair.Turn(repair.ROLES[r], False) for r in roles]
    ways = [way for leave in ("", "a") if (way := repair.cheapest(turns, "", leave))]
    assert min(ways) == (cost, audit)


def test_very_long_blank_text(spark):
    rows = [(1, 0, "user", " " * 2_000_000 + "x" + " " * 2_000_000), (1, 1, "assistant", " " * 2_000_000)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)
