import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quaystar.llm import private_data as private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def stands(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(part.lstrip("0")[:4] or 0) <= 255 for part in value.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def base(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if stands(kind, m[0])
    )


HARD = [
    "a@b.co_m@x.org,c@d a@b.c.d@e.f x@y..z @a.b a.@b.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.01 1.2.3 1..2.3.4",
    "4857014651521004 4857 0146 5152 1004 4857-0146-5152-1005 48570146515210041234",
    "+1 (788) 555-0874 ++49 30 1234567 +1 +12 345 +1.2.3.4.5.6.7.8.9.0 +1(2",
    "😀 é 10.0.0.1 😀 x@y.zz 4857014651521004",
    "a" * 60_000 + "@",
    "1" * 60_000 + ".1.1.1",
    "1 " * 30_000,
    "+1" + " " * 30_000,
]


def test_base_spans(spark):
    rows = spark.createDataFrame([(k, text) for k, text in enumerate(HARD)], "k int, text string")
    found, name = private.with_base_spans(rows)
    got = {row.k: [tuple(s) for s in row[name]] for row in found.collect()}
    for k, text in enumerate(HARD):
        assert got[k] == base(text), text[:60]


def test_texts_of_very_many_numbers_and_addresses(spark):
    """Time grows with the text, not with its square."""
    numbers = "".join(f"abcd {k} " for k in range(100, 200_100))
    cards = "".join(f"é 4857 0146 5152 {k:04} x" for k in range(9_000))
    addresses = "".join(f"word {k}@x{k % 7}.org, " for k in range(20_000))
    texts = {"numbers": numbers, "cards": cards, "addresses": addresses}
    for name, text in texts.items():
        rows = spark.createDataFrame([(text,)], "text string")
        start = time.perf_counter()
        found, spans = private.with_base_spans(rows)
        clean = private.sanitised(F.col("text"), F.transform(spans, lambda s: s.withField("level", F.lit(0))))
        got = found.select(spans, clean.alias("clean"), private._hidden(F.col("text"), F.col(spans)).alias("hidden")).first()
        assert time.perf_counter() - start < 20, name
        expected = base(text)
        assert [tuple(s) for s in got[0]] == expected, name
        assert got.clean == replaced(text, expected, lambda kind, size: private.MARKS[private.KINDS[kind]])
        assert got.hidden == replaced(text, expected, lambda kind, size: private.HIDDEN * size)


def replaced(text, spans, mark):
    """Spans by start; those that overlap are one of the first one's kind."""
    groups = []
    for start, kind, end in spans:
        if groups and start < groups[-1][2]:
            groups[-1][2] = max(groups[-1][2], end)
        else:
            groups.append([start, kind, end])
    done, at = [], 0
    for start, kind, end in groups:
        done += [text[at:start], mark(kind, end - start)]
        at = end
    return "".join(done) + text[at:]


def test_overlapping_spans_over_chunks(spark):
    """Random spans, more than a chunk of them, against spans merged one by one; and the text of each."""
    chosen = random.Random(5)
    rows = []
    for size in (0, 1, 127, 128, 129, 700):
        text = "".join(chosen.choice("aé😀b ") for _ in range(3000))
        starts = sorted(chosen.randrange(2900) for _ in range(size))
        rows.append((size, text, sorted((s, chosen.randrange(4), s + chosen.randrange(1, 9 if size < 700 else 3)) for s in starts)))
    frame = spark.createDataFrame(rows, "n int, t string, s array<struct<start:int,kind:int,end:int>>")
    text, spans = F.col("t"), F.transform("s", lambda s: s.withField("level", F.lit(0)))
    values = private._values(text, F.col("s"), lambda s, value: F.concat(s["kind"].cast("string"), value))
    found = frame.select("n", private.sanitised(text, spans).alias("clean"), private._hidden(text, F.col("s")).alias("hidden"), values.alias("v"))
    got = {row.n: row for row in found.collect()}
    for size, text, spans in rows:
        assert got[size].clean == replaced(text, spans, lambda kind, size: private.MARKS[private.KINDS[kind]])
        assert got[size].hidden == replaced(text, spans, lambda kind, size: private.HIDDEN * size)
        assert got[size].v == [f"{kind}{text[start:end]}" for start, kind, end in spans]


def test_whole_operator(edge_docs, edge_rows, no_docs):
    found, name = private.find(edge_docs)
    rows = {row["quality"]: row[name] for row in found.collect()}
    for row in edge_rows:
        assert [tuple(s)[:3] for s in rows[row[6]]["base"]] == base(row[1])
        assert [tuple(s)[:3] for s in rows[row[6]]["all"]] == base(row[1])  # one text with entities discloses nothing
    clean = private.sanitise(edge_docs)
    assert clean.columns == edge_docs.columns
    texts = {row["quality"]: row for row in clean.collect()}
    assert texts["q10"].text.startswith("écrit à [EMAIL] ou [PHONE], [IP] 😀 [CARD] ")
    assert texts["q10"].n_chars == len(texts["q10"].text)
    assert texts["q5"].text is None and texts["q0"].text == edge_rows[0][1]
    assert private.find(no_docs)[0].count() == 0 == private.sanitise(no_docs).count()


def test_disclosing_words(spark):
    """'quillon' stands near one address in four texts and nowhere else; 'common' is everywhere; 'half' is also elsewhere."""
    near = [(k, f"{k} quillon common halfway jq@mail.example.org note{'abcd'[k]}word") for k in range(4)]
    rows = near + [(k, f"common text{'xyzuvw'[k % 6]} number without anyone") for k in range(4, 60)]
    rows += [(k, "halfway there common") for k in range(60, 100)]
    rows += [(100, near[0][1])]  # a copy is no further text
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found, name = private.find(docs)
    for row in found.collect():
        words = {row.text[s["start"] : s["end"]] for s in row[name]["all"] if s["kind"] == 4}
        assert words == ({"quillon"} if "jq@" in row.text else set())
    spans = found.where("doc_id = 0").select(private.as_text(F.col(name)["all"]).alias("spans")).first().spans
    assert spans == "term:2:9,email:25:44"
    clean = {row.doc_id: row.text for row in private.sanitise(docs).collect()}
    assert clean[0] == "0  common halfway [EMAIL] noteaword"


def test_disclosing_words_go_wherever_they_stand_in_a_text_of_their_entity(spark):
    """Far from the address, one with the address at the other end only, a word of two letters, and one that the edge
    of the context cuts."""
    gap, edge = "common " * 40, "jq@mail.example.org" + " " * 60 + "zyrandorel"
    rows = [(k, f"{k} quillon bo {edge} {gap} bo quillon signed{'abcd'[k]}") for k in range(4)]
    rows += [(4, f"quillon {gap} jq@mail.example.org")]
    rows += [(k, f"common text{'xyzuvw'[k % 6]} signed") for k in range(5, 80)]
    clean = {row.doc_id: row.text for row in private.sanitise(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert clean[0] == f"0   [EMAIL]{' ' * 60} {gap}   signeda"
    assert clean[4] == f" {gap} [EMAIL]"
    assert all(clean[k] == text for k, text in rows[5:])


def test_words_that_disclose_a_group_of_entities(spark):
    """Every address and number is in one text, so only their domain, and the kind, have texts enough."""
    rows = [(k, f"{k} quillon common {'abcd'[k]}q@mail.example.org") for k in range(4)]
    rows += [(4 + k, f"{k} common velmora +1 (788) 555-087{k}") for k in range(4)]
    rows += [(k, f"common q@other{k}.example.org common") for k in range(8, 40)]
    rows += [(k, f"common text{'xyzuvw'[k % 6]}") for k in range(40, 100)]
    clean = {row.doc_id: row.text for row in private.sanitise(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [clean[k] for k in (0, 4, 8)] == ["0  common [EMAIL]", "0 common  [PHONE]", "common [EMAIL] common"]


def test_generalised_or_removed_and_overlaps(spark):
    spans = [(0, 0, 3, 0), (2, 1, 5, 0), (6, 4, 7, 0), (8, 4, 9, 1)]
    row = spark.createDataFrame([("abcdef😀hij", spans)], "t string, s array<struct<start:int,kind:int,end:int,level:int>>")
    assert row.select(private.sanitised(F.col("t"), F.col("s"))).first()[0] == "[EMAIL]f[TERM]hj"


@pytest.mark.parametrize("name", ["op7_private_data", "op1_mixing"])
def test_no_python_on_the_main_path(spark, name):
    from quaystar.llm.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "ExistingRDD"))
