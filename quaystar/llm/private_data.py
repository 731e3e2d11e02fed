"""Personal data and the words that give it away, with DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers. The corpus then tells how strongly a word near such
an entity reveals it: with n documents, n_e of them with entity e, n_t with word t and n_te with both, the entity has
log2(n / n_e) bits and the word discloses log2(n_te * n / (n_t * n_e)) of them. A word that discloses more than a share
of the bits is generalised (to a mark) or, above a second share, removed, wherever it stands in the texts that hold e.
An entity is a value, the group of values it belongs to (such as the addresses of a domain), or all values of its kind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystar.llm.common import free_name, stored

KINDS = ("email", "ip", "card", "phone", "term")
# The contract's patterns. A match starts where a run of its first characters starts, or where the match before it
# ended; saying so, and keeping what repeats have taken, makes long runs take linear time and no stack. A run of fewer than
# 14 digits is no card, wherever one starts to read it, so it is no match to begin with.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=(?:[\x20-]?[0-9]){13})(?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"(?<!\p{L})\p{L}++"
# A character no text holds stands for each one of an entity; a word that touches it is part of the entity.
HIDDEN = "\U0010ffff"
FREE_TERM = r"(?<![\p{L}\x{10FFFF}])\p{L}++(?!\x{10FFFF})"
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
CHUNK = 128  # items of an array that are gone through in one piece; any number gives the same results


@dataclass(frozen=True)
class Disclosure:
    context: int = 64  # characters on either side of an entity; a word with a part in them counts as near
    texts: int = 3  # different texts that must show a word near an entity
    generalise: float = 0.8  # share of the entity's bits from which a word is generalised
    remove: float = 0.95  # and from which it is removed


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    """Places 0, CHUNK, 2 * CHUNK, … of an array; none if it is empty."""
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))


def _before(items: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each of the whole numbers: all numbers before it added up from 0 (`add` may be any associative operation).

    Adding to an array copies it, so a long one is gone through in chunks: in each on its own, and over their totals.
    """

    def grown(done: Column, item: Column) -> Column:
        return F.concat(done, F.array(add(F.element_at(done, -1), item)))

    def put_together(items: Column) -> Column:
        def chunk(at: Column) -> Column:
            return F.slice(items, at + 1, CHUNK)

        zero = F.array(F.lit(0))
        totals = F.transform(_chunks(items), lambda at: F.aggregate(chunk(at), F.lit(0), add))
        return _let(
            F.aggregate(totals, zero, grown),
            lambda starts: F.flatten(
                F.transform(
                    _chunks(items),
                    lambda at, k: F.slice(F.aggregate(chunk(at), F.array(F.get(starts, k)), grown), F.lit(1), F.size(chunk(at))),
                )
            ),
        )

    return _let(items, put_together)


def matches(text: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive) and value of the leftmost matches that do not overlap, in order."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(between, 1, F.size(found)),
        found,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("value")),
    )

    def placed(pairs: Column) -> Column:
        ends = _before(F.transform(pairs, lambda p: p["gap"] + p["size"]), lambda n, more: n + more)

        def place(p: Column, end: Column) -> Column:
            start = end + p["gap"]
            return F.struct(start.alias("start"), (start + p["size"]).alias("end"), p["value"].alias("value"))

        return F.zip_with(pairs, ends, place)

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), _let(pairs, placed)).otherwise(empty)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        digit = F.substr(digits, n - k + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(k % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _stands(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _spans_of(kind: str, number: int, found: Column) -> Column:
    good = F.filter(found, lambda m: _stands(kind, m["value"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))


def with_base_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` plus its base spans (start, kind, end; by start, then kind). Returns the column's name as well."""
    names, rows = [], docs
    value = F.coalesce(F.col(text), F.lit(""))
    for k, kind in enumerate(KINDS[:4]):
        name = free_name(rows, kind)
        names.append(name)
        some = {"email": F.contains(value, F.lit("@")), "phone": F.contains(value, F.lit("+"))}.get(kind, F.lit(True))
        found = F.when(some, matches(value, PATTERNS[kind])).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
        rows = rows.withColumn(name, _spans_of(kind, k, found))
    spans = free_name(rows, "spans")
    return rows.withColumn(spans, F.array_sort(F.concat(*names))).drop(*names), spans


def _merged(spans: Column) -> Column:
    """Spans that overlap as one span, with the kind and level of the first one. `spans` are in order of their starts."""

    def merge(spans: Column) -> Column:
        def numbered(before: Column) -> Column:
            # A span begins where no span before it reaches; what it reaches itself is known where the next one begins.
            marked = F.transform(spans, lambda s, k: F.struct(s.alias("s"), F.get(before, k).alias("before")))
            heads = F.filter(marked, lambda m: m["s"]["start"] >= m["before"])
            end = F.array_max(F.transform(spans, lambda s: s["end"]))
            return _let(
                heads,
                lambda heads: F.transform(
                    heads, lambda h, k: h["s"].withField("end", F.coalesce(F.get(heads, k + 1)["before"], end))
                ),
            )

        return _let(_before(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), numbered)

    return _let(spans, merge)


def _rewritten(text: Column, merged: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with mark(span) in place of each span. To find a place is to count from the start, so each chunk of spans
    looks into its own stretch of the text."""

    def rewrite(merged: Column) -> Column:
        def pieces(at: Column) -> Column:
            def of_chunk(chunk: Column) -> Column:
                first = F.coalesce(F.get(merged, at - 1)["end"], F.lit(0))
                stretch = F.substr(text, first + 1, F.element_at(chunk, -1)["end"] - first)

                def piece(stretch: Column, s: Column, k: Column) -> Column:
                    done = F.coalesce(F.get(chunk, k - 1)["end"], first)
                    return F.concat(F.substr(stretch, done - first + 1, s["start"] - done), mark(s))

                return _let(stretch, lambda part: F.array_join(F.transform(chunk, lambda s, k: piece(part, s, k)), ""))

            return _let(F.slice(merged, at + 1, CHUNK), of_chunk)

        tail = F.substr(text, F.coalesce(F.try_element_at(merged, F.lit(-1))["end"], F.lit(0)) + 1)
        return F.concat(F.array_join(F.transform(_chunks(merged), pieces), ""), tail)

    return _let(merged, rewrite)


def _hidden(text: Column, spans: Column) -> Column:
    """The text, as long as before, with its entities hidden."""
    return _rewritten(text, _merged(spans), lambda s: F.repeat(F.lit(HIDDEN), s["end"] - s["start"]))


def _values(text: Column, spans: Column, value: Callable[[Column, Column], Column]) -> Column:
    """value(span, its text) of each span, in order; `spans` are in order of their starts."""

    def of_all(spans: Column) -> Column:
        def of_chunk(chunk: Column) -> Column:
            first, last = F.get(chunk, F.lit(0))["start"], F.array_max(F.transform(chunk, lambda s: s["end"]))
            stretch = F.substr(text, first + 1, last - first)
            return _let(
                stretch,
                lambda part: F.transform(
                    chunk, lambda s: value(s, F.substr(part, s["start"] - first + 1, s["end"] - s["start"]))
                ),
            )

        return F.flatten(F.transform(_chunks(spans), lambda at: _let(F.slice(spans, at + 1, CHUNK), of_chunk)))

    return _let(spans, of_all)


def _entities(kind: Column, value: Column) -> Column:
    """What a value stands for: itself, its group (domain, network, issuer of a card, first digits of a number), its kind.

    Most values are in one text only, where no word can be told from chance; groups and kinds have more of them.
    """
    low, digits = F.lower(value), F.regexp_replace(value, "[^0-9]", "")
    group = (
        F.when(kind == KINDS.index("email"), F.substring_index(low, "@", -1))
        .when(kind == KINDS.index("ip"), F.substring_index(low, ".", 2))
        .when(kind == KINDS.index("card"), F.substring(digits, 1, 6))
        .otherwise(F.substring(digits, 1, 4))
    )
    levels = (("value", low), ("group", group), ("kind", F.lit("")))
    return F.array(*[F.md5(F.concat_ws(":", kind.cast("string"), F.lit(level), name)) for level, name in levels])


def _words(texts: DataFrame) -> DataFrame:
    """text_key, term, start, end: the words of the texts that are no part of an entity."""
    hidden = texts.select("text_key", _hidden(F.col("whole"), F.col("spans")).alias("whole"))
    split = hidden.select(
        "text_key", F.regexp_extract_all("whole", F.lit(FREE_TERM), 0).alias("hits"), F.split("whole", FREE_TERM, -1).alias("gaps")
    )
    pairs = F.transform("hits", lambda hit, k: F.struct(hit.alias("hit"), F.length(F.get("gaps", k)).alias("gap")))
    each = split.select("text_key", F.posexplode(pairs).alias("k", "w")).select("text_key", "k", "w.hit", "w.gap")
    size = F.length("hit")
    end = F.sum(F.col("gap") + size).over(Window.partitionBy("text_key").orderBy("k"))
    return each.select("text_key", F.lower("hit").alias("term"), (end - size).cast("int").alias("start"), end.cast("int").alias("end"))


def disclosing(rows: DataFrame, spans: str, text: str, rule: Disclosure) -> DataFrame:
    """text_key, found: the spans of disclosing words of each different text; level 0 is generalised, 1 removed."""
    some = rows.where(F.size(spans) > 0).groupBy(F.md5(F.col(text)).alias("text_key"))
    some = some.agg(F.count("*").alias("copies"), F.first(F.col(text)).alias("whole"), F.first(F.col(spans)).alias("spans"))
    texts = stored(some, "entity_texts")

    def place(s: Column, value: Column) -> Column:
        return F.struct(s["start"].alias("from"), s["end"].alias("to"), _entities(s["kind"], value).alias("entities"))

    places = texts.select("text_key", "copies", F.explode(_values(F.col("whole"), F.col("spans"), place)).alias("p"))
    places = stored(places.select("text_key", "copies", "p.from", "p.to", F.explode("p.entities").alias("entity")), "entity_places")
    words = stored(_words(texts), "entity_text_words")
    holds = places.select("text_key", "copies", "entity").distinct()
    # An entity of fewer texts than a word must be near it in is not looked at.
    entities = holds.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts"))
    entities = stored(entities.where(F.col("texts") >= rule.texts).drop("texts"), "entities")
    # Words and entities meet by stretches of the text, so a text of many of both is no burden.
    context = max(rule.context, 1)

    def stretches(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / context), F.floor(last / context))).alias("stretch")

    around = places.join(entities, "entity", "left_semi").select(
        "text_key", "entity", "from", "to", stretches(F.greatest(F.col("from") - context, F.lit(0)), F.col("to") + context)
    )
    close = words.select("*", stretches(F.col("start"), F.col("end") - 1)).join(around, ["text_key", "stretch"])
    close = close.where((F.col("end") > F.col("from") - rule.context) & (F.col("start") < F.col("to") + rule.context))
    together = close.select("text_key", "entity", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("texts"))
    together = together.where(F.col("texts") >= rule.texts).drop("texts").join(entities, "entity")
    terms = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), 0))
    known = rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n = F.lit(float(rows.select(F.lit(1)).count()))
    bits = F.log2(n / F.col("n_e"))

    def told(n_te: Column) -> Column:
        return F.log2(n_te * n / (F.col("n_t") * F.col("n_e")))

    # Words that would not be strong enough if all documents that can have them with the entity had: those that have the
    # word and any entity.
    free = F.array_distinct(F.transform(F.regexp_extract_all(_hidden(F.col("whole"), F.col("spans")), F.lit(FREE_TERM), 0), F.lower))
    beside = texts.select("copies", F.explode(free).alias("term")).groupBy("term").agg(F.sum("copies").alias("most"))
    possible = (bits > 0) & (told(F.least("most", "n_e")) >= rule.generalise * bits)
    together = stored(together.join(beside, "term").join(known, "term").where(possible).drop("most"), "entity_words")
    found = stored(words.join(together, "term").join(holds, ["text_key", "entity"]), "entity_word_places")
    counts = found.select("entity", "term", "n_e", "n_t", "text_key", "copies").distinct()
    counts = counts.groupBy("entity", "term", "n_e", "n_t").agg(F.sum("copies").alias("n_te"))
    share = told(F.col("n_te"))
    strong = counts.where(share >= rule.generalise * bits).select(
        "entity", "term", F.when(share >= rule.remove * bits, 1).otherwise(0).alias("level")
    )
    spots = found.join(strong, ["entity", "term"]).groupBy("text_key", "start", "end").agg(F.max("level").alias("level"))
    return stored(
        spots.groupBy("text_key").agg(F.collect_list(F.struct("start", "end", "level")).alias("found")), "disclosing_words"
    )


def find(docs: DataFrame, rule: Disclosure = Disclosure(), text: str = "text") -> tuple[DataFrame, str]:
    """`docs` plus a struct: base, the base spans, and all, those and the spans of disclosing words, with their level.

    Returns that column's name as well. A null text is empty and has no span. Repeated rows get the same spans; every
    copy of a text counts in the corpus figures, but a word needs several different texts to be called disclosing. An
    empty table gives an empty result. Base spans may overlap each other; words inside them are not looked at.
    """
    rows, spans = with_base_spans(docs, text)
    words = disclosing(rows, spans, text, rule)
    result = free_name(docs, "private")
    # Only documents with an entity can have disclosing words, so only they are shuffled.
    key, found = free_name(rows, "text_key"), free_name(rows, "found")
    plain = rows.where(F.size(spans) == 0).withColumn(key, F.lit(None).cast("string"))
    hit = rows.where(F.size(spans) > 0).withColumn(key, F.md5(F.col(text)))
    hit = hit.join(words.select(F.col("text_key").alias(key), F.col("found").alias(found)), key, "left")
    both = hit.unionByName(plain.withColumn(found, F.lit(None).cast(words.schema["found"].dataType)))
    base = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(0).alias("level"))
    )
    term = F.transform(
        F.coalesce(found, F.array().cast(words.schema["found"].dataType)),
        lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end"), s["level"].alias("level")),
    )
    value = F.struct(base.alias("base"), F.array_sort(F.concat(base, term)).alias("all"))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], value.alias(result)), result


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])

    def one(s: Column) -> Column:
        return F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with a mark in place of each span, or nothing where a word is removed. Spans that overlap are one span
    of the first one's kind."""

    marks = F.array(*[F.lit(MARKS[kind]) for kind in KINDS])

    def mark(s: Column) -> Column:
        return F.when((s["kind"] == KINDS.index("term")) & (s["level"] == 1), "").otherwise(F.get(marks, s["kind"]))

    return F.when(F.size(spans) == 0, text).otherwise(_rewritten(text, _merged(spans), mark))


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), text: str = "text") -> DataFrame:
    """`docs` with sanitised texts; n_chars, where there is one, is counted anew. Null texts stay null."""
    rows, found = find(docs, rule, text)
    # In a column of its own first: next to an output column named like the text, the text would mean that one.
    clean = free_name(rows, "clean")
    rows = rows.withColumn(clean, sanitised(F.col(text), F.col(found)["all"]))
    columns = [
        F.col(clean).alias(c) if c == text else F.length(clean).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return rows.select(*columns)
