"""Quality rules: repetition and symbol counts, and the divergence of a text from its language.

The verdict compares two histograms of a document with those of its language over the whole corpus by Jensen-Shannon
divergence (base 2, 0 to 1): classes of characters, and common words. A document with too few words or characters for a
stable histogram is not judged by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quaystar.llm.common import free_name, stored, with_text_columns, words_of

# Common words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with his they at be this from have or by an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er wie".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au plus il elle ne ce avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o este".split(),
}
OTHER = ""
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "beyond_ascii")
BINS = 26  # 25 common words and one for all other words
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    class_min_chars: int = 200
    max_class_divergence: float = 0.08
    word_min_words: int = 80
    max_word_divergence: float = 0.102


def _class_of_byte() -> np.ndarray:
    """Class of a UTF-8 byte; bytes that go on with a character count nowhere (-1)."""
    of = np.full(256, CLASSES.index("symbol"))
    of[[ord(c) for c in ".,;:!?'\"()-"]] = CLASSES.index("mark")
    of[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    of[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    of[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    of[[0x20, *range(9, 14)]] = CLASSES.index("space")
    of[0x80:0xC0] = -1
    of[0xC0:] = CLASSES.index("beyond_ascii")
    return of


CLASS_OF_BYTE = _class_of_byte()
SYMBOLS = np.array([ord(c) for c in "#*$%&|<>"])
SPACES = np.array([0x20, *range(9, 14)])


def _forms(words: list[str]) -> dict[bytes, int]:
    """A word as it stands in a sentence, at its start, and before a comma or full stop."""
    return {f"{form}{end}".encode(): k for k, word in enumerate(words) for form in (word, word.title()) for end in ("", ",", ".")}


FORMS = {lang: _forms(words) for lang, words in COMMON_WORDS.items()}


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows found twice or more, the first included."""
    n = len(ids) - 2
    if n < 2:
        return 0
    if distinct < 1 << 20:
        windows = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:  # three ids no longer fit a long
        pairs = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)[1]
        windows = pairs * distinct + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, windows)
    again = twice[np.minimum(at, len(twice) - 1)] == windows
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + n] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[list[int], list[int], dict[bytes, int], np.ndarray]:
    """Base figures, character classes, the distinct words with their ids, and the id of each word."""
    words = words_of(text)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, len(words))
    of_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    classes = np.bincount(CLASS_OF_BYTE + 1, of_byte, len(CLASSES) + 1)[1:].astype(np.int64)
    lines = [line for line in text.split(b"\n") if line.strip()]
    base = [
        len(words),
        int(of_byte[:0x80].sum() + of_byte[0xC0:].sum() - of_byte[SPACES].sum()),
        int(of_byte[SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeat_words(ids, max(len(seen), 1)),
    ]
    return base, classes.tolist(), seen, ids


def common_words(lang: str, seen: dict[bytes, int], ids: np.ndarray) -> list[int]:
    bins = [0] * BINS
    if lang in FORMS and len(ids):
        counts = np.bincount(ids)
        for form, k in FORMS[lang].items():
            if form in seen:
                bins[k] += int(counts[seen[form]])
    bins[-1] = len(ids) - sum(bins)
    return bins


def language(lang: str) -> Column:
    """The languages with a word list; all other values of the column, null too, are one language."""
    return F.when(F.col(lang).isin(*COMMON_WORDS), F.col(lang)).otherwise(OTHER)


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, dict[str, str]]:
    """`docs` plus the base figures and both histograms; returns the names they got as well."""
    names: dict[str, str] = {}
    rows = docs
    for wanted in ("language", *BASE, "classes", "common"):
        names[wanted] = free_name(rows, wanted)
        rows = rows.withColumn(names[wanted], F.lit(None))
    added = StructType(
        [StructField(names[c], LongType()) for c in BASE]
        + [StructField(names[c], ArrayType(LongType())) for c in ("classes", "common")]
    )
    rows = docs.withColumn(names["language"], language(lang))
    # The language goes ahead of the text, in one column, so that a batch has both.
    both = free_name(rows, "lang_text")
    rows = rows.withColumn(both, F.concat(F.rpad(F.col(names["language"]), 2, " "), F.coalesce(F.col(text), F.lit(""))))

    def run(texts: list[bytes]) -> list[list]:
        columns: list[list] = [[] for _ in added]
        for value in texts:
            base, classes, seen, ids = measure(value[2:])
            row = [*base, classes, common_words(value[:2].decode().strip(), seen, ids)]
            for column, cell in zip(columns, row, strict=True):
                column.append(cell)
        return columns

    return with_text_columns(rows, both, added, run).drop(both), names


def references(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Both histograms of each language, over all its documents: five rows at most, whatever the corpus holds."""
    sums = [F.sum(F.col(names["classes"])[k]).alias(f"c{k}") for k in range(len(CLASSES))]
    sums += [F.sum(F.col(names["common"])[k]).alias(f"w{k}") for k in range(BINS)]
    return rows.groupBy(F.col(names["language"]).alias("reference_language")).agg(*sums).select(
        "reference_language",
        F.array(*[f"c{k}" for k in range(len(CLASSES))]).alias("reference_classes"),
        F.array(*[f"w{k}" for k in range(BINS)]).alias("reference_common"),
    )


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon divergence in bits of two histograms; 0 if one is empty."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda sum_, value: sum_ + value)

    def share(p: Column, half: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / half)).otherwise(0.0)

    def part(count: Column, other: Column) -> Column:
        p, q = count / total(counts), other / total(reference)
        return share(p, (p + q) / 2) + share(q, (p + q) / 2)

    both = (total(counts) > 0) & (total(reference) > 0)
    return F.when(both, total(F.zip_with(counts, reference, part)) / 2).otherwise(0.0)


def judged(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> tuple[DataFrame, str]:
    """`docs` plus one struct column with the base figures, base_failed, both divergences and kept.

    Returns the rows and that column's name. A null text has no word: base_failed. A null or unknown language is judged
    by its character classes against all documents of such languages. Repeated rows are judged alike; an empty table
    gives an empty result. The corpus is read twice (references, then verdicts) instead of being stored in between; only
    the references are, which have five rows at most and are broadcast for that reason.
    """
    rows, names = measured(docs, text, lang)
    slim, slim_names = measured(docs.select(text, lang), text, lang)
    reference = stored(references(slim, slim_names), "quality_references")
    renamed = {c: free_name(rows, c) for c in reference.columns}
    for old, new in renamed.items():
        reference = reference.withColumnRenamed(old, new)
    verdict = free_name(docs, "quality")
    n, repeated, chars = F.col(names["n_words"]), F.col(names["n_repeat_words"]), F.col(names["word_chars"])
    failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)
    by_class = divergence(F.col(names["classes"]), F.col(renamed["reference_classes"]))
    by_word = divergence(F.col(names["common"]), F.col(renamed["reference_common"]))
    joined = rows.join(F.broadcast(reference), F.col(names["language"]) == F.col(renamed["reference_language"]))
    figures = joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            *[F.col(names[c]).alias(c) for c in BASE],
            failed.alias("base_failed"),
            F.when(chars >= rules.class_min_chars, by_class).otherwise(0.0).alias("class_divergence"),
            F.when((n >= rules.word_min_words) & (F.col(names["language"]) != OTHER), by_word)
            .otherwise(0.0)
            .alias("word_divergence"),
        ).alias(verdict),
    )
    value = F.col(verdict)
    kept = (
        ~value["base_failed"]
        & (value["class_divergence"] <= rules.max_class_divergence)
        & (value["word_divergence"] <= rules.max_word_divergence)
    )
    return figures.withColumn(verdict, value.withField("kept", kept)), verdict


def keep_good(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their columns."""
    rows, verdict = judged(docs, rules, text, lang)
    return rows.where(F.col(verdict)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
