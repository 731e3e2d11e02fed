import random

import pytest

WORDS = [a + b for a in ("ba", "ke", "mi", "no", "ru", "sta") for b in ("l", "nd", "ra", "the", "x,", "z.")]


def prose(seed: int, words: int) -> str:
    """Text in lines, with common English words in it."""
    pick = random.Random(seed)
    out = [pick.choice(("the", "of", "and", "to", "in", "that")) if pick.random() < 0.4 else pick.choice(WORDS) + pick.choice(WORDS) for _ in range(words)]
    return " ".join(w + ("\n" if k % 17 == 16 else "") for k, w in enumerate(out))


@pytest.fixture(scope="session")
def edge_rows():
    """doc_id, text, lang, source, and columns whose names the operators would like to use."""
    a, b = prose(1, 120), prose(2, 90)
    texts = [
        (1, a, "en", "src0"),
        (2, a, "en", "src1"),  # a copy
        (3, a.replace("the", "The", 1), "en", None),
        (4, b, "xx", "src0"),
        (4, b, "xx", "src0"),  # a repeated row
        (5, None, None, None),
        (6, "", "en", "src1"),
        (7, " \t\n ", "de", "elsewhere"),
        (None, prose(3, 60), "fr", "src0"),
        (None, None, None, None),
        (8, "écrit à jean@mail.example.org ou +1 (788) 555-0874, 10.0.0.255 😀 4857014651521004 " + prose(4, 40), "fr", "src2"),
        (9, "### ***\n" * 80, "en", "src0"),
        (10, "x" * 30_000 + " " + "1 " * 5_000, "en", "src0"),  # very long word, very long run of digits
        (11, prose(5, 8_000), "en", "src0"),
        (12, "one two three " * 40, "es", "src0"),
    ]
    return [(*row, len(row[1] or ""), -k, f"q{k}", k, k, k, k, k, k) for k, row in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(
        edge_rows,
        "doc_id long, text string, lang string, source string, n_chars long, N_Words int, quality string,"
        " known int, found int, fingerprint int, Spans int, stream int, phase int",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
