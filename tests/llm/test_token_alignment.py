"""Token alignment against a plain walk over the bytes of each text, and the minimal perfect hash against its keys."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from quaystar.llm import token_alignment as align
from quaystar.llm.common import table
from quaystar.llm.queries import BPE_FILE, PIECE_FILE


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    bpe = Tokenizer.from_file(BPE_FILE)
    bpe.encode_special_tokens = True
    return bpe, sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)


def expected(rows, libraries):
    bpe, pieces = libraries
    letters = align.byte_letters()
    docs, counts = [], Counter()
    for doc, text in rows:
        tokens = ([], [])
        if text:
            a = bpe.encode(f" {text}", add_special_tokens=False).ids
            b = pieces.encode(text)
            bytes_a = [bytes(letters[c] for c in bpe.id_to_token(k)) for k in a]
            bytes_b = [bytes([int(pieces.id_to_piece(k)[3:5], 16)]) if pieces.is_byte(k) else pieces.id_to_piece(k).replace("▁", " ").encode() for k in b]
            if b"".join(bytes_a) == f" {text}".encode() == b"".join(bytes_b):
                spans = []
                for ids, parts in ((a, bytes_a), (b, bytes_b)):
                    at, out = 0, []
                    for k, part in zip(ids, parts):
                        out.append((k, at, at + len(part)))
                        at += len(part)
                    spans.append(out)
                tokens = tuple(spans)
        links, i, j = [], 0, 0
        a, b = tokens
        groups, now = [], ([], [])
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            if a[i][2] == b[j][2]:
                now[0].append(a[i][0]), now[1].append(b[j][0])
                groups.append("|".join(",".join(map(str, side)) for side in now))
                now, i, j = ([], []), i + 1, j + 1
            elif a[i][2] < b[j][2]:
                now[0].append(a[i][0])
                i += 1
            else:
                now[1].append(b[j][0])
                j += 1
        counts.update(links)
        docs.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, groups, links in docs
    ]


def check(frame, rows, libraries, model=align.Pairs()):
    found = align.alignment_report(frame, BPE_FILE, PIECE_FILE, model)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected(rows, libraries), key=str)


HARD = [
    (1, "<|endoftext|> <s> </s> <unk> <0x41> ▁ x"), (2, "café naïve \U0001f600\U0001f468‍\U0001f469 你好"), (3, "a b　c ﬁ ①"),
    (4, "  two  spaces \n\n\t tab"), (5, "it's we'll I'D 12345 1,000.5 ###***"), (6, "\x00\x01\x7f"), (7, " "), (8, "x"),
]


def test_hard_texts_in_small_blocks_and_parts(spark, libraries):
    frame = spark.createDataFrame(HARD, "doc_id long, text string").repartition(3)
    check(frame, HARD, libraries, align.Pairs(block_tokens=20, buckets=8, part=30, segment=7))


def test_edge_rows(spark, edge_docs, edge_rows, libraries):
    check(edge_docs, [row[:2] for row in edge_rows], libraries)


def test_empty_table_and_no_tokens(spark, no_docs, libraries):
    assert align.alignment_report(no_docs, BPE_FILE, PIECE_FILE).collect() == []
    check(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), [(1, None), (2, "")], libraries)


def test_whole_table(spark, libraries):
    frame = table(spark, "/root/testdata/sf0.001", "documents")
    check(frame, [tuple(row) for row in frame.select("doc_id", "text").collect()], libraries)


@pytest.mark.parametrize("n", [1, 2, 1000, 30_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**31, n))
    bucket = align.bucket_of(keys, 16)
    rows = []
    for one in np.unique(bucket):
        sizes, flags, order = align.hashed(keys[bucket == one])
        rows.append((int(one), sizes, np.packbits(flags).tobytes(), align._pack(order, "i8")))
    index = align.PairIndex(rows, 16)
    numbers = index.numbers(keys)
    assert sorted(numbers) == list(range(len(keys)))
    assert (index.keys[numbers] == keys).all()
    assert (index.numbers(keys + 2**40) == -1).all()
