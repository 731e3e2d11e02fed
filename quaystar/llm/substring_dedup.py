"""Repeated passages by relative Lempel-Ziv parsing of documents against all text that comes before.

The reference is the whole corpus in document order, indexed in blocks by hashes of its 20-word windows. A document is
parsed greedily into factors: runs of windows whose first occurrences follow one another in one earlier document (or
earlier in the same one). Every factor has at least 20 words and is a duplicate span; where a factor ends, the next
window is looked up by itself, so windows across factor boundaries are found as well.

Looking up every window would move more than the text itself. So documents are sieved first: the smallest hash of the
8-word sequences in a window is its anchor, equal windows have equal anchors, and only windows whose anchor occurs in
two different texts, or twice in one, can be repeated. Anchors, then windows, are sent to their block as packed arrays,
and each batch of documents sends each hash once at most: what repeats inside the batch is settled there. So a passage
that very many documents share is no burden for its block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from numpy.lib.stride_tricks import sliding_window_view

from quaystar.llm.common import Batches, stored, utf8, words_of

WINDOW = 20
ANCHOR = 8
BLOCK_CHARS = 8 << 20
BATCH_ROWS = 2500
NO_ID = (1 << 63) - 1  # documents without an id come last
DOCS = "doc_order long, doc_id {id}, text_key binary, text_hash long, n_words long, whole_sha binary"
ANCHORS = "block int, known boolean, hashes binary, owners binary"
SUSPECTS = "block int, doc_order long, text_hash long, text binary, entries binary, docs binary, found binary"
# 96 bits of a window's hash; a document is told by its order and the hash of its text.
ENTRY = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<u4"), ("start", "<u4")])
OWNER = np.dtype([("order", "<i8"), ("text_hash", "<i8")])
FOUND = np.dtype([("start", "<u4"), ("reference_start", "<u4"), ("reference", "<i8")])
FOUND_OF = "owner_block int, owners binary, found binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sequences(ids: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of each run of `length` words: a polynomial in `base`, put together from runs of powers of two."""
    done, out, power = 0, None, ids
    step, factor = 1, np.array([base], np.uint64)
    while length:
        if length & 1:
            if out is None:
                out = power
            else:  # what is there already comes first
                size = len(ids) - done - step + 1
                out = out[:size] * factor + power[done : done + size]
            done += step
        length >>= 1
        if length:
            power = power[: len(power) - step] * factor + power[step:]
            step, factor = step * 2, factor * factor
    return _mix(out)


def _small(batches: Batches) -> Batches:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def word_ids(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(word) for word in words), np.uint64, len(words))


def anchors(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hash of each window, and the place of that anchor."""
    runs = sliding_window_view(_sequences(ids, ANCHOR, 0x9E3779B97F4A7C15), WINDOW - ANCHOR + 1)
    place = runs.argmin(1)
    return runs[np.arange(len(runs)), place], np.arange(len(runs)) + place


def _document_rows(batches: Batches) -> Batches:
    for batch in batches:
        texts = utf8(batch.column(1))
        words = [words_of(t) for t in texts]
        columns = [
            batch.column(0).cast(pa.int64()).fill_null(NO_ID),
            batch.column(0),
            pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
            pa.array(np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in texts), np.uint64, len(texts)).view(np.int64)),
            pa.array([len(w) for w in words], pa.int64()),
            pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in DOCS.split(", ")])


def _batch_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All anchors of the batch, each once, with one text (its hash) that has it; and the anchors that a text shares with
    itself or with another one of the batch, with each such text."""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    again, again_of = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for text in texts:
        words = words_of(text)
        if len(words) >= WINDOW:
            key = np.array([xxhash.xxh64_intdigest(text, 42)], np.uint64).view(np.int64)
            value, place = anchors(word_ids(words))
            first = np.concatenate(([True], place[1:] != place[:-1]))
            value, times = np.unique(value[first], return_counts=True)
            hashes.append(value)
            owners.append(np.repeat(key, len(value)))
            again.append(value[times > 1])
            again_of.append(np.repeat(key, len(again[-1])))
    value, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(value))[: len(starts)]
    shared = np.repeat(owner[starts] != owner[ends - 1], ends - starts) if len(starts) else np.empty(0, bool)
    again.append(value[shared])
    again_of.append(owner[shared])
    return value[starts], owner[starts], np.concatenate(again), np.concatenate(again_of)


def _anchor_rows(blocks: int):
    """Anchors for the block of their hash, and those known to be repeated for the block of their text."""

    def run(batches: Batches) -> Batches:
        for batch in _small(batches):
            value, owner, again, again_of = _batch_anchors(utf8(batch.column(0)))
            for known, hashes, owners, by in ((False, value, owner, value), (True, again, again_of, again_of)):
                block, *parts = _packed(blocks, by, hashes, owners)
                columns = [block, pa.array([known] * len(block), pa.bool_()), *parts]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "known", "hashes", "owners"])

    return run


def _packed(blocks: int, by: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Block numbers, and for each column the bytes of its entries in that block; `by`: the hash that gives the block."""
    block = (by.view(np.uint64) >> np.uint64(32)) % np.uint64(blocks)
    order = np.lexsort((by, block))  # entries of one owner stand together, which compresses well
    found, first = np.unique(block[order], return_index=True)
    parts = [[x.tobytes() for x in np.split(column[order], first[1:])][: len(found)] for column in columns]
    return [pa.array(found.astype(np.int32)), *[pa.array(part, pa.binary()) for part in parts]]


def _entry_bytes(entries: np.ndarray) -> bytes:
    """Entries by document and start, field by field: documents and steps between starts compress to next to nothing when
    their bytes stand together, place by place."""
    entries = entries[np.lexsort((entries["start"], entries["doc"]))]
    steps = np.diff(entries["start"], prepend=np.uint32(0))  # wraps round where a document begins
    places = [np.ascontiguousarray(field).view(np.uint8).reshape(-1, 4).T.tobytes() for field in (entries["doc"], steps)]
    return b"".join([entries["high"].tobytes(), entries["low"].tobytes(), *places])


def _entries_of(data: bytes) -> np.ndarray:
    size = len(data) // ENTRY.itemsize
    entries = np.empty(size, ENTRY)
    entries["high"] = np.frombuffer(data, "<u8", size)
    entries["low"] = np.frombuffer(data, "<u4", size, 8 * size)
    doc, steps = (
        np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * size, at * size).reshape(4, -1).T).view("<u4").ravel() for at in (12, 16)
    )
    entries["doc"], entries["start"] = doc, np.cumsum(steps, dtype=np.uint32)
    return entries


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _repeated_anchors(blocks: int):
    """owner_block, owners, hashes: the anchors of a block that different texts have, and those that were known before,
    packed for the blocks of their texts."""

    def run(table: pa.Table) -> pa.Table:
        parts = [table.filter(table.column("known")), table.filter(pc.invert(table.column("known")))]
        (known, known_of), (value, owner) = [
            (_joined(part.column("hashes"), np.uint64), _joined(part.column("owners"), np.int64)) for part in parts
        ]
        if len(value):
            order = np.lexsort((owner, value))
            value, owner = value[order], owner[order]
            starts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            ends = np.append(starts[1:], len(value))
            shared = np.repeat(owner[starts] != owner[ends - 1], ends - starts)
            value, owner = value[shared], owner[shared]
        value, owner = np.concatenate((value, known)), np.concatenate((owner, known_of))
        return pa.table(_packed(blocks, owner, owner, value), names=["owner_block", "owners", "hashes"])

    return run


def _anchors_by_text(table: pa.Table) -> pa.Table:
    """text_hash, hashes: one row for each text of a block."""
    owner, value = _joined(table.column("owners"), np.int64), _joined(table.column("hashes"), np.uint64)
    order = np.argsort(owner, kind="stable")
    keys, first = np.unique(owner[order], return_index=True)
    blobs = [part.tobytes() for part in np.split(value[order], first[1:])][: len(keys)]
    return pa.table([pa.array(keys), pa.array(blobs, pa.binary())], names=["text_hash", "hashes"])


def _earlier(entries: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in the order of their hash, then document and start; which begin a hash; and the first of each one's hash."""
    order_of = docs["order"][entries["doc"]]
    order = np.lexsort((entries["start"], order_of, entries["low"], entries["high"]))
    entries = entries[order]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["high"][1:] != entries["high"][:-1]) | (entries["low"][1:] != entries["low"][:-1])
    return entries, new, np.flatnonzero(new)[np.cumsum(new) - 1]


def _duplicates(entries: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first entry of each hash; and of the others the document, and what was found."""
    entries, new, first = _earlier(entries, docs)
    order_of = docs["order"][entries["doc"]]
    later = (order_of != order_of[first]) | (entries["start"] != entries["start"][first])
    rows, first = entries[later], first[later]
    found = np.empty(len(rows), FOUND)
    found["start"], found["reference"], found["reference_start"] = rows["start"], order_of[first], entries["start"][first]
    # Entries that repeat the first one's document and start are as early as it is: they go on with it.
    return entries[new | ~later], rows["doc"], found


def _by_owner(owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The distinct owners, and for each the bytes of what was found."""
    order = np.argsort(owner, kind="stable")
    which, first = np.unique(owner[order], return_index=True)
    return which, [part.tobytes() for part in np.split(found[order], first[1:])][: len(which)]


def _suspect_rows(blocks: int):
    """Rows of documents with what their batch shows (block null), and rows of windows for each block."""
    names = [part.split()[0] for part in SUSPECTS.split(", ")]

    def run(batches: Batches) -> Batches:
        for batch in _small(batches):
            orders, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
            docs = np.empty(len(texts), OWNER)
            docs["order"], docs["text_hash"] = orders, keys
            parts = [np.empty(0, ENTRY)]
            for k, (text, repeated) in enumerate(zip(texts, batch.column(3).to_pylist(), strict=True)):
                ids = word_ids(words_of(text))
                value, _ = anchors(ids)
                starts = np.flatnonzero(np.isin(value, np.frombuffer(repeated, np.uint64)))
                part = np.empty(len(starts), ENTRY)
                part["high"] = _sequences(ids, WINDOW, 0xD6E8FEB86659FD93)[starts]
                part["low"] = (_sequences(ids, WINDOW, 0xA0761D6478BD642F) >> np.uint64(32))[starts]
                part["doc"], part["start"] = k, starts
                parts.append(part)
            entries, doc, found = _duplicates(np.concatenate(parts), docs)
            none = [None] * len(texts)
            of = dict(zip(*_by_owner(doc, found), strict=True))
            blobs = [of.get(k) for k in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(none, pa.int32()), pa.array(orders, pa.int64()), pa.array(keys, pa.int64()), pa.array(texts, pa.binary()),
                    pa.array(none, pa.binary()), pa.array(none, pa.binary()), pa.array(blobs, pa.binary()),
                ], names=names,
            )
            block = (entries["high"] >> np.uint64(32)) % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            which, first = np.unique(block[order], return_index=True)
            rows, own = [], []
            for part in np.split(entries[order], first[1:]) if len(which) else []:
                used, part["doc"] = np.unique(part["doc"], return_inverse=True)
                rows.append(_entry_bytes(part))
                own.append(docs[used].tobytes())
            none = [None] * len(which)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(which.astype(np.int32)), pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()),
                    pa.array(rows, pa.binary()), pa.array(own, pa.binary()), pa.array(none, pa.binary()),
                ], names=names,
            )

    return run


def _repeated_windows(blocks: int):
    """owner_block, owners, found: the windows of a block that have occurred before, with their first occurrence, packed
    for the blocks of their documents."""

    def run(table: pa.Table) -> pa.Table:
        entries, docs, shift = [], [], 0
        for rows, own in zip(table.column("entries").to_pylist(), table.column("docs").to_pylist(), strict=True):
            part = _entries_of(rows)
            part["doc"] += shift
            entries.append(part)
            docs.append(np.frombuffer(own, OWNER))
            shift += len(docs[-1])
        owners = np.concatenate(docs)
        _, doc, found = _duplicates(np.concatenate(entries), owners)
        packed = _packed(blocks, owners["text_hash"][doc], owners[doc], found)
        return pa.table(packed, names=["owner_block", "owners", "found"])

    return run


def _windows_by_document(table: pa.Table) -> pa.Table:
    """doc_order, text_hash, found: one row for each document of a block."""
    owner, found = _joined(table.column("owners"), OWNER), _joined(table.column("found"), FOUND)
    distinct, number = np.unique(owner, return_inverse=True)
    which, blobs = _by_owner(number, found)
    of = distinct[which]
    columns = [pa.array(of["order"]), pa.array(of["text_hash"]), pa.array(blobs, pa.binary())]
    return pa.table(columns, names=["doc_order", "text_hash", "found"])


def factors(found: np.ndarray) -> list[tuple[int, int, int, int]]:
    """start, end (words, end exclusive), reference document and reference start of the factors of one document."""
    found = np.unique(found)
    found = found[np.concatenate(([True], found["start"][1:] != found["start"][:-1]))] if len(found) else found
    if not len(found):
        return []
    start, reference, place = found["start"].astype(np.int64), found["reference"], found["reference_start"].astype(np.int64)
    new = (np.diff(start) != 1) | (np.diff(reference) != 0) | (np.diff(place) != 1)
    first = np.concatenate(([0], np.flatnonzero(new) + 1))
    last = np.append(first[1:], len(found)) - 1
    return [(int(start[a]), int(start[b]) + WINDOW, int(reference[a]), int(place[a])) for a, b in zip(first, last)]


def _parse(batches: Batches) -> Batches:
    for batch in batches:
        removed, shas, spans = [], [], []
        for text, found in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            parts = factors(np.frombuffer(b"".join(found), FOUND))
            gone = np.zeros(len(words), bool)
            for start, end, _, _ in parts:
                gone[start:end] = True
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).digest())
            spans.append([dict(zip(("start", "end", "reference", "reference_start"), part)) for part in parts])
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "reference", "reference_start")]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([hashlib.md5(text).digest() for text in utf8(batch.column(0))], pa.binary()),
                pa.array(removed, pa.int64()), pa.array(shas, pa.binary()),
                pa.array(spans, kind),
            ],
            names=["text_key", "n_removed", "kept_sha", "spans"],
        )


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans of each document.

    A word is removed if a 20-word window that covers it also starts earlier in the corpus: in a document with a smaller
    id, or before in the same one. `spans` holds the factors of the parse (word positions, end exclusive, with the
    document and place they copy); it is null for a later copy of a whole text, all of which goes, and where nothing
    goes. Null texts have no words. Documents without an id come last and count as one document, and so do rows that
    repeat an id: what stands at the same place of two of them is not removed. An empty table gives an empty result.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    rows = stored(slim.mapInArrow(_document_rows, DOCS.format(id=id_type)), "passage_documents")

    # Sieve: texts with anchors that others have as well.
    sent = slim.select("text").mapInArrow(_anchor_rows(blocks), ANCHORS).repartition(blocks, "block")
    marked = sent.groupBy("block").applyInArrow(_repeated_anchors(blocks), "owner_block int, owners binary, hashes binary")
    marked = marked.repartition(blocks, "owner_block").groupBy("owner_block")
    marked = marked.applyInArrow(_anchors_by_text, "text_hash long, hashes binary")
    least = stored(
        rows.groupBy("text_key", "text_hash").agg(F.min("doc_order").alias("first_order"), F.count("*").alias("copies")), "passage_texts"
    )
    marked = stored(marked.join(least, "text_hash").drop("copies"), "passage_anchors")

    # The first copy of each text with such anchors, and the windows around them.
    keyed = slim.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_order"), "text", F.xxhash64("text").alias("text_hash"))
    suspects = keyed.join(marked, "text_hash").where((F.col("doc_order") == F.col("first_order")) & (F.unhex(F.md5("text")) == F.col("text_key")))
    second = stored(
        suspects.select("doc_order", "text_hash", "text", "hashes").mapInArrow(_suspect_rows(blocks), SUSPECTS), "passage_suspects"
    )
    sent = second.where("block IS NOT NULL").select("block", "entries", "docs").repartition(blocks, "block")
    found = sent.groupBy("block").applyInArrow(_repeated_windows(blocks), FOUND_OF).repartition(blocks, "owner_block")
    found = found.groupBy("owner_block").applyInArrow(_windows_by_document, "doc_order long, text_hash long, found binary")
    of = ["doc_order", "text_hash"]
    found = found.unionByName(second.where("found IS NOT NULL").select(*of, "found"))
    found = found.groupBy(*of).agg(F.collect_list("found").alias("found"))
    whole = second.where("block IS NULL").select(*of, "text").join(found, of).dropDuplicates(of)
    spans = "array<struct<start:long,end:long,reference:long,reference_start:long>>"
    result = f"text_key binary, n_removed long, kept_sha binary, spans {spans}"
    parsed = whole.select("text", "found").mapInArrow(_parse, result)

    special = least.where("copies > 1").select("text_key", "first_order").join(parsed, "text_key", "full_outer")
    special = stored(special, "passage_results")
    joined = rows.select("doc_id", "doc_order", "text_key", "n_words", "whole_sha").join(special, "text_key", "left")
    copy = (F.col("n_words") >= WINDOW) & F.coalesce(F.col("doc_order") > F.col("first_order"), F.lit(False))
    nothing = F.lit(hashlib.sha256(b"").digest())
    return joined.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(F.when(copy, nothing).otherwise(F.coalesce("kept_sha", "whole_sha")))).alias("kept_sha256"),
        F.when(~copy, F.col("spans")).alias("spans"),
    )
