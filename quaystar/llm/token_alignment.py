"""How the tokens of two tokenizers overlap: groups between common ends, links, and how often each pair of ids is linked.

1. Tasks tokenize the documents by both vocabularies, align the tokens by byte offsets, and store blocks of documents: the
   token ids, what concerns single documents, and the distinct pairs of the block with their counts.
2. Distinct pairs of all blocks meet by hash bucket. Each bucket gets a minimal perfect hash: levels of slots, each of which
   keeps the pairs that have a slot to themselves; the rank of a slot among the kept ones is the number of its pair.
3. Buckets make up parts of a bounded number of pairs. For each part, tasks add the counts of their blocks to a dense vector
   by these numbers (looked up, then verified by the pair itself), and the vectors are summed by segments in two levels.
4. Documents are aligned again from the stored ids, and their links look up the counts.

The hash, the pairs and the counts of one part are broadcast: `Pairs.part` bounds them, and more pairs make more parts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystar.llm.class_lm import _pack, _unpack, _whole_groups
from quaystar.llm.common import Batches, stored

# Fixed value: the words that byte-level BPE of this kind splits texts into.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 20_000  # characters without a break that the faster tokenizer is not given


@dataclass(frozen=True)
class Pairs:
    """Tokens of a block, hash buckets of pairs, pairs of a part at most (but for its last bucket), counts of a segment."""

    block_tokens: int = 1 << 19
    buckets: int = 1024
    part: int = 1 << 21
    segment: int = 8192


# --- tokenizers -------------------------------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be printed, else one from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printed)]
    return {chr(byte): byte for byte in printed} | {chr(256 + k): byte for k, byte in enumerate(others)}


class Tokenizers:
    """Both tokenizers from the contents of their files, and the bytes of their tokens by id."""

    def __init__(self, bpe: bytes, pieces: bytes) -> None:
        import sentencepiece
        import tiktoken

        self.file = bpe
        spec, letters = json.loads(bpe), byte_letters()
        special = {token["content"] for token in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.slow = None
        self.bytes_a = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for token, k in ranks.items():
            self.bytes_a[k] = token
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_b = [self._piece(k) for k in range(self.pieces.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(token) for token in tokens]) for tokens in (self.bytes_a, self.bytes_b))

    def _piece(self, k: int) -> bytes:
        piece = self.pieces.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(k) else piece.replace("▁", " ").encode()

    def _bpe(self, text: str) -> list[int]:
        if len(text) > LONG_RUN and re.search(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}", text):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.file.decode())
                self.slow.encode_special_tokens = True
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both; none for a text that is null or empty or that does not come back byte by byte."""
        if not text:
            return [], []
        a, b, whole = self._bpe(f" {text}"), self.pieces.encode(text), f" {text}".encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else ([], [])


# --- alignment --------------------------------------------------------------------------------------------------------


@dataclass
class Aligned:
    """Two token sequences over the same bytes. links: the A and the B token of each; ends: whether a group ends there."""

    links: tuple[np.ndarray, np.ndarray]
    ends_a: np.ndarray
    ends_b: np.ndarray


def aligned(length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Tokens of these byte lengths that cover the same bytes."""
    stop_a, stop_b = np.cumsum(length_a), np.cumsum(length_b)
    first = np.searchsorted(stop_b, stop_a - length_a, "right")
    last = np.searchsorted(stop_b, stop_a, "left")
    count = last - first + 1
    left = np.repeat(np.arange(len(count)), count)
    right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count - first, count)
    return Aligned((left, right), stop_b[last] == stop_a, np.isin(stop_b, stop_a, assume_unique=True))


def group_texts(a: np.ndarray, b: np.ndarray, of: Aligned, tokens: np.ndarray) -> Iterator[bytes]:
    """`a1,a2|b1;a3|b2,b3` for each document. tokens: how many A and B tokens each document has together."""
    group_a, group_b = (np.cumsum(ends) - ends for ends in (of.ends_a, of.ends_b))
    many_a, many_b = np.bincount(group_a), np.bincount(group_b)
    place_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(many_a)[group_b]
    ids, after = np.empty(len(a) + len(b), "i8"), np.empty(len(a) + len(b), "u1")
    ids[place_a], ids[place_b] = a, b
    after[place_a], after[place_b] = np.where(of.ends_a, ord("|"), ord(",")), np.where(of.ends_b, ord(";"), ord(","))
    width = len(str(int(ids.max(initial=0))))
    letters = np.zeros((len(ids), width + 1), "u1")
    for k in range(width):
        digit = ids // 10 ** (width - 1 - k)
        letters[:, k] = np.where((digit > 0) | (k == width - 1), ord("0") + digit % 10, 0)
    letters[:, width] = after
    used = np.concatenate([[0], np.cumsum((letters > 0).sum(1))])
    flat = letters[letters > 0].tobytes()
    stops = used[np.cumsum(tokens)]
    for start, stop in zip(np.concatenate([[0], stops[:-1]]), stops, strict=True):
        yield flat[start : max(start, stop - 1)]


# --- blocks -----------------------------------------------------------------------------------------------------------

COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
PACKED = ("a", "b", "pairs", "times")


def blocks_of(docs: DataFrame, files: tuple[bytes, bytes], model: Pairs) -> DataFrame:
    """Stored: block, doc_ids, the arrays COLUMNS and hashes of its documents, and packed: token ids, pairs and their counts."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        both, part, seq = Tokenizers(*shared.value), TaskContext.get().partitionId(), 0
        ids, found, tokens, doc_kind = [], [], 0, None

        def block() -> pa.RecordBatch:
            n_a, n_b = (np.array([len(doc[k]) for doc in found]) for k in (0, 1))
            a, b = (np.concatenate([np.array(doc[k], "u2") for doc in found]).astype("i8") for k in (0, 1))
            of = aligned(both.length_a[a], both.length_b[b]) if len(a) else Aligned((a, a), a, a)
            doc_of = np.repeat(np.arange(len(found)), n_a)
            groups = np.bincount(doc_of[of.ends_a.astype(bool)], minlength=len(found))
            links = np.bincount(doc_of[of.links[0]], minlength=len(found))
            pairs, times = np.unique(a[of.links[0]] * len(both.bytes_b) + b[of.links[1]], return_counts=True)
            texts = group_texts(a, b, of, n_a + n_b) if len(a) else iter([b""] * len(found))
            hashes = [hashlib.sha256(text).hexdigest() if text else "" for text in texts]
            lists = [pa.array([column], pa.list_(pa.int64())) for column in (n_a, n_b, groups, links)]
            packed = [(a, "u2"), (b, "u2"), (np.diff(pairs, prepend=0), "i8"), (times, "i8")]
            columns = [pa.array([(part << 32) + seq]), pa.array([ids], pa.list_(doc_kind)), *lists, pa.array([hashes], pa.list_(pa.string()))]
            columns += [pa.array([_pack(*values)], pa.binary()) for values in packed]
            return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", *COLUMNS, "hashes", *PACKED])

        for batch in (whole.slice(at, 64) for whole in batches for at in range(0, len(whole), 64)):
            doc_kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = both.encode(text)
                found.append((np.array(a, "u2"), np.array(b, "u2")))
                ids.append(doc_id)
                tokens += len(a) + 1
                if tokens >= model.block_tokens:
                    yield block()
                    ids, found, tokens, seq = [], [], 0, seq + 1
        if ids:
            yield block()

    lists = ", ".join(f"{name} array<long>" for name in COLUMNS)
    packed = ", ".join(f"{name} binary" for name in PACKED)
    return stored(rows.mapInArrow(run, f"block long, doc_ids array<{kind}>, {lists}, hashes array<string>, {packed}"), "token_blocks")


# --- minimal perfect hash ---------------------------------------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of the keys, another one for each seed."""
    x = keys.astype("u8") + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BUCKET_SEED = 1000


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, BUCKET_SEED) % np.uint64(buckets)).astype("i8")


def hashed(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Slots of each level, one flag for each slot (kept or not), and the keys in the order of their numbers."""
    sizes, flags, order, left = [], [], [], keys
    while len(left):
        size = 2 * len(left)
        slot = (mixed(left, len(sizes)) % np.uint64(size)).astype("i8")
        times = np.bincount(slot, minlength=size)
        alone = times[slot] == 1
        sizes.append(size)
        flags.append(times == 1)
        order.append(left[alone][np.argsort(slot[alone])])
        left = left[~alone]
    return sizes, np.concatenate([np.zeros(0, bool), *flags]), np.concatenate([np.zeros(0, "i8"), *order])


class PairIndex:
    """The hash of the buckets of one part: rows of (bucket, sizes, flags, keys), flags as bits."""

    def __init__(self, rows: list[tuple], buckets: int) -> None:
        self.buckets, deepest = buckets, max(len(sizes) for _, sizes, _, _ in rows)
        self.start, self.size = np.zeros((deepest, buckets), "i8"), np.zeros((deepest, buckets), "i8")
        at, flags = 0, []
        for bucket, sizes, bits, _ in rows:
            for level, size in enumerate(sizes):
                self.start[level, bucket], self.size[level, bucket] = at, size
                at += size
            flags.append(np.unpackbits(np.frombuffer(bits, "u1"), count=sum(sizes)).astype(bool))
        self.flags = np.concatenate(flags)
        self.rank = np.cumsum(self.flags, dtype="i4") - self.flags
        self.keys = np.concatenate([_unpack(keys, "i8") for *_, keys in rows])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those of other parts."""
        out, todo = np.full(len(keys), -1, "i8"), np.arange(len(keys))
        for level in range(len(self.size)):
            bucket = bucket_of(keys[todo], self.buckets)
            size = self.size[level, bucket]
            todo, bucket, size = todo[size > 0], bucket[size > 0], size[size > 0]
            slot = self.start[level, bucket] + (mixed(keys[todo], level) % size.astype("u8")).astype("i8")
            kept = self.flags[slot]
            out[todo[kept]] = self.rank[slot[kept]]
            todo = todo[~kept]
        found = out >= 0
        found[found] = self.keys[out[found]] == keys[found]
        return np.where(found, out, -1)


def indexed(blocks: DataFrame, model: Pairs) -> DataFrame:
    """Stored: bucket, n (distinct pairs), sizes, flags, keys of each bucket's hash."""

    def dealt(batches: Batches) -> Batches:
        for batch in batches:
            for pairs in batch.column(0):
                keys = np.cumsum(_unpack(pairs.as_py(), "i8"))
                bucket = bucket_of(keys, model.buckets)
                order = np.argsort(bucket, kind="stable")
                found, starts = np.unique(bucket[order], return_index=True)
                some = [_pack(part, "i8") for part in np.split(keys[order], starts[1:])] if len(found) else []
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(some, pa.binary())], names=["bucket", "keys"])

    def build(batches: Batches) -> Batches:
        for bucket, keys in _whole_groups(batches, 0, rows=1):
            names = bucket.to_numpy()
            for one in np.unique(names):
                every = np.unique(np.concatenate([_unpack(keys[int(k)].as_py(), "i8") for k in np.flatnonzero(names == one)]))
                sizes, flags, order = hashed(every)
                row = {"bucket": int(one), "n": len(every), "sizes": sizes, "flags": np.packbits(flags).tobytes(), "keys": _pack(order, "i8")}
                kinds = [("bucket", pa.int32()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("flags", pa.binary()), ("keys", pa.binary())]
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

    pieces = blocks.select("pairs").mapInArrow(dealt, "bucket int, keys binary").repartition("bucket").sortWithinPartitions("bucket")
    return stored(pieces.mapInArrow(build, "bucket int, n long, sizes array<long>, flags binary, keys binary"), "pair_index")


def parts_of(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ranges of buckets (first, last) with no more than `most` pairs, or of one bucket."""
    out: list[list[int]] = []
    held = 0
    for bucket, n in sorted(sizes):
        if not out or held + n > most:
            out.append([bucket, bucket])
            held = 0
        out[-1][1] = bucket
        held += n
    return [(first, last) for first, last in out]


# --- counts -----------------------------------------------------------------------------------------------------------


def summed_counts(blocks: DataFrame, shared, size: int, model: Pairs) -> np.ndarray:
    """How often each pair of the part is linked: dense vectors of the tasks, summed by segments in two levels."""
    schema, kinds = "segment int, branch int, vec binary", [("segment", pa.int32()), ("branch", pa.int32()), ("vec", pa.binary())]

    def rows_of(segments: Iterator[tuple[int, int, np.ndarray]]) -> Batches:
        for segment, branch, vec in segments:
            row = {"segment": segment, "branch": branch, "vec": _pack(vec, "i8")}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

    def dense(batches: Batches) -> Batches:
        from pyspark import TaskContext

        total, index, branch = np.zeros(size, "i8"), shared.value, TaskContext.get().partitionId() % 16
        for batch in batches:
            for pairs, times in zip(*batch.columns, strict=True):
                number = index.numbers(np.cumsum(_unpack(pairs.as_py(), "i8")))
                total[number[number >= 0]] += _unpack(times.as_py(), "i8")[number >= 0]
        cut = ((at // model.segment, branch, total[at : at + model.segment]) for at in range(0, size, model.segment))
        yield from rows_of(row for row in cut if row[2].any())

    def add(batches: Batches) -> Batches:
        held: dict[int, np.ndarray] = {}
        last = None
        for batch in batches:
            for segment, vec in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if last is not None and segment != last:
                    yield from rows_of(iter([(last, 0, held.pop(last))]))
                held[segment] = held.get(segment, 0) + _unpack(vec.as_py(), "i8")
                last = segment
        if held:
            yield from rows_of(iter([(last, 0, held.pop(last))]))

    rows = blocks.select("pairs", "times").mapInArrow(dense, schema)
    for keys in (("segment", "branch"), ("segment",)):
        rows = rows.repartition(*keys).sortWithinPartitions("segment").mapInArrow(add, schema)
    counts = np.zeros(size, "i8")
    for row in rows.collect():
        values = _unpack(bytes(row.vec), "i8")
        counts[row.segment * model.segment : row.segment * model.segment + len(values)] = values
    return counts


def looked_up(blocks: DataFrame, shared, files, best: np.ndarray) -> DataFrame:
    """block, n_best and count_sum of its documents, from the pairs of one part."""

    def run(batches: Batches) -> Batches:
        (index, counts), both = shared.value, Tokenizers(*files.value)
        for batch in batches:
            for block, n_a, a, b, pairs in zip(*batch.columns, strict=True):
                pairs, a, b = np.cumsum(_unpack(pairs.as_py(), "i8")), _unpack(a.as_py(), "u2").astype("i8"), _unpack(b.as_py(), "u2").astype("i8")
                per_doc = n_a.values.to_numpy()
                if len(a):
                    left, right = aligned(both.length_a[a], both.length_b[b]).links
                    number = index.numbers(pairs)
                    times = np.where(number >= 0, counts[number], 0)
                    highest = (number >= 0) & (times == best[pairs % len(both.bytes_b)])
                    link = np.searchsorted(pairs, a[left] * len(both.bytes_b) + b[right])
                    starts = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=len(a)))])[np.concatenate([[0], np.cumsum(per_doc)])]
                    sums = [np.diff(np.concatenate([[0], np.cumsum(values[link])])[starts]) for values in (highest.astype("i8"), times)]
                else:
                    sums = [np.zeros(len(per_doc), "i8")] * 2
                lists = [pa.array([values], pa.list_(pa.int64())) for values in sums]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), *lists], names=["block", "n_best", "count_sum"])

    rows = blocks.select("block", "n_a", "a", "b", "pairs")
    return rows.mapInArrow(run, "block long, n_best array<long>, count_sum array<long>")


def alignment_report(docs: DataFrame, bpe_file: str, piece_file: str, model: Pairs = Pairs()) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row for each row of docs.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have zeros and an empty hash. Repeated
    rows count as often as they stand there. Other columns are not looked at. An empty table gives no rows. The files are read
    by the driver and sent to the tasks.
    """
    context = docs.sparkSession.sparkContext
    files = []
    for path in (bpe_file, piece_file):
        with open(path, "rb") as file:
            files.append(file.read())
    blocks = blocks_of(docs, tuple(files), model)
    index = indexed(blocks, model)
    parts = parts_of([tuple(row) for row in index.select("bucket", "n").collect()], model.part)
    both = Tokenizers(*files)
    best = np.zeros(len(both.bytes_b), "i8")

    def part_index(first: int, last: int) -> PairIndex:
        rows = index.where(F.col("bucket").between(first, last)).select("bucket", "sizes", "flags", "keys").orderBy("bucket").collect()
        return PairIndex([(row.bucket, row.sizes, bytes(row.flags), bytes(row.keys)) for row in rows], model.buckets)

    def counts_of(pairs: PairIndex) -> np.ndarray:
        return summed_counts(blocks, context.broadcast(pairs), len(pairs.keys), model)

    def with_counts(pairs: PairIndex, counts: np.ndarray) -> DataFrame:
        return looked_up(blocks, context.broadcast((pairs, counts)), context.broadcast(tuple(files)), best)

    kept = None
    for part in parts:
        pairs = part_index(*part)
        kept = pairs, counts_of(pairs)
        np.maximum.at(best, pairs.keys % len(best), kept[1])
    if len(parts) == 1:
        found = with_counts(*kept)
    else:
        found = None
        for part in parts:  # counts are summed again rather than kept: the driver holds one part at a time
            pairs = part_index(*part)
            one = stored(with_counts(pairs, counts_of(pairs)), "pair_sums")
            found = one if found is None else found.unionByName(one)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", *COLUMNS, "hashes")).alias("at", "doc"))
    values = [F.col(f"doc.{name}").alias(name) for name in COLUMNS]
    zeros = F.lit(0).cast("long")
    if found is None:
        return listed.select(F.col("doc.doc_ids").alias("doc_id"), *values, zeros.alias("n_best"), zeros.alias("count_sum"), F.col("doc.hashes").alias("groups_sha256"))
    sums = found.select("block", F.posexplode(F.arrays_zip("n_best", "count_sum")).alias("at", "sum"))
    sums = sums.groupBy("block", "at").agg(F.sum("sum.n_best").alias("n_best"), F.sum("sum.count_sum").alias("count_sum"))
    return listed.join(sums, ["block", "at"]).select(F.col("doc.doc_ids").alias("doc_id"), *values, "n_best", "count_sum", F.col("doc.hashes").alias("groups_sha256"))
