"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source delivers its documents in blocks. With target weight w, block j (from 0) is released at floor(j / w) and due
at ceil((j + 1) / w); in every slot the released block with the earliest deadline goes next. After t slots a source with
weight w has had more than t * w - 1 and less than t * w + 1 blocks.

Weights are whole parts, so the schedule repeats after sum(parts) slots, a cycle. When a source runs out, a new phase
starts, with the weights of the sources that are left in proportion. So there are at most as many phases as sources, one
cycle is scheduled for each, and the blocks look up their slot in this table. Its size depends on the weights, not on the
data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystar.llm.common import free_name

REST = "rest"
BUCKET_DIGITS = 3
LARGEST_TABLE = 1_000_000


def _parts(weights: Mapping[str, int], rest: int) -> dict[str | None, int]:
    parts = {None: rest, **weights}
    if any(not isinstance(n, int) or n < 1 for n in parts.values()):
        raise ValueError("weights are whole numbers from 1 on")
    common = gcd(*parts.values())
    parts = {source: n // common for source, n in parts.items()}
    if len(parts) * sum(parts.values()) > LARGEST_TABLE:
        raise ValueError(f"the weights make more than {LARGEST_TABLE} slots: use smaller parts")
    return parts


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, n: total + n)


def _edf(share: Column, slots: Column) -> Column:
    """Stream numbers of the slots of one cycle; share: blocks of each stream in a cycle."""

    def put(state: Column, slot: Column) -> Column:
        def due(done: Column, k: Column) -> Column:
            n = F.get(share, k)
            released = F.floor(done * slots / n) <= slot
            deadline = F.ceil((done + 1) * slots / n)
            return F.when((done < n) & released, F.struct(deadline.alias("deadline"), k.alias("stream")))

        def add(chosen: Column) -> Column:
            done = F.transform(state["done"], lambda done, k: done + F.when(k == chosen, 1).otherwise(0))
            return F.struct(done.alias("done"), F.concat(state["order"], F.array(chosen)).alias("order"))

        return _let(F.array_min(F.filter(F.transform(state["done"], due), lambda x: x.isNotNull()))["stream"], add)

    start = F.struct(F.transform(share, lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order"))
    return F.aggregate(F.sequence(F.lit(0), (slots - 1).cast("int")), start, put)["order"]


def _phases(sizes: DataFrame, parts: list[int], block_docs: int) -> DataFrame:
    """stream, first_block, last_block, start, slots, share, places: a phase as one stream sees it.

    Its blocks from first_block to last_block go to the slots start + cycle * slots + places[nth in the cycle].
    `sizes`: stream, rows.
    """
    phase = "struct<start:bigint,slots:bigint,share:array<bigint>,left:array<bigint>,order:array<int>>"

    def step(state: Column, _: Column) -> Column:
        def with_share(share: Column) -> Column:
            return _let(_total(share), lambda slots: with_slots(share, slots))

        def with_slots(share: Column, slots: Column) -> Column:
            each = F.zip_with(state["left"], share, lambda left, n: F.when(n > 0, F.floor(left / n)))
            plan = _let(_edf(share, slots), lambda order: _let(F.array_min(each), lambda cycles: with_plan(share, slots, order, cycles)))
            return F.when(slots > 0, plan).otherwise(state)

        def with_plan(share: Column, slots: Column, order: Column, cycles: Column) -> Column:
            def ends(left: Column, k: Column) -> Column:
                """Slots of the next cycle until the stream runs out."""
                places = F.filter(F.sequence(F.lit(1), F.size(order)), lambda at: F.get(order, at - 1) == k)
                n = F.get(share, k)
                return F.when((n > 0) & (left == 0), 0).when((n > 0) & (left < n), F.get(places, (left - 1).cast("int")))

            def finish(left: Column) -> Column:
                return _let(F.array_min(F.transform(left, ends)), lambda stop: close(left, stop))

            def close(left: Column, stop: Column) -> Column:
                used = F.slice(order, 1, stop)
                rest = F.transform(left, lambda n, k: n - F.size(F.filter(used, lambda s: s == k)))
                entry = F.struct(
                    state["at"].alias("start"), slots.alias("slots"), share.alias("share"), state["left"].alias("left"), order.alias("order")
                )
                return F.struct(
                    rest.alias("left"),
                    (state["at"] + cycles * slots + stop).alias("at"),
                    F.concat(state["phases"], F.array(entry)).alias("phases"),
                )

            return _let(F.zip_with(state["left"], share, lambda left, n: left - cycles * n), finish)

        given = F.array(*[F.lit(n).cast("long") for n in parts])
        return _let(F.zip_with(state["left"], given, lambda left, n: F.when(left > 0, n).otherwise(F.lit(0).cast("long"))), with_share)

    rows = F.transform(
        F.sequence(F.lit(0), F.lit(len(parts) - 1)),
        lambda k: F.coalesce(F.get(F.filter(F.col("sizes"), lambda s: s["stream"] == k), F.lit(0))["rows"], F.lit(0).cast("long")),
    )
    one = sizes.agg(F.collect_list(F.struct("stream", "rows")).alias("sizes")).select(
        F.transform(rows, lambda n: F.ceil(n / block_docs)).alias("blocks")
    )
    start = F.struct(F.col("blocks").alias("left"), F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{phase}>").alias("phases"))
    planned = one.select("blocks", F.aggregate(F.sequence(F.lit(1), F.lit(len(parts))), start, step)["phases"].alias("phases"))
    nothing = F.transform("blocks", lambda _: F.lit(0).cast("long"))
    each = planned.select(
        "blocks", F.posexplode("phases").alias("k", "phase"), F.concat(F.transform("phases", lambda p: p["left"]), F.array(nothing)).alias("lefts")
    )
    each = each.withColumn("next_left", F.get("lefts", F.col("k") + 1))
    of_stream = each.select("phase", "blocks", "next_left", F.explode(F.sequence(F.lit(0), F.lit(len(parts) - 1))).alias("stream"))
    k = F.col("stream")
    places = F.filter(F.sequence(F.lit(0), F.size("phase.order") - 1), lambda at: F.get(F.col("phase.order"), at) == k)
    return of_stream.where(F.get("phase.share", k) > 0).select(
        "stream",
        (F.get("blocks", k) - F.get("phase.left", k)).alias("first_block"),
        (F.get("blocks", k) - F.get("next_left", k) - 1).alias("last_block"),
        F.col("phase.start").alias("start"),
        F.col("phase.slots").alias("slots"),
        F.get("phase.share", k).alias("share"),
        places.alias("places"),
    )


def scheduled(
    docs: DataFrame, weights: Mapping[str, int], rest: int, block_docs: int = 16, source: str = "source", doc_id: str = "doc_id"
) -> tuple[DataFrame, str]:
    """`docs` plus a struct: stream, block, release, deadline, slot and position. Returns its name as well.

    weights: whole parts by source; all other sources, null too, are one stream with `rest` parts. No row is dropped: a
    source that has run out leaves its slots to the others, in proportion to their weights. The documents of a stream go
    in the order of md5(doc_id), then doc_id, so the result depends on the rows only; rows that repeat a doc_id are in
    any order among themselves. `position` orders the rows; it has gaps only after the last, shorter block of a stream.
    An empty table gives an empty result.

    A stream is numbered by buckets of that hash, so that no task holds a stream. The bucket counts and the slots are
    broadcast: at most 4096 rows for each stream, and a table whose size the weights give (LARGEST_TABLE).
    """
    parts = _parts(weights, rest)
    streams = {name: k for k, name in enumerate(parts)}
    named = F.create_map(*[F.lit(x) for name, k in streams.items() if name is not None for x in (name, k)]) if weights else None
    stream = F.coalesce(F.try_element_at(named, F.col(source)), F.lit(0)) if weights else F.lit(0)
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    names = {}
    rows = docs
    for wanted, value in (("stream", stream), ("bucket", F.substring(key, 1, BUCKET_DIGITS))):
        names[wanted] = free_name(rows, wanted)
        rows = rows.withColumn(names[wanted], value)
    counts = rows.groupBy(F.col(names["stream"]).alias("stream"), F.col(names["bucket"]).alias("bucket")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("stream", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    sizes = counts.groupBy("stream").agg(F.sum("rows").alias("rows"))
    phases = _phases(sizes, list(parts.values()), block_docs)

    place = free_name(rows, "place")
    inside = F.row_number().over(Window.partitionBy(names["stream"], names["bucket"]).orderBy(key, F.col(doc_id))) - 1
    rows = rows.withColumn(place, inside)
    left = F.struct(F.col(names["stream"]).alias("stream"), F.col(names["bucket"]).alias("bucket"))
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(left.alias("of"), F.col(place).alias("inside")).alias(place))
    offset = free_name(rows, "offset")
    right = offsets.select(F.struct(F.struct("stream", "bucket").alias("of"), "offset").alias(offset))
    rows = rows.join(F.broadcast(right), F.col(place)["of"] == F.col(offset)["of"])
    nth = F.col(offset)["offset"] + F.col(place)["inside"]
    rows = rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            F.col(place)["of"]["stream"].alias("stream"), F.floor(nth / block_docs).alias("block"), (nth % block_docs).alias("inside")
        ).alias(place),
    )
    phase = free_name(rows, "phase")
    table = phases.select(F.struct(*phases.columns).alias(phase))
    x, p = F.col(place), F.col(phase)
    rows = rows.join(F.broadcast(table), (x["stream"] == p["stream"]) & x["block"].between(p["first_block"], p["last_block"]))
    nth = x["block"] - p["first_block"]
    cycle, nth_of_cycle = F.floor(nth / p["share"]), (nth % p["share"]).cast("int")
    slot = p["start"] + cycle * p["slots"] + F.get(p["places"], nth_of_cycle)
    result = free_name(docs, "mix")
    labels = F.array(*[F.lit(REST if name is None else name) for name in parts])
    value = F.struct(
        F.get(labels, x["stream"]).alias("stream"),
        x["block"].alias("block"),
        (p["start"] + F.floor(nth * p["slots"] / p["share"])).alias("release"),
        (p["start"] + F.ceil((nth + 1) * p["slots"] / p["share"])).alias("deadline"),
        slot.alias("slot"),
        (slot * block_docs + x["inside"]).alias("position"),
    )
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], value.alias(result)), result


def mixed(docs: DataFrame, weights: Mapping[str, int], rest: int, block_docs: int = 16) -> DataFrame:
    """The documents, sorted by their place in the mix."""
    rows, mix = scheduled(docs, weights, rest, block_docs)
    return rows.orderBy(F.col(mix)["position"]).select(*[F.col(f"`{c}`") for c in docs.columns])
