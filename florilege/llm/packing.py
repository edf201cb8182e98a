"""Filling containers of fixed capacity: shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.operators.skew import numbered


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of containers, lengths in each) for a histogram of lengths from 1 to ``capacity``.

    Lengths are placed longest first, each into the containers that hold least so far (most room) and can take it;
    equal containers are one pattern with a count, so the work depends on the histogram and not on the items.
    A length that fits nowhere opens containers, each for as many items of it as there are and as it can hold.
    """
    open_by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(count: int, lengths: tuple[int, ...], room: int) -> None:
        (open_by_room[room].append if room else done.append)((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_by_room.items() if packs), default=-1)
            if room < length:
                # one after the other, items of one length go on into the container opened last until it is full
                many = min(left, capacity // length)
                put(left // many, (length,) * many, capacity - many * length)
                left %= many
                continue
            count, lengths = open_by_room[room].pop()
            used = min(count, left)
            left -= used
            if used < count:
                open_by_room[room].append((count - used, lengths))
            put(used, (*lengths, length), room - length)
        for r in [r for r, packs in open_by_room.items() if not packs]:
            del open_by_room[r]
    for packs in open_by_room.values():
        done += packs
    return done


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> tuple[list[tuple[int, int, int, int]], int]:
    """(length, first rank, first container, offset) of every run of places, and the number of containers."""
    rank: dict[int, int] = defaultdict(int)
    slots, container = [], 0
    for count, lengths in patterns:
        offset = 0
        for n in lengths:
            slots.append((n, rank[n], container, offset))
            rank[n] += count
            offset += n
        container += count
    return slots, container


def pack_items(items: DataFrame, id_col: str, size_col: str, capacities: list[tuple[int, int]]) -> DataFrame:
    """Containers of every item for each (capacity_id, capacity).

    Columns: capacity_id, id, part, container_id (from 0), n_tokens, start (place in the container). An item is one part
    unless it is larger than the capacity; then it is cut into full containers of its own (parts 0, 1, ...) and a rest
    that is packed like any item. Items of size 0 or null take no room: part 0 of container 0, n_tokens 0. Repeated ids are items of their
    own, null ids come out as -1. An empty table gives no rows. Capacities that are null or below 1 are left out.

    The driver sees only the histogram (one row per length, at most the capacity) and patterns made from it. Which item takes which place is decided
    by its rank within its length, numbered without a window over a length that many items share.
    """
    spark = items.sparkSession
    schema = f"capacity_id bigint, {id_col} bigint, part bigint, container_id bigint, n_tokens bigint, start bigint"
    caps = sorted((int(i), int(c)) for i, c in capacities if i is not None and c is not None and c >= 1)
    if not caps:
        return spark.createDataFrame([], schema)
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    wide = items.select(F.col(id_col).cast("long").alias("_id"), size.alias("_n")).withColumn("_c", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("capacity_id"), F.lit(c).cast("long").alias("cap")) for i, c in caps])))
    wide = wide.select("_id", "_n", "_c.*").withColumn("full", F.floor(F.col("_n") / F.col("cap"))).withColumn("rest", F.col("_n") % F.col("cap"))
    histogram: dict[int, dict[int, int]] = defaultdict(dict)
    whole: dict[int, int] = {}
    for r in wide.groupBy("capacity_id", "rest").agg(F.count("*").alias("n"), F.sum("full").alias("full")).collect():  # at most the sum of the capacities
        if r["rest"]:
            histogram[r["capacity_id"]][r["rest"]] = r["n"]
        whole[r["capacity_id"]] = whole.get(r["capacity_id"], 0) + r["full"]
    rows: list[tuple[int, int, int, int, int]] = []
    opened: dict[int, int] = {}
    for i, c in caps:
        slots, opened[i] = _slots(shortest_pack_first(histogram[i], c))
        rows += [(i, *s) for s in slots]
    rows.sort()
    # (capacity, length) -> its slots, in order of first rank; as many as places in patterns, whatever the number of items
    table = np.array(rows, np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)

    parts = wide.where("rest > 0").select("capacity_id", "rest", "_id", "full", F.monotonically_increasing_id().alias("_tie"))
    ranked = numbered(parts, ["capacity_id", "rest"], ["_id", "_tie"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        key = t[:, 0] * (1 << 32) + t[:, 1]
        for b in batches:
            cap, rest, ident, full, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3, 4))
            want = cap * (1 << 32) + rest
            lo, hi = np.searchsorted(key, want), np.searchsorted(key, want, "right")
            while True:  # binary search of all ranks at once among the slots of their length
                wide_open = hi - lo > 1
                if not wide_open.any():
                    break
                mid = (lo + hi) // 2
                up = wide_open & (t[np.minimum(mid, len(t) - 1), 2] <= rank)
                lo, hi = np.where(up, mid, lo), np.where(wide_open & ~up, mid, hi)
            s = t[lo]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cap, ident, full, s[:, 3] + rank - s[:, 2], rest, s[:, 4])], ["capacity_id", id_col, "part", "container_id", "n_tokens", "start"])

    packed = ranked.select("capacity_id", "rest", F.coalesce("_id", F.lit(-1)).alias("_id"), "full", "_rank").mapInArrow(place, schema)
    # full containers: numbered after the others by a running sum of the items' full parts, in order of item
    cut = wide.where("full > 0").select("capacity_id", "_id", "cap", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part"), F.monotonically_increasing_id().alias("_tie"))
    first = F.element_at(F.create_map(*[x for i, n in opened.items() for x in (F.lit(i).cast("long"), F.lit(n).cast("long"))]), F.col("capacity_id"))
    split = numbered(cut, ["capacity_id"], ["_id", "part", "_tie"]).select(
        "capacity_id", F.coalesce("_id", F.lit(-1)).alias(id_col), F.col("part").cast("long"), (first + F.col("_rank")).alias("container_id"), F.col("cap").alias("n_tokens"), F.lit(0).cast("long").alias("start")
    )
    empty = wide.where("_n = 0").select("capacity_id", F.coalesce("_id", F.lit(-1)).alias(id_col), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("container_id"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("start"))
    return packed.unionByName(split).unionByName(empty)
