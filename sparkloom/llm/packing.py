"""Filling fixed-capacity containers with items.

Method: variable-capacity best-fit. The permitted capacities are optimised
jointly: a container is opened for the largest item left, filled best-fit in
every permitted capacity that takes the item, kept in the one that costs least
(fewest unused tokens per token held), and at the end downsized to the
smallest capacity that still takes its contents.

Items of one size are interchangeable, so the plan is made on the histogram of
sizes, which has at most as many entries as the largest capacity has tokens,
however many items there are. One plan step fills as many containers with the
same pattern of sizes as the histogram allows. The items then take their places in
parallel: an item's place is its rank among the items of its size, counted
over hash buckets, so a size that a third of all items share is no hot task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.common import cut
from sparkloom.llm.tokens import VOCABULARY, count_tokens

#: Entries of the histogram on the driver. Beyond that capacity sizes are planned in units of several tokens, rounded up.
MAX_SIZES = 4_000_000


def fill(first: int, capacity: int, sizes: list[int], counts: dict[int, int]) -> dict[int, int]:
    """Best-fit contents of one container opened with ``first``: always the largest item left that fits."""
    used, room = {first: 1}, capacity - first
    at = bisect_right(sizes, room) - 1
    while room > 0 and at >= 0:
        s = sizes[at]
        free = counts[s] - used.get(s, 0)
        if free <= 0:
            at -= 1
            continue
        n = min(free, room // s)
        if n == 0:
            at = min(at - 1, bisect_right(sizes, room) - 1)
            continue
        used[s] = used.get(s, 0) + n
        room -= n * s
        at = min(at - 1, bisect_right(sizes, room) - 1)
    return _closer(used, room, first, sizes, counts) if room > 0 else used


def _closer(used: dict[int, int], room: int, first: int, sizes: list[int], counts: dict[int, int]) -> dict[int, int]:
    """Trade one held item for one or two others so that the room left shrinks."""
    best, best_used = room, used
    for s in list(used):
        if s == first and used[s] == 1:
            continue
        space = room + s
        rest = dict(used)
        rest[s] -= 1
        if not rest[s]:
            del rest[s]
        hi = bisect_right(sizes, space) - 1
        for a in sizes[max(0, hi - 24) : hi + 1][::-1]:
            if counts[a] - rest.get(a, 0) <= 0:
                continue
            left = space - a
            b = None
            if left:
                j = bisect_right(sizes, left) - 1
                while j >= 0 and counts[sizes[j]] - rest.get(sizes[j], 0) - (sizes[j] == a) <= 0:
                    j -= 1
                b = sizes[j] if j >= 0 else None
            waste = left - (b or 0)
            if waste < best:
                best_used = dict(rest)
                best_used[a] = best_used.get(a, 0) + 1
                if b:
                    best_used[b] = best_used.get(b, 0) + 1
                best = waste
                if best == 0:
                    return best_used
    return best_used


def plan(histogram: dict[int, int], capacities: list[int]) -> list[tuple[int, int, dict[int, int]]]:
    """(capacity, containers, contents of each) for all items of the histogram {size: count}; sizes from 1 to the largest capacity."""
    counts = {s: n for s, n in histogram.items() if n > 0}
    sizes = sorted(counts)
    caps = sorted(set(capacities))
    out = []
    while sizes:
        first = sizes[-1]
        best = None
        for cap in caps:
            if cap < first:
                continue
            held = fill(first, cap, sizes, counts)
            total = sum(s * n for s, n in held.items())
            cost = ((cap - total) / total, -cap)
            if best is None or cost < best[0]:
                best = (cost, held, total)
        _, held, total = best
        times = min(counts[s] // n for s, n in held.items())
        out.append((next(c for c in caps if c >= total), times, held))
        for s, n in held.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
        if len(counts) != len(sizes):
            sizes = sorted(counts)
    return out


def ranked_by_size(items: DataFrame, size: str, ids: list[str], buckets: int) -> DataFrame:
    """items with ``_rank``: 0, 1, ... among the items of one size, counted bucket by bucket.

    Only (size, bucket) pairs are ranked in one task; the offsets between
    buckets are a table of at most sizes x buckets rows.
    """
    salted = items.withColumn("_b", F.pmod(F.xxhash64(*ids), F.lit(buckets)).cast("int"))
    per = salted.groupBy(size, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = per.select(size, "_b", (F.sum("_n").over(Window.partitionBy(size).orderBy("_b")) - F.col("_n")).alias("_o"))
    inner = Window.partitionBy(size, "_b").orderBy(*ids)
    return salted.withColumn("_r", F.row_number().over(inner) - 1).join(offsets, [size, "_b"]).withColumn("_rank", F.col("_r") + F.col("_o")).drop("_r", "_o", "_b")


def pack(items: DataFrame, capacities: list[int], ids: list[str], size: str = "n_tokens", buckets: int | None = None) -> DataFrame:
    """ids, piece_no, n_tokens, container_no (from 1) and capacity of each item.

    An item larger than the largest capacity comes as pieces (from 0): full
    ones and a rest; every other item is one piece, never split. Items
    without tokens take no room and are spread over the containers. Ties and repeated
    rows are items of their own. No items, no rows. Above MAX_SIZES tokens of
    capacity, sizes are rounded up to whole units of capacity / MAX_SIZES
    tokens for the plan (an item that fills the largest container stays whole);
    capacities below a unit are then not used.
    """
    caps = sorted({int(c) for c in capacities if c and c > 0})
    # Enough buckets that a size shared by a third of all items is ranked by as many tasks as there are.
    buckets = buckets or max(64, 4 * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not caps:
        raise ValueError("capacities must be at least 1")
    unit = -(-caps[-1] // MAX_SIZES)
    real = {c // unit: c for c in caps if c >= unit}
    units = sorted(real)
    top = F.lit(caps[-1])
    n = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint")
    last = F.greatest(F.ceil(n / top) - 1, F.lit(0)).cast("int")
    pieces = items.select(*ids, n.alias("_n"), last.alias("_last")).select(*ids, "_n", "_last", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("piece_no"))
    pieces = pieces.select(*ids, "piece_no", F.when(F.col("piece_no") < F.col("_last"), top).otherwise(F.col("_n") - F.col("_last") * top).cast("bigint").alias("n_tokens"))
    pieces = pieces.withColumn("_size", F.least(F.ceil(F.col("n_tokens") / unit), F.lit(units[-1])).cast("bigint"))
    pieces = cut(pieces, "pack-pieces")
    histogram = {r["_size"]: r.n for r in pieces.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_SIZES + 1 rows
    steps = plan({s: k for s, k in histogram.items() if s > 0}, units)
    bases = np.concatenate([[0], np.cumsum([t for _, t, _ in steps])]).astype(np.int64) if steps else np.zeros(1, np.int64)
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    for base, (cap, times, held) in zip(bases.tolist(), steps, strict=False):
        for s, k in held.items():
            places.setdefault(s, []).append((taken.get(s, 0), k, base, real[cap]))
            taken[s] = taken.get(s, 0) + k * times
    lookup = {s: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for s, rows in places.items()}
    containers = max(1, int(bases[-1]))
    step_caps = np.array([real[c] for c, _, _ in steps] or [caps[0]], dtype=np.int64)
    shared = items.sparkSession.sparkContext.broadcast((lookup, bases, step_caps))
    schema = ", ".join(f"`{k}` {items.schema[k].dataType.simpleString()}" for k in ids) + ", piece_no int, n_tokens bigint, container_no bigint, capacity bigint"
    width = len(ids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts, capacity = shared.value
        for b in batches:
            size_of = b.column(width + 2).to_numpy(zero_copy_only=False)
            rank = b.column(width + 3).to_numpy(zero_copy_only=False)
            no, cap = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(size_of):
                here = size_of == s
                r = rank[here]
                if s == 0:
                    no[here] = r % containers
                    step = np.minimum(np.searchsorted(starts, no[here], side="right") - 1, len(capacity) - 1)
                    cap[here] = capacity[step]
                    continue
                first, per, base, c = table[int(s)]
                j = np.searchsorted(first, r, side="right") - 1
                no[here] = base[j] + (r - first[j]) // per[j]
                cap[here] = c[j]
            cols = {b.schema.names[i]: b.column(i) for i in range(width + 2)}
            yield pa.RecordBatch.from_pydict(cols | {"container_no": pa.array(no + 1, pa.int64()), "capacity": pa.array(cap, pa.int64())})

    ranked = ranked_by_size(pieces, "_size", [*ids, "piece_no"], buckets)
    return ranked.select(*ids, "piece_no", "n_tokens", "_size", F.col("_rank").cast("bigint").alias("_rank")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, settings: DataFrame, path: str = VOCABULARY, jointly: bool = True) -> DataFrame:
    """pack_name, doc_id, piece_no, n_tokens, container_no, capacity of each document.

    jointly: every document once, over all permitted capacities together;
    pack_name is the setting of the container's capacity (the first by name if
    several have it). Otherwise every document once per setting, each setting
    by itself. Settings without a positive capacity do not count.
    """
    rows = settings.where("pack_name is not null and capacity_tokens > 0").groupBy("capacity_tokens").agg(F.min("pack_name").alias("pack_name")).collect()  # one row per setting
    sized = cut(count_tokens(docs.select("doc_id", "text"), ["doc_id"], path=path), "pack-sizes")
    columns = ["pack_name", "doc_id", "piece_no", "n_tokens", "container_no", "capacity"]
    if jointly:
        names = F.create_map(*[x for r in rows for x in (F.lit(int(r.capacity_tokens)), F.lit(r.pack_name))])
        packed = pack(sized, [r.capacity_tokens for r in rows], ["doc_id"])
        return packed.withColumn("pack_name", F.element_at(names, F.col("capacity").cast("int"))).select(columns)
    out = None
    for r in sorted(rows, key=lambda r: r.pack_name):
        one = pack(sized, [r.capacity_tokens], ["doc_id"]).withColumn("pack_name", F.lit(r.pack_name)).select(columns)
        out = one if out is None else out.unionByName(one)
    return out


def unused_space(packed: DataFrame) -> DataFrame:
    """pack_name, n_containers, n_tokens, unused_tokens, unused_share of a packing."""
    per = packed.groupBy("pack_name", "container_no").agg(F.sum("n_tokens").alias("t"), F.max("capacity").alias("c"))
    return per.groupBy("pack_name").agg(
        F.count(F.lit(1)).alias("n_containers"), F.sum("t").alias("n_tokens"), F.sum(F.col("c") - F.col("t")).alias("unused_tokens"),
        F.round(F.sum(F.col("c") - F.col("t")) / F.sum("c"), 6).alias("unused_share"),
    )
