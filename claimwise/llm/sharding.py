"""Minimax contiguous sharding: the smallest shard capacity that ordered atomic groups allow.

Equal texts form one atomic group.  Groups stand in the order of their text hash.  The smallest
capacity for which a greedy left-to-right fill needs at most ``n_shards`` shards is found by binary
search; the cuts of that fill are the shard borders.  Only DataFrame functions run on the rows.

The prefix sums are never gathered whole.  The driver holds a summary (one known group border per
bucket), bounds every cut of the optimal fill by it, and asks for more borders only inside those
bounds, until it knows every border there is between them.  Each round narrows the bounds by an
order of magnitude; ``KNOTS`` bounds what a round brings to the driver.

A group of copies may hold a third of all rows: its rows are numbered in ``SPLIT`` separate cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimwise.llm.common import stored

#: Cells that the rows of one group are dealt to.
SPLIT = 64
#: Buckets of the text hash: 2 ** HASH_BITS windows of the prefix sum, and rows of the first summary.
HASH_BITS = 14
#: Borders that one refinement brings to the driver, at most about twice this number.
KNOTS = 16_384


def _cuts(knots: np.ndarray, capacity: int, n: int) -> list[int] | None:
    """Greedy fill over known borders (ascending, the last is the total): the shards' ends, None if over ``n``."""
    at, ends, total = 0, [], int(knots[-1])
    while at < total:
        k = int(np.searchsorted(knots, at + capacity, side="right")) - 1
        if k < 0 or int(knots[k]) <= at or len(ends) == n:
            return None
        at = int(knots[k])
        ends.append(at)
    return ends


def _least(knots: np.ndarray, low: int, n: int) -> int:
    """The smallest feasible capacity of at least ``low`` by binary search."""
    high = int(knots[-1])
    while low < high:
        mid = (low + high) // 2
        if _cuts(knots, mid, n) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _reach(knots: np.ndarray, capacity: int, n: int) -> list[int]:
    """A lower bound of the ends of the first ``n`` shards at this capacity: known borders only, no jump where none is known."""
    at, ends = 0, []
    for _ in range(n):
        k = int(np.searchsorted(knots, at + capacity, side="right")) - 1
        at = max(at, int(knots[k])) if k >= 0 else at
        ends.append(at)
    return ends


def minimax_cuts(groups: DataFrame, knots: np.ndarray, largest: int, n: int) -> tuple[int, list[int]]:
    """Capacity and cut positions of the optimal fill.

    ``groups`` has one row per group with ``end_bytes``, the running total at its end; ``knots`` are
    some of these borders, ascending, the last being the total."""
    total = int(knots[-1])
    low, step = max(largest, -(-total // n)), total
    while True:
        high = _least(knots, low, n)
        if high == low:
            return high, _cuts(knots, high, n)
        spans, upper = [], 0
        for lower in _reach(knots, low, n):
            upper = min(total, upper + high)
            if spans and lower <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], upper)
            else:
                spans.append([lower, upper])
        # parts of the spans: as many as the driver may hold, and finer in every round
        step = max(1, min(step // 2, sum(b - a for a, b in spans) // KNOTS))
        inside = F.lit(False)
        for a, b in spans:
            inside = inside | F.col("end_bytes").between(a, b)
        found = (groups.filter(inside)
                 .groupBy((F.col("end_bytes") / F.lit(step)).cast("long").alias("part"))
                 .agg(F.max("end_bytes").alias("last"), F.count("*").alias("n"))
                 .select("last", "n").toPandas())
        knots = np.unique(np.concatenate([knots, found["last"].to_numpy(np.int64)]))
        if int(found["n"].max()) == 1:
            # every border that a fill between the bounds can use is known
            best = _least(knots, low, n)
            return best, _cuts(knots, best, n)


def shard_contiguous(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into ``n_shards`` contiguous shards of near equal bytes, equal texts together.

    Returns per row: ``doc_id``, ``size`` (UTF-8 bytes + 8), ``text_crc32``, ``law`` ('bytes'), ``shard``
    (from 0), ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null: no law of growth holds) and
    ``capacity`` (the smallest feasible shard size).

    Null texts have no bytes (size 8, crc32 of the empty text) and form a group of their own; empty texts
    another.  Repeated rows keep one slot each.  An empty table gives an empty result.  Other columns of the
    input are not read, whatever their names.
    """
    spark = docs.sparkSession
    text = F.col("text")
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
        ).withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(SPLIT)).cast("int")),
        "shard-rows")
    cells = rows.groupBy("group", "cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    cells = stored(cells, "shard-cells")
    sums = cells.groupBy("group").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    sums = sums.withColumn("bucket", F.shiftright("group", 64 - HASH_BITS))
    # at most 2 ** HASH_BITS rows: one window numbers them, and they may be broadcast
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.groupBy("bucket").agg(F.sum("n").alias("bn"), F.sum("bytes").alias("bb"), F.max("bytes").alias("most"))
    buckets = stored(buckets.select(
        "bucket", "bn", "bb", "most",
        F.coalesce(F.sum("bn").over(order), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("bb").over(order), F.lit(0)).alias("bytes_before")), "shard-buckets")
    inner = Window.partitionBy("bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    groups = stored(
        sums.join(F.broadcast(buckets.select("bucket", "n_before", "bytes_before")), "bucket")
        .select("group", "n", "bytes",
                (F.col("n_before") + F.sum("n").over(inner)).alias("end_n"),
                (F.col("bytes_before") + F.sum("bytes").over(inner)).alias("end_bytes")), "shard-groups")

    summary = buckets.select("most", (F.col("bytes_before") + F.col("bb")).alias("end")).toPandas()
    if len(summary):
        capacity, ends = minimax_cuts(groups, np.sort(summary["end"].to_numpy(np.int64)), int(summary["most"].max()), n_shards)
    else:
        capacity, ends = 0, []
    cuts = F.array(*[F.lit(e) for e in ends]) if ends else F.array().cast("array<bigint>")
    start = F.col("end_bytes") - F.col("bytes")
    placed = groups.select("group", (F.col("end_n") - F.col("n")).alias("start_n"),
                           F.size(F.filter(cuts, lambda c: c <= start)).alias("shard"))
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("start_n").alias("first")).collect()}
    first = F.lit(0).cast("long")
    for shard, at in sorted(firsts.items()):
        first = F.when(F.col("shard") == shard, F.lit(at).cast("long")).otherwise(first)
    before = Window.partitionBy("group").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (cells.select("group", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_in_group"))
             .join(placed, "group")
             .select("group", "cell", "shard", (F.col("start_n") - first + F.col("n_in_group")).alias("at")))
    number = F.row_number().over(Window.partitionBy("group", "cell").orderBy("doc_id", "size"))
    return (rows.withColumn("number", number).join(cells, ["group", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"), (F.col("at") + F.col("number") - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.lit(capacity).cast("long").alias("capacity")))
