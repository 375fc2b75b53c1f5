"""Mixing sources to target weights by blocks of words.

The words of a source's documents are laid end to end and packed into blocks of ``block`` words (the last may be
shorter).  Output shards draw how many blocks they take of each source from a multinomial over what the sources
still owe, so that each draw is random and the totals meet the targets.  A source's slots, counted through all shards,
are mapped to its blocks by a pseudorandom permutation of the block numbers, a new one for each pass over the source; blocks
and documents then meet by block number.

Sources are few against documents: one row per source, and per source and output shard, is held by the driver.  Documents, blocks
and slots stay distributed; a source may hold any share of the rows, its words are counted in ``CELLS`` separate cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwise.llm.common import BLANK_RUN, BLANKS, short_batches, stored

CELLS = 1024
BLOCK_WORDS = 64
#: Output shards and the passes a mix may make over a source.
SHARDS = 256
MOST_PASSES = 3
#: Slots that one row of the slot table may stand for.
SLOT_RUN = 65_536


def n_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def cycling_weights(sources: list[str | None]) -> list[float]:
    """1, 2, 3, 1, ... in the given order."""
    return [1.0 + i % 3 for i in range(len(sources))]


def targets(sizes: list[int], weights: list[float], most: float = MOST_PASSES) -> list[float]:
    """Shares of all sizes by weight; none above ``most`` times its size, the excess reshared by weight."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        for i in free:
            out[i] = left * weights[i] / weight
        over = {i for i in free if out[i] > most * sizes[i]}
        if not over:
            break
        for i in over:
            out[i] = float(most * sizes[i])
        free -= over
    return out


def draw(slots: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) in each output shard (rows): multinomial draws over what is still owed."""
    rng, left, total = np.random.default_rng(seed), slots.astype(np.int64).copy(), int(slots.sum())
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        size = total * (k + 1) // shards - total * k // shards
        if not size:
            continue
        got = np.minimum(rng.multinomial(size, left / left.sum()), left)
        while got.sum() < size:  # what went beyond a source's debt is drawn again from the others
            rest = left - got
            got += np.minimum(rng.multinomial(size - got.sum(), rest / rest.sum()), rest)
        out[k] = got
        left -= got
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1 at ``index``: four Feistel rounds on the next even number of bits, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    limit, key = size.astype(np.uint64), key.astype(np.uint64)
    while len(todo):
        h, m, x = half[todo], mask[todo], out[todo]
        a, b = x >> h, x & m
        for r in range(4):
            f = (b + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15) + key[todo] * np.uint64(0xD1B54A32D192ED03)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f ^ (f >> np.uint64(32))) & m)
        out[todo] = x = (a << h) | b
        todo = todo[x >= limit[todo]]
    return out.astype(np.int64)


def _row_key(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`"), F.col(f"`{source_col}`")).alias("mark")]


def _takes(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, block: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Per document row: where its words stand in its source; and how often each block of a source is taken."""
    spark = docs.sparkSession
    rows = docs.select(*_row_key(docs, id_col, text_col, source_col), F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    rows = stored(rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(CELLS)).cast("int")), "mix-rows")
    cells = stored(rows.groupBy("source", "cell").agg(F.sum("size").alias("words")), "mix-cells")
    found = {r["source"]: int(r["words"]) for r in cells.groupBy("source").agg(F.sum("words").alias("words")).collect()}
    names = sorted(found, key=lambda s: (s is None, s or ""))  # by code point, null last
    sizes = [found[s] for s in names]
    target = targets(sizes, weights(names))
    blocks = [-(-n // block) for n in sizes]
    slots = np.array([min(MOST_PASSES * b, round(t * b / n)) if n else 0 for n, b, t in zip(sizes, blocks, target, strict=True)], np.int64)
    counts = draw(slots, shards, seed) if len(slots) else np.zeros((shards, 0), np.int64)
    firsts = np.cumsum(counts, axis=0) - counts

    plan = spark.createDataFrame(
        [(s, i, n, t) for i, (s, n, t) in enumerate(zip(names, sizes, target, strict=True))],
        "source string, source_no int, source_size long, target double").withColumn("source", F.col("source").cast(rows.schema["source"].dataType))
    drawn = spark.createDataFrame(
        [(k, i, blocks[i], int(firsts[k, i]), int(counts[k, i])) for k in range(shards) for i in range(len(names)) if counts[k, i]],
        "shard int, source_no int, blocks long, first long, n long")

    @F.pandas_udf("long")
    def block_of(slot: pd.Series, number: pd.Series, source: pd.Series) -> pd.Series:
        n = number.to_numpy()
        key = source.to_numpy().astype(np.int64) * 1_000_003 + slot.to_numpy() // n * 7919 + seed
        return pd.Series(permuted(slot.to_numpy() % n, n, key))

    runs = drawn.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SLOT_RUN}"))))
    # slots by the million are made from few small rows: the rows are dealt to as many tasks beforehand
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(slots.sum()) // 1_000_000 + 1)
    runs = runs.repartition(tasks, "shard", "source_no", "run").select(
        "shard", "source_no", "blocks", (F.col("first") + F.col("run") * SLOT_RUN).alias("from"),
        F.least(F.lit(SLOT_RUN).cast("long"), F.col("n") - F.col("run") * SLOT_RUN).alias("n"))
    filled = runs.select("shard", "source_no", "blocks", F.explode(F.expr("sequence(`from`, `from` + n - 1)")).alias("slot"))
    filled = filled.select("shard", "source_no", "slot", block_of("slot", "blocks", "source_no").alias("block"))
    times = filled.groupBy("source_no", "block").agg(F.count("*").alias("times"))

    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cells.select("source", "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
               .join(plan, cells["source"].eqNullSafe(plan["source"]))
               .select(cells["source"].alias("cell_source"), F.col("cell").alias("cell_no"), "offset", "source_no", "source_size", "target"))
    inner = Window.partitionBy("source", "cell").orderBy("doc_id", "mark")
    placed = (rows.withColumn("number", F.row_number().over(inner))
              .withColumn("end", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
              .join(offsets, rows["source"].eqNullSafe(F.col("cell_source")) & (F.col("cell") == F.col("cell_no")))
              .select("doc_id", "mark", "source", "cell", "number", "size", "source_no", "source_size", "target",
                      (F.col("offset") + F.col("end") - F.col("size")).alias("start")))
    return placed, times


def _cut(placed: DataFrame, times: DataFrame, block: int) -> DataFrame:
    """``placed`` with one row for each block that a document's words stand in (none: one row without a block)."""
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    low = F.greatest(F.col("start"), F.col("block") * block) - F.col("start")
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.col("start")
    # a planner that sees the few rows that slots are made from would take their table for small and broadcast it
    return (pieces.withColumns({"low": low, "high": high}).join(times.hint("merge"), ["source_no", "block"], "left")
            .withColumn("times", F.coalesce("times", F.lit(0).cast("long"))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=cycling_weights,
        block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 20) -> DataFrame:
    """How many words of each document the mix takes.

    Per row: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target`` (words wanted of its source), ``taken`` (words that
    the mix takes, repeats counted; at most ``MOST_PASSES`` times the size).  ``weights`` gives the weights of the sources in
    code point order, null last (null is a source of its own).  Null, empty and blank texts have no words: size and taken are 0.  Repeated
    rows each have words of their own.  The result depends on the rows and ``seed`` alone, not on their order.  An empty table
    gives an empty result.  Other columns are not read."""
    short_batches(docs.sparkSession, 10_000)
    placed, times = _takes(docs, id_col, text_col, source_col, weights, block, shards, seed)
    return (_cut(placed, times, block)
            .groupBy("doc_id", "mark", "source", "cell", "number", "size", "source_size", "target")
            .agg(F.coalesce(F.sum((F.col("high") - F.col("low")) * F.col("times")), F.lit(0)).cast("long").alias("taken"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=cycling_weights,
                block: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 20) -> DataFrame:
    """The mix itself: ``docs`` with each row once for every pass that takes words of it, ``text_col`` holding those words.

    The words of pass p are those of the blocks taken p times or more, in the document's order, with the white space
    between them as it was (one space where blocks were left out).  A document that is taken whole keeps its text in the first
    pass.  Rows without words are not taken.  See ``mix`` for nulls, repeats and empty tables."""
    import re

    placed, times = _takes(docs, id_col, text_col, source_col, weights, block, shards, seed)
    runs = (_cut(placed, times, block).filter("times > 0").groupBy("doc_id", "mark", "cell", "number")
            .agg(F.sort_array(F.collect_list(F.struct("low", "high", "times"))).alias("runs")))  # as many as the document's own blocks
    copies = Window.partitionBy("doc_id", "mark").orderBy("number")
    runs = runs.select("doc_id", "mark", F.row_number().over(copies).alias("copy"), "runs")
    columns = docs.columns
    whole = docs.select(*_row_key(docs, id_col, text_col, source_col), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    whole = whole.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("doc_id")))
    # copies of a row are alike: the n-th one here stands for the n-th one there
    word = re.compile(r"[^\x20\x09-\x0D]+")

    @F.pandas_udf("array<string>")
    def passes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, taken in batches:
            out = []
            for text, parts in zip(texts, taken, strict=True):
                spans = [m.span() for m in word.finditer(text)]
                found = []
                for p in range(1, MOST_PASSES + 1):
                    kept: list[list[int]] = []
                    for x in parts:
                        if x["times"] >= p:
                            if kept and kept[-1][1] == x["low"]:
                                kept[-1][1] = x["high"]
                            else:
                                kept.append([x["low"], x["high"]])
                    if kept == [[0, len(spans)]] and p == 1:
                        found.append(text)
                    elif kept:
                        found.append(" ".join(text[spans[a][0]:spans[b - 1][1]] for a, b in kept))
                out.append(found)
            yield pd.Series(out, dtype=object)

    short_batches(docs.sparkSession)
    joined = whole.join(runs, (whole["doc_id"].eqNullSafe(runs["doc_id"])) & (whole["mark"] == runs["mark"]) & (whole["copy"] == runs["copy"])).select("row", "runs")
    out = joined.withColumn("mixed", F.explode(passes(F.col(f"row.`{text_col}`"), F.col("runs"))))
    return out.select(*[F.col("mixed").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns])
