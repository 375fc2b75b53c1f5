"""Context-triggered piecewise hashing: document fingerprints that survive edits.

A rolling hash over seven bytes decides where a text is cut: at level k a cut follows every byte whose
hash has k zero bits, so a level's cuts are among those of the level below (block size 2^k).  Each chunk becomes one of
64 characters.  A fingerprint is ``k:signature at k:signature at k + 1``, with k the lowest level of at most
``CHUNKS`` chunks.  Two fingerprints are compared by the edit distance of signatures of the same block size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwise.llm.common import mixed, short_batches, stored

WINDOW = 7
CHUNKS = 64
LEVELS = 48
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
MULTIPLIER = np.uint64(0x5851F42D4C957F2D)


def _powers(n: int) -> np.ndarray:
    """MULTIPLIER ** 0 .. n - 1, modulo 2 ** 64."""
    out = np.full(n, MULTIPLIER, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _signature(prefix: np.ndarray, ends: np.ndarray) -> str:
    """One character per chunk; ``prefix`` holds the running Horner hash before each byte and after the last."""
    starts = np.concatenate(([0], ends[:-1]))
    sizes = ends - starts
    if not len(sizes):
        return ""
    value = prefix[ends] - prefix[starts] * _powers(int(sizes.max()) + 1)[sizes]
    return ALPHABET[(mixed(value ^ sizes.astype(np.uint64)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def _horner(values: np.ndarray) -> np.ndarray:
    """h[i + 1] = h[i] * MULTIPLIER + values[i], for all i at once in blocks."""
    n, block = len(values), 4096
    out = np.zeros(n + 1, np.uint64)
    powers = _powers(block + 1)
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    back = np.full(block, inverse, np.uint64)
    back = np.multiply.accumulate(back)  # MULTIPLIER ** -(i + 1)
    for at in range(0, n, block):
        part = values[at:at + block]
        m = len(part)
        out[at + 1:at + m + 1] = (out[at] + np.cumsum(part * back[:m])) * powers[1:m + 1]
    return out


def fingerprint(text: str | None) -> str:
    """Fingerprint of a whole text; of a null or empty one ``0::``."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(data)
    if not n:
        return "0::"
    rolling = np.zeros(n, np.uint64)
    for k in range(min(WINDOW, n)):
        rolling[k:] += data[:n - k] * np.uint64(0x100000001B3 ** (k + 1) & 0xFFFFFFFFFFFFFFFF)
    rolling = mixed(rolling)
    # level of each byte: the trailing zero bits of its hash
    lowest = rolling & (~rolling + np.uint64(1))
    level = np.where(rolling == 0, LEVELS, np.minimum(np.log2(np.maximum(lowest, 1).astype(np.float64)), LEVELS)).astype(np.int64)
    level[n - 1] = LEVELS + 1  # the last chunk ends with the text
    per_level = np.bincount(level, minlength=LEVELS + 2)
    chunks = per_level[::-1].cumsum()[::-1]  # chunks[k]: bytes of level k and above
    k = int(np.argmax(chunks <= CHUNKS))
    prefix = _horner(data)
    return f"{k}:{_signature(prefix, np.flatnonzero(level >= k) + 1)}:{_signature(prefix, np.flatnonzero(level >= min(k + 1, LEVELS + 1)) + 1)}"


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1: one less the edit distance over the longer signature's length, at a
    block size that both have; the better one if both have two in common, 0 if none.  Fingerprints of empty texts are alike
    only to each other.  Null with a null."""
    parts = [F.split(x, ":") for x in (a, b)]
    (la, a1, a2), (lb, b1, b2) = [(p[0].cast("int"), p[1], p[2]) for p in parts]

    def alike(x: Column, y: Column) -> Column:
        longer = F.greatest(F.char_length(x), F.char_length(y))
        return F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(x, y) / longer)

    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(a == b, F.lit(1.0))
            .when(la == lb, F.greatest(alike(a1, b1), alike(a2, b2)))
            .when(la == lb + 1, alike(a1, b2))
            .when(la + 1 == lb, alike(a2, b1))
            .otherwise(F.lit(0.0)))


def fingerprints(docs: DataFrame, text_col: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text_col`` in ``into``.  Null texts count as empty; equal texts have equal
    fingerprints; an empty table gives an empty result; other columns stay (one called ``into`` is replaced)."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py()) for t in texts], pa.string())

    short_batches(docs.sparkSession)
    return docs.withColumn(into, run(F.col(f"`{text_col}`")))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with their likeness.

    The edited text has its last quarter replaced by the start of the next document's (ascending id, after the last
    comes the first).  Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    Texts are dealt and sorted by id range once; each task walks its rows in order.  A task's last row needs the
    first text of the next task with rows: those two rows a task are kept with their texts, met by the tasks' numbers
    and finished in a second, small step.  Null texts count as empty, null ids come first, rows of one id follow each
    other by their texts; a single row is its own next one; an empty table gives an empty result."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # the tasks' first rows have head (the text), their last rows tail (the text) and no edited text yet
    schema = (f"doc_id {kind}, n_chars bigint, fingerprint string, edited_sha256 string, edited_fingerprint string, "
              "next_fingerprint string, task int, head string, tail string")

    def finish(text: str, following: str) -> tuple[str, str]:
        new = edited(text, following)
        return hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(new)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, first = TaskContext.get().partitionId(), None, True
        names = [c.split()[0] for c in schema.split(", ")]
        types = [None, pa.int64(), *[pa.string()] * 4, pa.int32(), pa.string(), pa.string()]

        def batch_of(rows_out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows_out, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t or ids_type) for c, t in zip(columns, types, strict=True)], names)

        ids_type = None
        for batch in batches:
            ids_type, out = batch.schema.field(0).type, []
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                now = (i.as_py(), t.as_py(), fingerprint(t.as_py()))
                if held is not None:
                    sha, new = finish(held[1], now[1])
                    out.append((held[0], len(held[1]), held[2], sha, new, now[2], task, held[1] if first else None, None))
                    first = False
                held = now
            yield batch_of(out)
        if held is not None:
            yield batch_of([(held[0], len(held[1]), held[2], None, None, None, task, held[1] if first else None, held[1])])

    walked = stored(rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(walk, schema), "ctph")
    # numbers of the tasks with rows: as many as tasks, in one window
    tasks = walked.filter(F.col("tail").isNotNull()).select("task")
    following = (tasks.withColumn("next_task", F.lead("task").over(Window.orderBy("task")))
                 .withColumn("next_task", F.coalesce("next_task", F.min("task").over(Window.partitionBy(F.lit(0))))))
    heads = walked.filter(F.col("head").isNotNull()).select(
        F.col("task").alias("next_task"), F.col("head").alias("next_head"), F.col("fingerprint").alias("head_fingerprint"))

    @F.pandas_udf("sha string, new string")
    def last(tails, next_heads):
        import pandas as pd

        return pd.DataFrame([finish(a, b) for a, b in zip(tails, next_heads, strict=True)], columns=["sha", "new"])

    ends = (walked.filter(F.col("tail").isNotNull()).join(following, "task").join(heads, "next_task")
            .withColumn("end", last("tail", "next_head"))
            .select("doc_id", "n_chars", F.col("end.sha").alias("edited_sha256"), "fingerprint",
                    F.col("end.new").alias("edited_fingerprint"), F.col("head_fingerprint").alias("next_fingerprint")))
    inner = walked.filter(F.col("tail").isNull()).select(*ends.columns)
    a, b, c = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return inner.unionAll(ends).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(a, b).alias("near_edited"), likeness(a, c).alias("near_next"))
