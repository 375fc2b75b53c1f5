"""Interaction of quality filters: which filter removes what, in every order of application.

1. A global dictionary encodes words: the code of a word is its 64-bit hash under a seed, and the table of all distinct (code, word)
   pairs, gathered over the whole corpus, proves that no two words share a code (else the next seed is tried).
2. Each task builds shards of the sparse document-term matrix in compressed rows (``CsrShard``).  The sum of a row is a
   document's number of words, its nonzero entries are its distinct words; they decide filters A and B.
3. The other flags are attached, and documents are counted by (part, set of failed filters).  Those counts, at most 32 a part,
   give the result of every order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import short_batches, stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
#: Words that a task remembers at once, while it looks for distinct ones.
HELD = 300_000


class Codes(dict):
    """word -> code under a seed, remembered up to a bound."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return code


@dataclass(frozen=True)
class CsrShard:
    """Rows of the document-term matrix: row ``i`` holds ``data`` (counts) at the columns ``indices`` (codes), both from
    ``indptr[i]`` to ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], codes: Codes) -> CsrShard:
        indptr, indices, data = [0], [], []
        for text in texts:
            words = text.split()
            columns = np.sort(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)))
            first = np.flatnonzero(np.concatenate([[True], columns[1:] != columns[:-1]])) if words else np.zeros(0, np.int64)
            indices.append(columns[first])
            data.append(np.diff(first, append=len(words)))
            indptr.append(indptr[-1] + len(first))
        return cls(np.array(indptr), np.concatenate(indices or [np.zeros(0, np.uint64)]), np.concatenate(data or [np.zeros(0, np.int64)]))

    def row_sums(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.data)])
        return total[self.indptr[1:]] - total[self.indptr[:-1]]

    def nonzeros(self) -> np.ndarray:
        return np.diff(self.indptr)


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def dictionary(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """All distinct words of the table as (code, word), and the seed under which their codes are distinct."""
    short_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{text_col}`"))
    seed = 0
    while True:
        def distinct(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()

            def out() -> pa.RecordBatch:
                words = list(seen)
                codes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
                return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(words, pa.binary())], ["code", "word"])

            for batch in batches:
                for text in batch.column(0):
                    seen.update(_bytes(text.as_py()).split())
                    if len(seen) > HELD:
                        yield out()
                        seen.clear()
            if seen:
                yield out()

        words = stored(texts.mapInArrow(distinct, "code long, word binary").distinct(), "audit-words")
        if words.groupBy("code").count().filter("count > 1").limit(1).isEmpty():
            return words, seed
        seed += 1


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: doc_id, part, ``n_words``, ``n_distinct`` and ``fails`` (bit 0: filter A ... bit 4: filter E).

    Words: maximal runs without ASCII white space, case-sensitive.  A: under 100 words.  B: 100 distinct < 80 words.  C: 100
    times A-Z > 10 times the code points.  D: holds one of ``#$%&*|``.  E: the text is that of a smaller doc_id.
    Null text: empty.  Null part: empty string.  A row without an id never fails E and never makes another fail it; of
    repeated rows with one id none fails E by the others.  Other columns are not read."""
    _, seed = dictionary(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(seed)
        for batch in batches:
            strings = batch.column(2).to_pylist()
            texts = [_bytes(t) for t in strings]
            shard = CsrShard.of(texts, codes)
            words, distinct = shard.row_sums(), shard.nonzeros()
            capitals = np.array([len(b) - len(b.translate(None, CAPITALS)) for b in texts], np.int64)
            points = np.array([len(t or "") for t in strings], np.int64)
            symbols = np.array([len(b) != len(b.translate(None, SYMBOLS)) for b in texts], bool)
            flags = (words < 100) | (100 * distinct < 80 * words) << 1 | (100 * capitals > 10 * points) << 2 | symbols << 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(distinct, pa.int64()), pa.array(flags.astype(np.int32)),
                 pa.array([hashlib.sha256(b).digest() for b in texts], pa.binary())],
                ["doc_id", "part", "n_words", "n_distinct", "flags", "digest"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text_col}`"))
    rows = stored(rows.mapInArrow(run, "doc_id long, part string, n_words long, n_distinct long, flags int, digest binary"), "audit-flags")
    # a table of its own: a text that a third of the rows share is then split by the join, which an aggregate right below it would prevent
    first = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).filter("copies > 1").drop("copies"), "audit-first")
    return (rows.join(first, "digest", "left")
            .select("doc_id", "part", "n_words", "n_distinct", (F.col("flags") + F.when(F.col("doc_id") > F.col("least"), 16).otherwise(0)).alias("fails")))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """One row per part, order of the five filters (all 120) and step, zeros included.

    Counts of documents of the part: ``kept`` after the step, ``removed`` by it, ``redundant`` (fails this filter, removed
    before), ``unique_fails`` (fails only this filter), ``good_lost`` and ``toxic_lost`` (removed here with label 1), ``shapley`` (removed
    by this filter, summed over all orders).

    Every row of ``docs`` counts, repeated ones too.  Several label rows of an id count as one, 1 if any is 1; label rows without
    an id are not used.  An empty table gives no rows.  See ``failures`` for nulls."""
    label = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("doc_id")).agg(
        *[F.max((F.col(f"`{c}`") == 1).cast("long")).alias(n) for n, c in (("good", good_col), ("toxic", toxic_col))])
    sums = (failures(docs, id_col, text_col, part_col).join(label, "doc_id", "left").groupBy("part", "fails")
            .agg(F.count("*").alias("docs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]))
    by_part = sums.groupBy("part").agg(F.collect_list(F.struct("fails", "docs", "good", "toxic")).alias("sets"))  # at most 32

    def bits(letters: str) -> str:
        return " + ".join(f"if(contains({letters}, '{x}'), {1 << i}, 0)" for i, x in enumerate(FILTERS))

    def total(of: str, when: str) -> str:
        return f"aggregate(filter(sets, x -> {when}), 0L, (sum, x) -> sum + x.{of}) AS"

    orders = F.split(F.lit(",".join(ORDERS)), ",")
    steps = (by_part.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .selectExpr("*", "substr(filter_order, step, 1) AS letter", f"{bits('substr(filter_order, 1, step - 1)')} AS before")
             .selectExpr("*", f"{bits('letter')} AS bit"))
    here = "x.fails & before = 0 AND x.fails & bit > 0"
    out = steps.selectExpr(
        "part", "filter_order", "step", "letter", f"{total('docs', 'x.fails & (before | bit) = 0')} kept", f"{total('docs', here)} removed",
        f"{total('docs', 'x.fails & before > 0 AND x.fails & bit > 0')} redundant", f"{total('docs', 'x.fails = bit')} unique_fails",
        f"{total('good', here)} good_lost", f"{total('toxic', here)} toxic_lost")
    worth = out.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return out.join(worth, ["part", "letter"]).drop("letter")
