"""Ranked lexical search by the Best Position Algorithm over impact lists.

1. One pass over the documents counts the terms of each (all of them for its length, those of the items for the index).  The
   statistics of the whole corpus (N, L, df) come from that index by aggregation.
2. Each task cuts its part of the index into shards.  A shard holds an impact list per term (documents by falling impact) and,
   for direct access, the postings by document.  For each item, positions of all its lists are read in turn; a document met for the first
   time is looked up in the item's other lists at once (direct access), which gives its whole score and marks its positions there as seen.
   The best position of a list is the end of its run of seen positions from the top, wherever they were seen from; a document not seen
   yet can have no more than the impacts there add up to.  Reading stops once that sum lies strictly below the k-th score.
3. The tasks' k best documents per item meet in one window; at most k rows of an item leave a task.

Items are taken in blocks, whose terms and statistics are all that is broadcast or comes to the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimwise.llm.common import short_batches, stored

#: Bytes that end a term become blanks, A-Z become a-z; bytes of characters beyond ASCII stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: An item block ends at so many items or bytes of their texts; a shard at so many documents or postings.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4_000_000
SHARD_DOCS, SHARD_POSTINGS = 8_192, 2_000_000
#: Positions read from each list in the first round; twice as many in each further one.
DEPTH = 16


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists and postings by document of some documents; ``impacts`` belongs to the postings (document, term)."""

    def __init__(self, sizes: np.ndarray, ids: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.from_doc = np.concatenate([[0], np.cumsum(sizes)])
        self.ids, self.by_doc = ids, impacts
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((doc, -impacts, ids))
        self.docs, self.impacts = doc[order], impacts[order]
        self.from_term = np.searchsorted(ids[order], np.arange(n_terms + 1))
        self.place = np.empty(len(order), np.int64)  # of a posting by document: its place among the lists
        self.place[order] = np.arange(len(order))

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: for some documents, which of them and which posting, pair by pair."""
        sizes = self.from_doc[docs + 1] - self.from_doc[docs]
        which = np.repeat(np.arange(len(docs)), sizes)
        at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.from_doc[docs], sizes)
        return which, at

    def search(self, item: dict[int, int], k: int, bar: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents seen and their scores until no unseen one can have a score of ``bar`` or of the k-th seen; positions read."""
        times = np.zeros(len(self.from_term) - 1, np.int64)
        times[list(item)] = list(item.values())
        lists = [[t, self.from_term[t], self.from_term[t + 1]] for t in item if self.from_term[t] < self.from_term[t + 1]]  # term, next, end
        best = {t: start - 1 for t, start, _ in lists}
        seen_at, seen_doc = np.zeros(len(self.docs), bool), np.zeros(len(self.from_doc) - 1, bool)
        found: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        depth, read = DEPTH, 0
        while lists:
            met = [self.docs[at:min(at + depth, end)] for _, at, end in lists]
            read += sum(map(len, met))
            new = np.unique(np.concatenate(met))
            new = new[~seen_doc[new]]
            seen_doc[new] = True
            which, at = self.postings(new)
            of = times[self.ids[at]]
            which, at, of = which[of > 0], at[of > 0], of[of > 0]
            seen_at[self.place[at]] = True
            found.append(new)
            total = np.zeros(len(new), np.int64)
            np.add.at(total, which, of * self.by_doc[at])
            scores.append(total)
            bound, rest = 0, []
            for t, next_, end in lists:
                ahead = seen_at[best[t] + 1:end]
                best[t] += len(ahead) if ahead.all() else int(ahead.argmin())
                if best[t] + 1 < end:
                    bound += int(times[t] * self.impacts[best[t]])
                    rest.append([t, max(next_ + depth, best[t] + 1), end])  # what is seen needs no reading
            lists = rest
            depth *= 2
            so_far = np.concatenate(scores)
            kth = int(np.partition(so_far, -k)[-k]) if len(so_far) >= k else 0
            if bound < max(kth, bar):
                break
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found]), np.concatenate([none, *scores]), read


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), ids and tfs of the terms in the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                n.append(len(words))
                counts = Counter(filter(of.__contains__, words))
                ids.append([of[w] for w in counts])
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["doc_id", "n", "ids", "tfs"])

    return stored(docs.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<int>"), "bpa-index")


def _tops(index: DataFrame, items: list[dict[int, int]], weights: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """item (number), doc_id, score: of each task the k best documents of every item."""
    spread = index.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = spread.value
        none = np.zeros(0, np.int64)
        tops = [(none, none, none)] * len(items)  # scores, ids, without an id

        def taken(shard: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(shard)
            ids, n = t["doc_id"], t["n"].to_numpy()
            unnamed = ids.is_null().to_numpy().astype(np.int64)
            ids = ids.fill_null(0).to_numpy()
            flat = [t[c].combine_chunks() for c in ("ids", "tfs")]
            sizes = flat[0].value_lengths().to_numpy()
            word, tf = (x.flatten().to_numpy().astype(np.int64) for x in flat)
            m = np.repeat(75 + 25 * n * n_docs // max(length, 1), sizes)
            lists = Shard(sizes, word, weights[word] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m)), len(weights))
            for i, item in enumerate(items):
                old = tops[i]
                docs, scores, _ = lists.search(item, k, int(old[0][-1]) if len(old[0]) == k else 0)
                docs, scores = docs[scores > 0], scores[scores > 0]
                both = [np.concatenate(x) for x in zip(old, (scores, ids[docs], unnamed[docs]), strict=True)]
                first = np.lexsort((both[1], both[2], -both[0]))[:k]
                tops[i] = tuple(x[first] for x in both)

        shard: list[pa.RecordBatch] = []
        docs = postings = 0
        for batch in batches:
            shard.append(batch)
            docs, postings = docs + batch.num_rows, postings + len(batch.column(2).flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                taken(shard)
                shard, docs, postings = [], 0, 0
        if docs:
            taken(shard)
        at = np.repeat(np.arange(len(items)), [len(x[0]) for x in tops])
        scores, ids, unnamed = (np.concatenate([none, *[x[j] for x in tops]]) for j in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids, mask=unnamed > 0), pa.array(scores)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """For each item its ``k`` documents of the highest scores above 0: item_id, rank (from 1), doc_id, score; ties by smaller id.

    Terms are maximal runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII, in whole texts.  A term that df of N documents
    hold weighs floor(1000 ln((2 N + 2) / (2 df + 1))); a document of n terms has m = 75 + 25 n N div L; its score adds weight *
    (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included.

    Null, empty and other texts without terms: such documents are not counted and never found, such items have no rows.  Each row of
    ``docs`` is a document, repeated rows too; one without an id counts, and stands after those with ids of equal score.
    Repeated rows of an item count once; different texts under one item_id are ranked each by itself.  Empty tables give
    no rows.  Other columns are not read."""
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`"))
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _blocks(items.distinct()):
        counted = [Counter(terms(text)) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
        index = _index(docs, vocabulary)
        total = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        df = dict(index.select(F.explode("ids").alias("id")).groupBy("id").count().collect())  # the block's terms at most
        weights = np.array([weight(total["n_docs"], df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        coded = [{vocabulary[t]: c for t, c in x.items() if weights[vocabulary[t]] > 0} for x in counted]
        tops = _tops(index, coded, weights, total["n_docs"], total["length"], k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = tops.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item long, item_id {kind}")
        out = out.unionAll(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
