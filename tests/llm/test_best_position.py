import math
import re
from collections import Counter

import numpy as np
from llm_fixtures import HARD, make, sample  # noqa: F401

from claimwise.llm import best_position as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(plain_terms(t))) for i, t, *_ in docs]
    n_docs, length = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in counts:
            score = 0
            for t in plain_terms(text):
                if tf := c.get(t):
                    m = 100 - 25 + (25 * c.total() * n_docs) // length
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if no else i, -s) for rank, (s, no, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k=20):
    table = spark.createDataFrame(list(items), "item_id long, text string")
    got = B.search(docs, table, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


ITEMS = [(1, "one Two one"), (2, None), (3, ""), (4, " !? "), (5, "a b c zz"), (6, "word x"), (7, "É é́ nul"), (8, "absent"), (1, "one Two one"), (9, "ok 123 one two a")]


def test_terms_are_those_of_the_pattern():
    for text in [None, "", "A-b_C1 éÀ中 x y\x7fz", "".join(map(chr, range(0, 0x250))), "tab\tnew\nline"]:
        assert [t.decode() for t in B.terms(text)] == plain_terms(text)


def test_hard_rows(spark, make):  # noqa: F811
    rows = [*HARD, (None, "one two", "en"), (None, "one", "en"), (40, "one two", "en"), (41, "TWO one", "en")]
    assert found(spark, make(rows), ITEMS) == brute(rows, ITEMS)
    assert found(spark, make(rows), ITEMS, k=2) == brute(rows, ITEMS, 2)


def test_given_tables_in_small_shards_and_blocks(spark, make, sample, monkeypatch):  # noqa: F811
    rows = list(zip(sample["doc_id"], sample["text"], strict=True))
    items = [(int(r[0]), r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(rows, items)
    assert len(want) > 100
    assert found(spark, make(rows), items) == want
    monkeypatch.setattr(B, "SHARD_DOCS", 7)
    monkeypatch.setattr(B, "BLOCK_ITEMS", 5)
    assert found(spark, make(rows).repartition(2), items[:12]) == brute(rows, items[:12])


def random_shard(rng, n_docs, n_terms):
    table = rng.random((n_docs, n_terms)) < rng.random(n_terms) * 0.6
    impacts = np.where(table, rng.integers(1, 30, table.shape) ** 3, 0)
    doc, ids = np.nonzero(table)
    return impacts, B.Shard(table.sum(axis=1), ids.astype(np.int64), impacts[doc, ids].astype(np.int64), n_terms)


def test_no_document_that_counts_is_left_out():
    rng = np.random.default_rng(3)
    early = 0
    for _ in range(300):
        n_docs, n_terms = int(rng.integers(1, 400)), int(rng.integers(1, 9))
        impacts, shard = random_shard(rng, n_docs, n_terms)
        item = {int(t): int(rng.integers(1, 3)) for t in rng.permutation(n_terms)[:int(rng.integers(1, n_terms + 1))]}
        whole = impacts[:, list(item)] @ np.array(list(item.values()))
        k = int(rng.integers(1, 30))
        docs, scores, _ = shard.search(item, k)
        assert len(set(docs.tolist())) == len(docs) and (scores == whole[docs]).all()
        kth = np.sort(whole)[-k] if n_docs >= k else 0
        assert set(np.flatnonzero((whole >= max(kth, 1)))) <= set(docs.tolist())  # ties at the k-th score too
        early += len(docs) < np.count_nonzero(whole)
        bar = int(np.sort(whole)[-1])
        docs, _, _ = shard.search(item, k, bar)
        assert set(np.flatnonzero(whole >= max(bar, 1))) <= set(docs.tolist())
    assert early > 30  # it does stop


def test_best_positions_pass_what_direct_access_has_seen(monkeypatch):
    """Two lists of equal order: all that is read in one has been seen in the other, so best positions run ahead of reading."""
    monkeypatch.setattr(B, "DEPTH", 1)
    n = 64
    impact = np.repeat(np.arange(n, 0, -1) ** 2, 2)
    shard = B.Shard(np.full(n, 2), np.tile([0, 1], n), impact.astype(np.int64), 2)
    docs, scores, read = shard.search({0: 1, 1: 1}, 3)
    assert set(range(3)) <= set(docs.tolist()) and len(docs) < 10 and read < 20


def test_empty_tables_and_clashing_columns(spark, make):  # noqa: F811
    assert found(spark, make([]), ITEMS) == []
    assert found(spark, make(HARD), []) == []
    docs = make(HARD)
    for c in ("n", "ids", "tfs", "item", "item_id", "score", "rank", "count"):
        docs = docs.withColumn(c, docs["text"])
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "1 AS score")
    assert sorted(map(tuple, B.search(docs, items).collect()), key=str) == brute(HARD, ITEMS)
