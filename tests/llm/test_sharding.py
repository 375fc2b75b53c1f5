import random
import zlib
from collections import defaultdict

import numpy as np
from llm_fixtures import HARD, make  # noqa: F401

from claimwise.llm import sharding


def verify(docs, rows, n):
    got = sharding.shard_contiguous(docs, n).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, shards_of, order = defaultdict(list), defaultdict(set), []
    text = defaultdict(list)
    for i, t in rows:
        text[i].append(t)
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        slots[r.shard].append(r.slot)
        t = text[r.doc_id][0]
        shards_of[t].add(r.shard)
        if not order or order[-1][0] != t:
            order.append([t, 0])
        order[-1][1] += r.size
        assert r.law == "bytes" and r.grown_shard is None
    assert len(order) == len(shards_of)  # each group of equal texts stands together
    assert all(len(s) == 1 for s in shards_of.values()) and all(s == list(range(len(s))) for s in slots.values())
    assert max(slots, default=0) < n
    sizes = [s for _, s in order]

    def shards(capacity):
        count, room = 0, 0
        for s in sizes:
            if s > room:
                count, room = count + 1, capacity
            room -= s
        return count

    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if shards(mid) <= n else (mid + 1, high)
    assert all(r.capacity == low for r in got)
    total = defaultdict(int)
    for r in got:
        total[r.shard] += r.size
    assert max(total.values(), default=0) == low
    return got


def test_hard_rows(make):
    verify(make(HARD), [r[:2] for r in HARD], 4)


def test_hot_group_and_many_small_ones(make, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "hot text" * 40) for i in range(300)] + [(1000 + i, "t" * rng.randrange(400)) for i in range(500)]
    rows += [(2000 + i, f"single {i} " * rng.randrange(1, 9)) for i in range(400)]
    monkeypatch.setattr(sharding, "KNOTS", 16)  # many rounds of refinement
    monkeypatch.setattr(sharding, "HASH_BITS", 3)
    verify(make(rows), rows, 24)


def test_fewer_groups_than_shards_and_empty_table(make):
    verify(make([(1, "a"), (2, "b")]), [(1, "a"), (2, "b")], 24)
    assert sharding.shard_contiguous(make([])).count() == 0


def test_clashing_columns(make):
    from pyspark.sql import functions as F

    docs = make([(1, "a"), (2, None)]).withColumns({c: F.lit(9) for c in ("size", "group", "cell", "shard", "slot", "bucket", "n")})
    assert sharding.shard_contiguous(docs, 2).count() == 2


def test_greedy_fill_over_borders():
    knots = np.array([3, 5, 9, 10])
    assert sharding._cuts(knots, 5, 2) == [5, 10] and sharding._cuts(knots, 4, 2) is None
    assert sharding._least(knots, 4, 2) == 5 and sharding._least(knots, 4, 3) == 4 or sharding._least(knots, 4, 3) == 5
