from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import HARD, make  # noqa: F401
from hypothesis import given
from hypothesis import strategies as st

from claimwise.llm import mixing


def words(text):
    return len((text or "").encode().split())


def test_every_source_meets_its_target(make):
    rows = [(i, "w " * (20 + i % 90), "en", [None, "a", "b", "c", "é", "hot", "hot", "hot"][i % 8]) for i in range(600)]
    got = mixing.mix(make(rows)).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(r.source_size == size[r.source] for r in got) and len(got) == 600
    names = ["a", "b", "c", "hot", "é", None]  # code points, null last
    expected = mixing.targets([size[n] for n in names], [1, 2, 3, 1, 2, 3])
    assert [target[n] for n in names] == pytest.approx(expected) and sum(expected) == pytest.approx(sum(size.values()))
    assert all(abs(taken[n] - target[n]) <= mixing.BLOCK_WORDS for n in names)


def test_reruns_agree_whatever_the_order_of_rows(make):
    rows = [(i, "a b c d e f g " * (i % 40), "en", "st"[i % 2]) for i in range(200)]
    one = sorted((r.doc_id, r.taken) for r in mixing.mix(make(rows)).collect())
    two = sorted((r.doc_id, r.taken) for r in mixing.mix(make(rows[::-1]).repartition(7)).collect())
    assert one == two


def test_hard_rows_and_empty_table(make):
    got = mixing.mix(make(HARD)).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, words(t)) for i, t, *_ in HARD)
    assert mixing.mix(make([])).count() == 0 and mixing.mixed_texts(make([])).count() == 0
    assert mixing.mix(make([(1, None), (2, "")])).collect()[0].taken == 0


def test_texts_hold_the_words_that_the_counts_say(make):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(30 + 7 * i % 200)) + "  \n end", "en", "xyz"[i % 3]) for i in range(90)]
    rows += rows[:3]  # repeated rows have words of their own
    docs = make(rows)
    taken = defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns
    found, text = defaultdict(int), {r[0]: r[1] for r in rows}
    for r in out.collect():
        found[r.doc_id] += words(r.text)
        assert set(r.text.split()) <= set(text[r.doc_id].split())
        if words(r.text) == words(text[r.doc_id]):
            assert r.text.split() == text[r.doc_id].split()
    assert {k: v for k, v in taken.items() if v} == dict(found)


@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(n, key):
    got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key))
    assert sorted(got.tolist()) == list(range(n))


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=30))
def test_targets(sizes):
    weights = mixing.cycling_weights([str(i) for i in sizes])
    got = mixing.targets(sizes, weights)
    assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-6 * s for t, s in zip(got, sizes, strict=True))
    free = [(t, w) for t, s, w in zip(got, sizes, weights, strict=True) if t < 3 * s * (1 - 1e-9)]
    assert all(t / w == pytest.approx(free[0][0] / free[0][1]) for t, w in free)


@given(st.lists(st.integers(0, 5000), min_size=1, max_size=12), st.integers(1, 40))
def test_draws_add_up(slots, shards):
    got = mixing.draw(np.array(slots), shards, 3)
    assert (got >= 0).all() and got.sum(axis=0).tolist() == slots
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 1


def plain_permutation(index, size, key):
    """Four Feistel rounds on the next even number of bits, walked until inside, one number at a time."""
    half, mask = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2), 2**64 - 1
    x = index
    while True:
        a, b = x >> half, x & ((1 << half) - 1)
        for r in range(4):
            f = ((b + r + 1) * 0x9E3779B97F4A7C15 + key * 0xD1B54A32D192ED03) & mask
            f = ((f ^ (f >> 29)) * 0xBF58476D1CE4E5B9) & mask
            a, b = b, a ^ ((f ^ (f >> 32)) & ((1 << half) - 1))
        x = a << half | b
        if x < size:
            return x


def test_taken_words_against_blocks_filled_by_hand(make):
    from pyspark.sql import functions as F

    rows = [(i, " ".join(["w"] * (3 + i * 13 % 70)), "en", [None, "a", "b", "é", "b", "b"][i % 6]) for i in range(90)] + [(None, "x y z", "en", "a"), (7, None, "en", "a")]
    docs, block, shards, seed = make(rows), 8, 5, 20
    got = sorted(((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(docs, block=block, shards=shards, seed=seed).collect()), key=str)
    mark = F.xxhash64("text", "source")
    places = docs.select("doc_id", "source", "text", mark.alias("mark"), F.pmod(F.xxhash64("doc_id", mark), F.lit(mixing.CELLS)).alias("cell")).collect()
    names = sorted({r.source for r in places}, key=lambda s: (s is None, s or ""))
    laid = {s: sorted((r for r in places if r.source == s), key=lambda r: (r.cell, r.doc_id is not None, r.doc_id or 0, r.mark)) for s in names}
    sizes = [sum(words(r.text) for r in laid[s]) for s in names]
    blocks = [-(-n // block) for n in sizes]
    wanted = mixing.targets(sizes, mixing.cycling_weights(names))
    slots = [min(3 * b, round(t * b / n)) for n, b, t in zip(sizes, blocks, wanted, strict=True)]
    counts = mixing.draw(np.array(slots), shards, seed)
    expected = []
    for i, s in enumerate(names):
        times, slot = defaultdict(int), 0
        for shard in range(shards):
            for _ in range(int(counts[shard, i])):
                n = blocks[i]
                times[plain_permutation(slot % n, n, i * 1_000_003 + slot // n * 7919 + seed)] += 1
                slot += 1
        at = 0
        for r in laid[s]:
            n = words(r.text)
            expected.append((r.doc_id, s, n, sum(times[w // block] for w in range(at, at + n))))
            at += n
    assert got == sorted(expected, key=str)
    clash = docs.withColumns({c: F.lit("x") for c in ("mark", "cell", "size", "block", "slot", "times", "start", "end", "number", "target")})
    assert sorted(((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix(clash, block=block, shards=shards, seed=seed).collect()), key=str) == got
