import random
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import HARD, make  # noqa: F401

from claimwise.llm import minhash
from claimwise.llm.components import components


def groups(rows, k, percent):
    """Brute force: sets of shingles, all pairs, smallest id of each component."""
    sets = []
    for i, t in rows:
        w = t.encode().lower().split() if t else []
        n = min(k, len(w))
        sets.append((i, frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if w else frozenset()))
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    postings = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for x in s:
            postings[x].append(n)
    pairs = {(a, b) for p in postings.values() for b in p for a in p if a < b}
    for a, b in pairs:
        (i, x), (j, y) = sets[a], sets[b]
        both = len(x & y)
        if 100 * both >= percent * (len(x) + len(y) - both):
            up[max(root(i), root(j))] = min(root(i), root(j))
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def near_copies(n, seed, length=120, most=9):
    """A base text with up to ``most`` words replaced in each copy: some copies link to the base, some only to each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(length)] = f"e{rng.randrange(60)}" if rng.random() < 0.5 else f"u{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_a_large_group_of_near_copies_loses_no_link(make, k, percent):
    texts = near_copies(260, 1) + near_copies(40, 2, 60) + [f"alone {i} text {i * i}" for i in range(30)]
    texts += texts[:20] + [t.upper() for t in texts[20:30]]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    got = minhash.near_duplicates(make(rows), k=k, percent=percent)
    assert sorted(map(tuple, got.collect())) == groups(rows, k, percent)


def test_hard_rows(make):
    got = sorted(map(tuple, minhash.near_duplicates(make(HARD), k=3, percent=85).collect()))
    assert got == groups([r[:2] for r in HARD], 3, 85)
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got  # empty sets are linked with nothing


def test_rows_without_id_and_empty_table(make):
    got = minhash.near_duplicates(make([(None, "a b c"), (3, "a b c")]), k=3, percent=85)
    assert sorted(map(tuple, got.collect()), key=str) == [(3, 1, 3, True), (None, 1, 3, False)]
    assert minhash.near_duplicates(make([])).count() == 0
    assert minhash.deduplicated(make([])).count() == 0


def test_nothing_but_duplicates_is_lost(make):
    """Rows without an id and different texts under one id stay, unless they are duplicates of what is kept."""
    a, b, c = ("a b c d e f g h", "one two three four five six", "x y z x y z q")
    rows = [(None, a), (None, b), (4, c), (4, "quite another text under this id"), (7, a), (None, c), (None, None), (None, ""), (9, " "), (4, c), (None, b), (11, b + " ")]
    docs = make(rows)
    out = sorted(((r.doc_id, (r.text or "").strip()) for r in minhash.deduplicated(docs, k=3, percent=85).collect()), key=str)
    assert out == sorted([(7, a), (11, b), (4, c), (4, "quite another text under this id"), (None, ""), (None, ""), (9, "")], key=str)
    only = minhash.deduplicated(make([(None, a), (None, a), (None, a + " z"), (None, b)]), k=3, percent=50)
    assert sorted(r.text[:5] for r in only.collect()) == [a[:5], b[:5]]
    linked = {(r.doc_id, r.n_shingles): r.component_id for r in minhash.near_duplicates(docs, k=3, percent=85).collect()}
    assert linked[7, 6] == linked[None, 6] == 7


def test_bands_follow_the_threshold():
    for percent in (50, 80, 85, 95, 100):
        n = minhash.bands_for(percent)
        assert (1 - min(percent / 100, 1 - 1e-9) ** minhash.ROWS) ** n <= minhash.MISS and n * minhash.ROWS % minhash.BATCH == 0
    assert minhash.bands_for(85) == 25 and minhash.bands_for(80) == 35


def test_deduplicated_keeps_one_of_each_group_and_all_columns(make):
    rows = [(5, "a b c d e f g", "en", "s"), (2, "A b c d e f g", "de", "t"), (2, "A b c d e f g", "de", "t"), (9, "z", "fr", "u"), (10, None, "fr", "u")]
    docs = make(rows)
    out = minhash.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.lang) for r in out.collect()) == [(2, "de"), (9, "fr"), (10, "fr")]


def test_extra_and_clashing_columns(make):
    from pyspark.sql import functions as F

    docs = make([(1, "a b c d"), (2, "a b c d")]).withColumns({c: F.lit("x") for c in ("id", "digest", "component", "bucket", "hub", "kept", "copy")})
    assert sorted(map(tuple, minhash.near_duplicates(docs, k=3, percent=85).collect())) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert minhash.deduplicated(docs).columns == docs.columns


def test_bayesian_bounds():
    n = minhash.ROWS * minhash.bands_for(85)
    least = minhash.least_matches(85, n)
    assert list(least) == sorted(least) and least[0] < 0.85 * minhash.BATCH
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**32, (2000, n), dtype=np.uint32)
    for similarity, low, high in ((0.85, 0.999, 1.0), (0.4, 0.0, 0.01)):
        b = np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))
        assert low <= minhash.likely(a, b, 85).mean() <= high


def test_signatures_estimate_similarity():
    words = minhash.WordHashes()
    x = minhash.shingles(" ".join(f"a{i}" for i in range(3000)), 3, words)
    y = minhash.shingles(" ".join(f"a{i}" for i in range(600, 3000)), 3, words)
    assert abs((minhash.signature(x, 25) == minhash.signature(y, 25)).mean() - len(y) / len(x)) < 0.15
    assert len(minhash.shingles("one two", 3, words)) == 1 and not len(minhash.shingles(None, 3, words))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(159, 200), (7, 7), (5, 4), (300, 250)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {i: 0 for i in range(41)} | {i: 100 for i in [*range(100, 160), 200]} | {250: 250, 300: 250}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
