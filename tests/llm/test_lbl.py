import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import HARD, make, sample  # noqa: F401
from pyspark.sql import functions as F

from claimwise.llm import lbl
from claimwise.llm.common import crc_remainder


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def brute(rows):
    train = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        out.append((i, zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(x in train for x in w), n, base))
    return sorted(out)


def run(docs):
    return lbl.score(docs, crc_remainder(F.col("doc_id"), 7) != 2)


def check(got, expected):
    got = sorted(tuple(r) for r in got.collect())
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected], rel=1e-9)
    return got


def test_rare_words_meet_the_table_of_counts(make, sample, monkeypatch):
    """With a small head most words are counted by the join; the counts, base scores and the gain stay."""
    rows = list(zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True))
    monkeypatch.setattr(lbl, "HEAD", 200)  # on the driver, which makes the vocabulary
    monkeypatch.setattr(lbl, "COUNTED", 300)
    got = check(run(make(rows)), brute(rows))
    words = lbl.read_vocabulary(lbl.token_counts(make(rows), "text"))
    assert words.own <= 200 < words.held <= 300 < words.distinct
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_score_is_the_product_of_class_and_word(make, sample):
    """The score of a text, added up token by token from full softmax sums."""
    rows = list(zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True))[:60]
    docs = make(rows)
    learned = docs.filter(crc_remainder(F.col("doc_id"), 7) != 2)
    v = lbl.read_vocabulary(lbl.token_counts(learned, "text"))
    named = docs.withColumn("held_out", crc_remainder(F.col("doc_id"), 7) == 2).select("doc_id", "held_out", "text")
    p = lbl.Parameters(v)
    p.load(lbl.train(lbl.coded(named, v).filter(~F.col("held_out")).select("h", "classes"), v))
    counts = dict(zip([w.encode() for w in v.words], v.counts, strict=True))
    got = {r.doc_id: r.score for r in run(docs).collect()}
    for i, text in rows[:12]:
        before, total = [b"", b""], 0.0
        for w in tokens(text):
            classes = [int(v.class_of[v.lookup()[x]]) for x in (*before, w)]
            h = sum(p.context[c].astype(float) * p.place[k] for k, c in enumerate(classes[1::-1]))
            g = int(v.group_of[classes[2]])
            all_groups = np.exp(p.group.astype(float) @ h + p.group_bias)
            inside = np.exp(p.target[v.first[g]:v.first[g + 1]].astype(float) @ h + p.bias[v.first[g]:v.first[g + 1]])
            total += math.log10(all_groups[g] / all_groups.sum() * inside[classes[2] - v.first[g]] / inside.sum())
            if classes[2] >= v.own:
                total += math.log10(counts.get(w, 0) + 1) - v.inside[classes[2] - v.own]
            before = [before[1], w]
        assert got[i] == pytest.approx(total, rel=1e-4)


def test_counts_and_base_match_brute_force(make):
    got = check(run(make(HARD)), brute([r[:2] for r in HARD]))
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)


def test_model_beats_the_base_on_held_out_texts(make, sample):
    rows = list(zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True))
    got = check(run(make(rows)), brute(rows))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the base where it has not learned


def small_vocabulary(counts):
    head = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    n, k = np.zeros(lbl.SUFFIXES), np.zeros(lbl.SUFFIXES)
    for w, c in head[lbl.WORDS:]:
        n[lbl.suffix_class(w) - lbl.WORDS] += c
        k[lbl.suffix_class(w) - lbl.WORDS] += 1
    return lbl.Vocabulary([w.decode() for w, _ in head], [c for _, c in head], sum(counts.values()), len(counts), n, k)


def test_probabilities_sum_to_one(sample):
    counts = Counter(w for t in sample["text"] for w in tokens(t))
    v = small_vocabulary(counts)
    p = lbl.Parameters(v)
    p.target = np.random.default_rng(1).normal(0, 1, p.target.shape).astype(np.float32)
    scorer = lbl.Scorer(v, p.rows())
    everything = np.arange(p.n)
    for a, b in ((0, 0), (5, 300), (p.n - 1, 2)):
        total = 10 ** scorer(np.tile([a, b], (p.n, 1)), everything)
        assert total.sum() == pytest.approx(1, rel=1e-3)
    # inside a suffix class: its words and one unseen
    lookup, inside = v.lookup(), Counter()
    for w, n in counts.items():
        c = int(v.class_of[lookup[w]]) - lbl.WORDS
        if c >= 0:
            inside[c] += (n + 1) / 10 ** v.inside[c]
    assert len(inside) > 5 and all(x + 1 / 10 ** v.inside[c] == pytest.approx(1) for c, x in inside.items())


def test_training_lowers_the_surprise(sample):
    counts = Counter(w for t in sample["text"] for w in tokens(t))
    v = small_vocabulary(counts)
    lookup = v.lookup()
    texts = [tokens(t) for t in sample["text"]]
    ends = np.cumsum([len(t) for t in texts])
    classes = v.class_of[[lookup[w] for t in texts for w in t]]
    contexts = lbl.contexts_of(classes, ends, int(v.class_of[lookup[b""]]))
    p = lbl.Parameters(v)
    before = lbl.Scorer(v, p.rows())(contexts, classes).mean()
    trainer = lbl.Trainer(p, v, 5)
    order = np.random.default_rng(0).permutation(len(classes))
    for _ in range(2):
        for at in range(0, len(order), 1024):
            trainer.step(contexts[order[at:at + 1024]], classes[order[at:at + 1024]])
    assert lbl.Scorer(v, p.rows())(contexts, classes).mean() > before + 0.03


def test_contexts_stop_at_text_borders():
    got = lbl.contexts_of(np.array([1, 2, 9, 3, 9]), np.array([3, 5]), 9)
    assert got.tolist() == [[9, 9], [1, 9], [2, 1], [9, 9], [3, 9]]


def test_head_stays_within_its_bound(make, monkeypatch):
    monkeypatch.setattr(lbl, "COUNTED", 3)
    table = lbl.token_counts(make([(1, "a a a b b c d"), (2, "a b e")]), "text")
    assert lbl.read_vocabulary(table).words == ["a", "b", ""] and lbl.read_vocabulary(table).distinct == 6
    monkeypatch.setattr(lbl, "COUNTED", 2)
    even = lbl.token_counts(make([(1, "a b c")]), "text")
    assert lbl.read_vocabulary(even).words == []


def test_no_training_rows_and_empty_table(make):
    got = lbl.score(make([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in got] == [(True, 0, 0, 0.0)] * 2
    assert run(make([])).count() == 0


def test_classes_grow_with_the_vocabulary(make):
    rows = [(i, " ".join(f"w{(i * 97 + j) % 3000}" for j in range(120))) for i in range(200)]
    v = lbl.read_vocabulary(lbl.token_counts(make(rows), "text"))
    p = lbl.Parameters(v)
    assert v.own == len(v.words) == v.distinct == 3001 and p.n > 3001 and p.groups >= 50  # every held word has vectors of its own
    assert len({int(v.class_of[v.lookup()[w.encode()]]) for w in v.words}) == 3001
    wide = lbl.read_vocabulary(lbl.token_counts(make([(i, " ".join(f"u{i}x{j}" for j in range(200))) for i in range(100)]), "text"))
    assert wide.suffixes > v.suffixes >= lbl.SUFFIXES
    scorer = lbl.Scorer(v, np.random.default_rng(2).normal(0, 1, p.rows().shape))
    assert (10 ** scorer(np.tile([2999, 1500], (p.n, 1)), np.arange(p.n))).sum() == pytest.approx(1, rel=1e-3)


def test_scores_do_not_depend_on_the_partitions(make, sample, monkeypatch):
    monkeypatch.setattr(lbl, "PART", 6000)  # on the driver, which deals the texts: several parts
    rows = list(zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True))
    one, many = ({r.doc_id: r.score for r in run(make(rows).repartition(n)).collect()} for n in (1, 40))
    assert one.keys() == many.keys() and [one[i] for i in one] == pytest.approx([many[i] for i in one], rel=1e-5)


def test_clashing_columns_and_rows_without_id(make):
    rows = [(i, f"alpha beta gamma {i % 3} delta") for i in range(30)] + [(None, "alpha beta"), (None, None)]
    docs = make(rows)
    training = F.coalesce(crc_remainder(F.col("doc_id"), 7), F.lit(0)) != 2
    got = sorted(map(str, map(tuple, lbl.score(docs, training).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens").collect())))
    assert len(got) == 32 and any(x.startswith("(None, False, 3") for x in got)
    clash = docs.withColumns({c: F.lit("x") for c in ("h", "row", "held_out", "word", "c", "classes", "rare", "own", "part", "round")})
    assert sorted(map(str, map(tuple, lbl.score(clash, training).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens").collect()))) == got


def test_sums_that_overflow_or_vanish_are_computed_again():
    rng = np.random.default_rng(6)
    left, right = rng.normal(0, 1, (40, 5)).astype(np.float32), rng.uniform(0.5, 2, (5, 30)).astype(np.float32)
    left[3], left[4], left[5] = 90, -90, 0
    exact = left.astype(float) @ right.astype(float)
    top = exact.max(axis=1)
    expected = top + np.log(np.exp(exact - top[:, None]).sum(axis=1))
    assert lbl.log_sums(left @ right, left, right) == pytest.approx(expected, rel=1e-4, abs=1e-3)
    assert expected.max() > 150 and expected.min() < -150


def test_tokens_of_odd_texts():
    texts = [None, "", " ", "  a  B ", "a", "\x0b\x0c", "\u00c9 a b\x1cc\x00 d\t", "A\r\nB\x85c", "\u00a0x", "\u2003y z"]
    bounds, words = lbl.tokens_of(pa.array(texts))
    words = [w.as_py().encode() for w in words]
    assert [words[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] == [tokens(t) for t in texts]


def test_few_exponentials_for_contexts_that_repeat(sample, monkeypatch):
    """Groups cost an exponential per class and place, not per context; classes of a group one per context, not per token."""
    v = small_vocabulary(Counter(w for t in sample["text"] for w in tokens(t)))
    p = lbl.Parameters(v)
    rng = np.random.default_rng(4)
    p.target, p.group = rng.normal(0, 1, p.target.shape).astype(np.float32), rng.normal(0, 1, p.group.shape).astype(np.float32)
    p.group[0], p.group[1], p.context[100], p.context[101] = 9, -9, 9, -9  # 100 and 101 favour other groups, so strongly that products of shares vanish
    scorer = lbl.Scorer(v, p.rows())
    contexts = rng.integers(0, 60, (40_000, 2))
    contexts[:2] = (100, 101), (101, 100)
    classes = rng.integers(0, p.n, len(contexts))
    exp, taken = np.exp, []
    monkeypatch.setattr(lbl.np, "exp", lambda x, **out: (taken.append(np.size(x)), exp(x, **out))[1])
    got = scorer(contexts, classes)
    monkeypatch.undo()
    pairs = np.unique(np.column_stack((contexts, v.group_of[classes])), axis=0)[:, 2]
    assert sum(taken) < np.diff(v.first)[pairs].sum() + 600 * p.groups  # before: once per token, and 3,600 contexts
    hidden = sum(p.context[contexts[:, i]].astype(float) * p.place[i] for i in range(2))
    for j in range(200):
        g = v.group_of[classes[j]]
        logs = []
        for z, own in ((p.group.astype(float) @ hidden[j] + p.group_bias, g),
                       (p.target[v.first[g]:v.first[g + 1]].astype(float) @ hidden[j] + p.bias[v.first[g]:v.first[g + 1]], classes[j] - v.first[g])):
            logs.append(z[own] - z.max() - np.log(exp(z - z.max()).sum()))
        assert got[j] == pytest.approx(sum(logs) / math.log(10), rel=1e-4, abs=1e-3)
