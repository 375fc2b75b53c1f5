import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import HARD, make  # noqa: F401
from pyspark.sql import functions as F

from claimwise.llm import langid
from claimwise.llm.common import crc_remainder

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = docs.filter(crc_remainder(F.col("doc_id"), 3) != 1)
    return docs, langid.fit(learned, F.col("lang"), F.col("text"), F.col("doc_id"), VOCABULARY)


def test_held_out_accuracy(fitted):
    docs, model = fitted
    got = langid.predict(docs.filter(crc_remainder(F.col("doc_id"), 3) == 1), model).select("lang", "language.*").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_hard_rows(fitted, make):
    _, model = fitted
    got = {(r.doc_id): r.language for r in langid.predict(make(HARD), model).collect()}
    for i in (1, 2, 3, 10):  # null, empty, blank, no letter
        assert tuple(got[i]) == ("und", 0.0, 0.0, 0)
    assert got[4] == got[5] and got[7].lang_pred in model.langs and all(0 <= v.score <= 1 for v in got.values())
    assert langid.predict(make([]), model).count() == 0


def test_nothing_to_learn_from(make):
    docs = make([(1, "abc", None), (2, None, "en")])
    model = langid.fit(docs, F.col("lang"), F.col("text"), F.col("doc_id"), VOCABULARY)
    assert [tuple(r.language) for r in langid.predict(docs, model).collect()] == [("und", 0.0, 0.0, 0)] * 2


def segmentations(word, pieces, prob):
    """Sum over all cuts of a word into pieces, one by one."""
    if not word:
        return np.ones(prob.shape[1])
    total = np.zeros(prob.shape[1])
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            total = total + prob[pieces[word[:n]]] * segmentations(word[n:], pieces, prob)
        elif n == 1:
            total = total + prob[-1] * segmentations(word[1:], pieces, prob)
    return total


def test_forward_sums_all_segmentations():
    pieces = [langid.MARK, langid.MARK + "a", "a", "b", "ab", "ba", "bab", "abab"]
    table, prob = langid.Pieces(pieces), np.random.default_rng(0).random((len(pieces) + 1, 3))
    words = ["a", "ab", "abab", "babab", "aab", "axb", "é"]
    got = np.exp(table.forward(words, prob))
    numbers = {p: i for i, p in enumerate(pieces)}
    assert got == pytest.approx(np.array([segmentations(langid.MARK + w, numbers, prob) for w in words]))


def test_expected_counts_are_the_derivative():
    pieces = [langid.MARK, langid.MARK + "a", "a", "b", "ab", "ba", "bab"]
    table, prob = langid.Pieces(pieces), np.random.default_rng(1).random((len(pieces) + 1, 1))
    words, weight = ["abab", "babab", "a"], np.array([2.0, 1.0, 3.0])
    got = table.expected(words, weight, prob)
    for i in range(len(pieces)):
        up = prob.copy()
        up[i] *= 1 + 1e-6
        slope = (weight @ (table.forward(words, up) - table.forward(words, prob))[:, 0]) / 1e-6
        assert got[i] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def test_long_words_are_summed_whole(monkeypatch):
    """One by one in logarithms gives what the plain sums give, over block borders too, and longer words do not vanish."""
    rng = np.random.default_rng(3)
    pieces = [langid.MARK, langid.MARK + "a", "a", "b", "ab", "ba", "bab", "abab"]
    table, prob = langid.Pieces(pieces), rng.random((len(pieces) + 1, 3)) / 5
    words = ["".join(rng.choice(list("abxé"), n)) for n in (1, 2, 7, 30, 39, 40)]
    weight = rng.random(len(words))
    plain, counts = table.forward(words, prob), table.expected(words, weight, prob[:, :1])
    numbers = {p: i for i, p in enumerate(pieces)}
    assert np.exp(plain[:3]) == pytest.approx(np.array([segmentations(langid.MARK + w, numbers, prob) for w in words[:3]]))
    for block in (langid.LONG_BLOCK, 3):
        monkeypatch.setattr(langid, "PLAIN_CHARS", 0)
        monkeypatch.setattr(langid, "LONG_BLOCK", block)
        assert table.forward(words, prob) == pytest.approx(plain)
        assert table.expected(words, weight, prob[:, :1]) == pytest.approx(counts)
    monkeypatch.undo()
    long = "".join(rng.choice(list("ab"), 5000))
    whole = table.forward([long, long[:2500]], prob)
    assert np.isfinite(whole).all() and (whole[0] < whole[1]).all()


def test_words_of_a_text():
    assert langid.split_words("The 3 cats, l'été!\nA_b") == ["the", "cats", "l", "été", "a", "b"]
    long = "x" * 101
    assert langid.split_words(long) == [long] and langid.split_words(None) == []


def test_clashing_columns(fitted, make):
    _, model = fitted
    docs = make(HARD)
    clash = docs.withColumns({c: F.lit("x") for c in ("lang_pred", "score", "fit", "word", "n", "key")})
    got = [sorted((r.doc_id, tuple(r.language)) for r in langid.predict(x, model).collect()) for x in (docs, clash)]
    assert got[0] == got[1]
