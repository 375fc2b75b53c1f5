import re
from itertools import permutations

import numpy as np
from llm_fixtures import HARD, make  # noqa: F401

from claimwise.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """(part, set of failed filters, id) of each row, plainly."""
    out = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        bad = set()
        if len(words) < 100:
            bad.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            bad.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            bad.add("C")
        if any(c in "#$%&*|" for c in text):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            bad.add("E")
        out.append((lang or "", bad, i))
    return out


def brute(rows, good=frozenset(), toxic=frozenset()):
    docs = failing(rows)
    out, worth = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [(bad, i) for p, bad, i in docs if p == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [(bad, i) for bad, i in left if f in bad]
                left = [(bad, i) for bad, i in left if f not in bad]
                worth[part, f] = worth.get((part, f), 0) + len(here)
                out[part, order, step] = (
                    len(left), len(here), sum(f in bad for bad, _ in gone), sum(p == part and bad == {f} for p, bad, _ in docs),
                    sum(i in good for _, i in here), sum(i in toxic for _, i in here))
                gone += here
    return {k: (*v, worth[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, docs, labels=()):
    table = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    got = A.audit(docs, table)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = got.collect()
    assert len(rows) == len({tuple(r)[:3] for r in rows})
    return {tuple(r)[:3]: tuple(r)[3:] for r in rows}


MIXED = [
    (20, "Alpha beta " * 60, "en"), (21, "Alpha beta " * 60, "de"), (22, " ".join(f"w{i}" for i in range(120)), "en"), (23, "LOUD & CLEAR", "en"),
    (24, "LOUD & CLEAR", "en"), (None, "LOUD & CLEAR", "en"), (None, None, ""), (25, "", None), (26, None, "de"), (27, " ".join(f"w{i}" for i in range(100)), "en"),
    (28, " ".join(["a"] * 20 + [f"v{i}" for i in range(79)]), "fr"), (28, "other | text", "fr"), (29, "ÀÉ " * 110, "fr"), (30, "AB 12345678901234567", "fr"), (31, "AB 1234567890123456", "fr")]


def test_against_brute_force(spark, make):  # noqa: F811
    rows = [*HARD, *MIXED]
    labels = [(20, 1, 0), (20, 0, 1), (23, 1, 0), (24, 1, 1), (None, 1, 1), (26, None, 1), (99, 1, 1), (6, 1, None)]
    assert run(spark, make(rows), labels) == brute(rows, {20, 23, 24, 6}, {20, 24, 26})


def test_words_that_share_a_code_get_other_codes(spark, make, monkeypatch):  # noqa: F811
    rows = [(1, "one two three " * 40, "en"), (2, " ".join(f"x{i}" for i in range(130)), "en")]
    real = A.xxhash.xxh3_64_intdigest

    class Clash:  # under seed 0 all words have one of two codes
        @staticmethod
        def xxh3_64_intdigest(word, seed):
            return real(word, seed) if seed else len(word) % 2

    words, seed = A.dictionary(make(rows))
    assert seed == 0 and words.count() == 133 == words.select("code").distinct().count()
    monkeypatch.setattr(A, "xxhash", Clash)
    words, seed = A.dictionary(make(rows))
    assert seed == 1 and words.count() == 133 == words.select("code").distinct().count()


def test_matrix_in_compressed_rows():
    texts = [b"b a b", b"", b" \t", b"c", b"A a"]
    codes = A.Codes(0)
    m = A.CsrShard.of(texts, codes)
    assert m.row_sums().tolist() == [3, 0, 0, 1, 2] and m.nonzeros().tolist() == [2, 0, 0, 1, 2]
    dense = [dict(zip(m.indices[a:b].tolist(), m.data[a:b].tolist(), strict=True)) for a, b in zip(m.indptr, m.indptr[1:])]
    assert dense == [{codes[b"a"]: 1, codes[b"b"]: 2}, {}, {}, {codes[b"c"]: 1}, {codes[b"A"]: 1, codes[b"a"]: 1}]
    empty = A.CsrShard.of([], codes)
    assert empty.row_sums().tolist() == [] and empty.nonzeros().tolist() == [] and empty.indices.dtype == np.uint64


def test_few_remembered_words_give_the_same(spark, make):  # noqa: F811
    codes = A.Codes(3)
    codes.update({bytes([65 + i]): i for i in range(10)})
    keep, A.HELD = A.HELD, 12
    try:
        first = codes[b"new"], codes[b"newer"], codes[b"newest"]
        assert len(codes) <= 12 and first == tuple(A.xxhash.xxh3_64_intdigest(w, 3) for w in (b"new", b"newer", b"newest"))
    finally:
        A.HELD = keep


def test_empty_tables_and_clashing_columns(spark, make):  # noqa: F811
    assert run(spark, make([])) == {}
    rows = MIXED[:6]
    clash = make(rows)
    for c in ("part", "fails", "docs", "bit", "digest", "code", "word", "copies", "step", "sets"):
        clash = clash.withColumn(c, clash["text"])
    labels = spark.createDataFrame([(23, 1, 1)], "doc_id long, quality int, toxic int").selectExpr("*", "1 AS good", "'x' AS part")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in A.audit(clash, labels).collect()}
    assert got == brute(rows, {23}, {23})
