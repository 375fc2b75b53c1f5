import hashlib
import random

from llm_fixtures import HARD, make, sample  # noqa: F401
from pyspark.sql import functions as F

from claimwise.llm import ctph


def brute(rows):
    """Walk all rows in id order on one machine."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], r[1]))
    out = []
    for n, (i, t) in enumerate(rows):
        new = ctph.edited(t, rows[(n + 1) % len(rows)][1])
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), ctph.fingerprint(t), ctph.fingerprint(new)))
    return sorted(out)


def test_hard_rows_match_a_walk_over_all_rows(make):
    got = ctph.compare_with_edits(make(HARD))
    assert sorted(tuple(r)[:5] for r in got.collect()) == brute([r[:2] for r in HARD])


def test_many_partitions_and_borders(spark, make):
    rng = random.Random(3)
    rows = [(rng.randrange(10**9), " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(40)))) for _ in range(300)]
    got = ctph.compare_with_edits(make(rows).repartition(17))
    assert sorted(tuple(r)[:5] for r in got.collect()) == brute(rows)


def test_one_row_and_empty_table(make):
    (r,) = ctph.compare_with_edits(make([(4, "abcdefgh")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0
    assert ctph.compare_with_edits(make([])).count() == 0


def test_hash_of_chunks_is_the_plain_recurrence():
    import numpy as np

    values = np.random.default_rng(0).integers(1, 257, 9001).astype(np.uint64)
    h, x = ctph._horner(values), 0
    for i in (0, 1, 4095, 4096, 4097, 9000):
        x = 0
        for v in values[:i].tolist():
            x = (x * int(ctph.MULTIPLIER) + v) % 2**64
        assert int(h[i]) == x


def test_edits_stay_near_and_other_texts_far(spark, sample):
    texts = [t for t in sample["text"] if len(t) > 500][:60]
    rows = [(ctph.fingerprint(t), ctph.fingerprint(ctph.edited(t, texts[(i + 1) % len(texts)])), ctph.fingerprint(texts[i - 7])) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = df.select(ctph.likeness(F.col("a"), F.col("b")).alias("near"), ctph.likeness(F.col("a"), F.col("c")).alias("far"), ctph.likeness(F.col("a"), F.col("a")).alias("same")).toPandas()
    assert (got["same"] == 1).all() and got["near"].between(0, 1).all() and got["near"].median() > 0.6
    assert got["far"].median() < 0.2


def test_likeness_levels(spark):
    cases = [("3:abcd:ab", "3:abxd:ab", 1.0), ("3:abcd:ab", "4:ab:x", 1.0), ("4:ab:x", "3:abcd:ac", 0.5), ("3:abcd:ab", "6:ab:a", 0.0), ("0::", "0::", 1.0), ("0::", "0:a:a", 0.0)]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    assert [r[0] for r in df.select(ctph.likeness(F.col("a"), F.col("b"))).collect()] == [c[2] for c in cases]


def test_fingerprints_keep_columns(make):
    out = ctph.fingerprints(make([(1, "same"), (2, "same"), (3, None)]))
    got = {r.doc_id: r.fingerprint for r in out.collect()}
    assert got[1] == got[2] and got[3] == "0::" and out.columns[:2] == ["doc_id", "text"]
    assert len(ctph.fingerprint("a" * 200_000)) < 200  # one byte's repeats have no boundaries, or all of them


WORD64 = 2**64


def plain_mix(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> 33)) * factor % WORD64
    return x ^ (x >> 33)


def plain_fingerprint(text):
    """The method byte by byte: rolling hash over seven bytes, cuts by trailing zeros, a character a chunk at two block sizes."""
    data = [b + 1 for b in (text or "").encode()]
    if not data:
        return "0::"
    levels = []
    for i in range(len(data)):
        h = plain_mix(sum(data[i - k] * pow(0x100000001B3, k + 1, WORD64) for k in range(min(7, i + 1))) % WORD64)
        levels.append((h & -h).bit_length() - 1 if h else 48)
    levels[-1] = 99  # the last chunk ends with the text
    k = next(k for k in range(100) if sum(x >= k for x in levels) <= 64)

    def signature(level):
        out, chunk = "", []
        for b, x in zip(data, levels, strict=True):
            chunk.append(b)
            if x >= level:
                value = 0
                for c in chunk:
                    value = (value * 0x5851F42D4C957F2D + c) % WORD64
                out += "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[plain_mix(value ^ len(chunk)) >> 58]
                chunk = []
        return out

    return f"{k}:{signature(k)}:{signature(k + 1)}"


def plain_likeness(a, b):
    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, d in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    if a == b:
        return 1.0
    (ka, *sa), (kb, *sb) = a.split(":"), b.split(":")
    common = {int(ka) + i: s for i, s in enumerate(sa)}
    scores = [0.0]
    for i, s in enumerate(sb):
        other = common.get(int(kb) + i)
        if other is not None and max(len(s), len(other)):
            scores.append(1 - distance(s, other) / max(len(s), len(other)))
    return max(scores)


def test_fingerprints_and_likeness_against_the_plain_method(make, sample):
    rows = [(i, t) for i, t in zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True) if len(t) < 4000][:40]
    rows += [(10**6 + i, t) for i, t in enumerate(["", "a", "abc", "é\U0001f600" * 9, "word " * 300, None])]
    walk = [(i, t or "") for i, t in sorted(rows)]
    expected = []
    for n, (i, t) in enumerate(walk):
        following = walk[(n + 1) % len(walk)][1]
        q = len(t) // 4
        new = t[:len(t) - q] + following[:q]
        a, b, c = map(plain_fingerprint, (t, new, following))
        expected.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, plain_likeness(a, b), plain_likeness(a, c)))
    docs = make(rows)
    got = sorted(map(tuple, ctph.compare_with_edits(docs).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [x for r in got for x in r[5:]] == [round(x, 12) or 0.0 for r in expected for x in r[5:]] or all(
        abs(x - y) < 1e-12 for r, e in zip(got, expected, strict=True) for x, y in zip(r[5:], e[5:], strict=True))
    clash = docs.withColumns({c: F.lit("x") for c in ("task", "head", "tail", "fingerprint", "next_fingerprint", "end", "edited_sha256")})
    assert sorted(map(tuple, ctph.compare_with_edits(clash).collect())) == got


def test_rows_without_id_come_first(make):
    got = ctph.compare_with_edits(make([(2, "efgh" * 9), (None, "abcd" * 9)])).collect()
    new = {r.doc_id: r.edited_sha256 for r in got}
    assert new[None] == hashlib.sha256(("abcd" * 9)[:27].encode() + b"efghefghe").hexdigest() and new[2] == hashlib.sha256(("efgh" * 9)[:27].encode() + b"abcdabcda").hexdigest()
