import re
from collections import Counter

from llm_fixtures import HARD, make, sample  # noqa: F401
from pyspark.sql import functions as F

from claimwise.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    n = Counter(windows)
    again = {p for i, x in enumerate(windows) if n[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), base)


def test_counts_match_brute_force(make, sample):
    rows = [r[:2] for r in HARD] + [(100 + i, t) for i, t in zip(sample["doc_id"].tolist(), sample["text"].tolist(), strict=True)]
    rows += [(900, "a b c d a b c"), (901, "a a a a"), (902, "x\n\nx\n x\ny\nx"), (903, "a b c " * 40), (904, "line one\n" * 30 + "#|<>")]
    got = quality_rules.judge(make(rows)).select("doc_id", "quality.*").collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted((i, *brute(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in got)


def test_clean_texts_stay_and_junk_goes(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.judge(docs.join(labels.withColumnRenamed("quality", "true"), "doc_id")).toPandas()
    kept = got["quality"].map(lambda q: q['kept'])
    long = got["quality"].map(lambda q: q['n_words'] >= 50)
    assert kept[(got["true"] == 1) & long].mean() > 0.99 and kept[got["true"] == 0].mean() < 0.02


def test_filters_stay_above_the_measurement_and_columns_stay(make):
    docs = make([(1, "word " * 60), (2, " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(60)))]).withColumns({c: F.lit(7) for c in ("words", "lines", "found", "row", "windows")})
    out = quality_rules.judge(docs).filter("quality.kept")
    assert out.columns == [*docs.columns, "quality"] and [r.doc_id for r in out.collect()] == [2]
    assert [r.words for r in out.collect()] == [7]


def test_empty_table(make):
    assert quality_rules.judge(make([])).count() == 0


def test_order_of_rules_follows_rejection_per_cost(make):
    rows = [(i, "some text " * 30) for i in range(60)]
    never, always = (quality_rules.Rule(n, F.lit(x) & (F.col("n_words") >= 0)) for n, x in (("never", False), ("always", True)))
    found = quality_rules.ordered(make(rows), "text", [never, always])
    assert [r.name for r, _, _ in found] == ["always", "never"] and found[0][1] == 1.0


def test_native_plan(spark, capsys):
    quality_rules.judge(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_clean_texts_of_scripts_without_case_stay(make):
    pieces = {  # vowel signs are marks, not letters
        "ar": "كتاب مدينة طريق شجرة بيت نهر جبل مدرسة", "he": "ספר עיר דרך עץ בית נהר הר מדרסה", "hi": "किताब नगर रास्ता पेड़ घर नदी पहाड़ विद्यालय",
        "ko": "책은 도시의 길에서 나무와 집을 강으로 산까지 학교"}
    rows = [(i, " ".join(f"{w}{v[(7 * k + j) % len(v)]}" for k in range(8) for j, w in enumerate(v)))
            for i, v in enumerate([x.split() for x in pieces.values()])]
    zh, th = ("".join(chr(0x4E00 + (37 * i) % 5000) for i in range(3600)), "".join(chr(0x0E01 + (7 * i + i // 46) % 46) for i in range(3600)))
    rows += [(10 + k, " ".join(t[60 * i:60 * i + 60] for i in range(60))) for k, t in enumerate((zh, th))]
    rows += [(20, " ".join(f"LOUD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(60))), (21, " ".join(chr(97 + i % 26) * 40 + str(i) for i in range(60)))]
    kept = {r.doc_id: r.quality.kept for r in quality_rules.judge(make(rows)).collect()}
    assert kept == {0: True, 1: True, 2: True, 3: True, 10: True, 11: True, 20: False, 21: False}


def kept_plainly(text):
    """Base and all eight rules over the text, in any order."""
    import unicodedata

    text = text or ""
    n, chars, symbols, dup, again, base = brute(text)
    if base:
        return False
    words, lines = WORD.findall(text), text.split("\n")

    def kind(*kinds):
        return sum(unicodedata.category(c).startswith(kinds) for c in text)

    return not (
        100 * symbols > 5 * chars or 100 * dup > 50 * len(lines) or chars > 25 * n or chars < 2 * n or 100 * sum(c in "!?" for c in text) > 8 * chars
        or 100 * kind("Lu") > 50 * kind("L") or 100 * sum(w == w.upper() != w.lower() for w in words) > 60 * n or 100 * kind("L", "M") < 50 * chars
        or 100 * again > 40 * n)


def test_verdicts_match_the_rules_one_by_one(make, sample):
    varied = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    texts = sample["text"].tolist() + [None, "", varied, varied.upper(), varied + "#" * 40, varied.replace(" ", "! ") + "!!!!", varied + " 12345678901234567890" * 40,
                                       "\n".join(["same line"] * 20 + [varied]), " ".join("a" for _ in range(3)) + " " + varied, " ".join(f"{i}" for i in range(90)),
                                       " ".join(f"w{'x' * 30}{i}" for i in range(60)), varied + " " + " ".join(["one two three"] * 12)]
    got = {r.doc_id: r.quality.kept for r in quality_rules.judge(make(list(enumerate(texts)))).collect()}
    assert got == {i: kept_plainly(t) for i, t in enumerate(texts)} and 20 < sum(got.values()) < len(texts)
