"""Comorbidity score (FIXTURES.md G7) and the LIKE pattern join against brute force."""

import fnmatch
import random

from claimwise.operators import score as SC
from conftest import rows


def facts(spark, data):
    # (quarter, year, class, weight)
    return spark.createDataFrame([("p1", "t", y, q, c, w, "108036123") for q, y, c, w in data],
                                 "pid string, source_table string, year int, quarter int, "
                                 "disease_class string, cci_weight int, h2ik string")


def window(spark, data, start_year=2010, end_year=2010, as_of="2015-06-30"):
    out = SC.sliding_scores(facts(spark, data), start_year, end_year, as_of)
    return {r["window_start"]: (r["window_end"], r["weight"]) for r in out.collect()}


def test_max_within_class(spark):
    w = window(spark, [(1, 2010, "a", 1), (2, 2010, "a", 2), (3, 2010, "a", 3), (4, 2010, "a", 4)])
    assert w["20100101"] == ("20101231", 4)


def test_sum_between_classes(spark):
    w = window(spark, [(1, 2010, "a", 1), (2, 2010, "a", 1), (3, 2010, "b", 2), (4, 2010, "b", 2)])
    assert w["20100101"] == ("20101231", 3)


def test_ignore_beyond_window(spark):
    w = window(spark, [(1, 2010, "a", 2), (2, 2010, "b", 2), (3, 2010, "a", 1), (4, 2010, "b", 1),
                       (1, 2011, "b", 3)])
    assert w["20100101"] == ("20101231", 4)
    # the window starting in Q2 contains 2011Q1
    assert w["20100401"] == ("20110331", 4)


def test_missing_quarters(spark):
    w = window(spark, [(1, 2010, "a", 2), (4, 2010, "b", 1)])
    assert w["20100101"] == ("20101231", 3)


def test_end_clamped_to_current_year(spark):
    w = window(spark, [(3, 2015, "a", 2), (4, 2015, "a", 2), (1, 2016, "b", 3), (2, 2016, "b", 3)],
               start_year=2015, end_year=2015, as_of="2015-06-30")
    assert w["20150701"] == ("20151231", 2)


def test_persons_without_facts_get_no_row(spark):
    w = window(spark, [(1, 2010, "a", 2)])
    assert set(w) == {"20100101"}


def like(code, pattern):
    # SQL LIKE with the appended '%', via fnmatch
    pat = pattern.replace("*", "[*]").replace("?", "[?]").replace("%", "*").replace("_", "?") + "*"
    return fnmatch.fnmatchcase(code, pat)


def test_pattern_join_equals_brute_force(spark):
    rnd = random.Random(3)
    alphabet = "ABN_1"
    codes = ["".join(rnd.choice("ABN1") for _ in range(rnd.randint(1, 5))) for _ in range(300)]
    pats = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 3))) for _ in range(30)}
                  | {"A%1", "B_"})
    f = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "id int, icd_code string")
    p = spark.createDataFrame([(x, "c" + x, len(x)) for x in pats],
                              "icd_code string, disease_class string, cci_weight int")
    got = rows(SC.pattern_join(f, p), "id", "pattern")
    want = sorted((i, x) for i, c in enumerate(codes) for x in pats if like(c, x))
    assert got == want


def test_window_score(spark):
    df = spark.createDataFrame([("p", "a", 1), ("p", "a", 3), ("p", "b", 2), ("q", "a", 1)],
                               "pid string, disease_class string, cci_weight int")
    assert rows(SC.window_score(df)) == [("p", 5), ("q", 1)]


def test_many_wildcard_patterns_take_the_same_path(spark, capsys):
    facts_ = spark.createDataFrame([("A12",), ("A92",), (None,)], "icd_code string")
    pats = spark.range(300).selectExpr("concat('A', id, '_') AS icd_code", "'c' AS disease_class", "1 AS cci_weight")
    got = SC.pattern_join(facts_, pats)
    assert rows(got, "icd_code", "pattern") == [("A12", "A1_"), ("A92", "A9_")]
    got.explain()
    assert "NestedLoop" not in capsys.readouterr().out



def test_parts_grow_with_the_facts_and_scores_stay(spark, monkeypatch):
    """Facts are dealt to parts of a bounded number of rows, and the scores do not depend on it."""
    data = [(f"p{i % 7}", "t", 2009 + i % 3, i % 4 + 1, "abc"[i % 3], i % 5, str(i % 2)) for i in range(400)] + [("hot", "t", 2010, 1, "a", 3, None)] * 100
    frame = spark.createDataFrame(data, "pid string, source_table string, year int, quarter int, disease_class string, cci_weight int, h2ik string").cache()
    whole = SC.sliding_scores(frame, 2009, 2011, "2015-06-30")
    monkeypatch.setattr(SC, "PART_ROWS", 50)
    dealt = SC.sliding_scores(frame, 2009, 2011, "2015-06-30")
    assert (whole.rdd.getNumPartitions(), dealt.rdd.getNumPartitions()) == (1, 10)
    assert sorted(map(str, whole.collect())) == sorted(map(str, dealt.collect()))
    assert {r["h2ik"] for r in dealt.filter("pid = 'hot'").collect()} == {None}


def test_facts_join_the_matches_where_they_are(spark, capsys):
    """Codes are few: parts by code would hold ever more facts."""
    data = spark.range(1000).selectExpr("concat('A', id % 9) AS icd_code", "id")
    pats = spark.createDataFrame([("A1", "a", 1), ("A%2", "b", 2)], "icd_code string, disease_class string, cci_weight int")
    out = SC.pattern_join(data, pats)
    out.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    assert out.count() == 222
