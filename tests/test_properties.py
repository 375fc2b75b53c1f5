"""Property tests: scalar helpers against plain-Python models (one Spark job per example list)."""

import re

from hypothesis import given, settings, HealthCheck, strategies as st

from claimwise.functions import scalars as S

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(alphabet=st.characters(min_codepoint=0, max_codepoint=0x2030), max_size=12)


def java_trim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def java_parse_int(s):
    if not re.fullmatch(r"[+-]?[0-9]+", s or ""):
        return None
    v = int(s)
    return v if -2**31 <= v < 2**31 else None


def region_model(s):
    s = s or ""
    if len(s) < 2:
        return ""
    sub = java_parse_int(s[:2])
    for code, members in S.MAIN_REGION_GROUPS:
        if sub in members:
            return code
    return ""


def evaluate(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=60))
def test_clean_value(spark, values):
    want = [java_trim((v or "").replace(";", "_").replace('"', "")) for v in values]
    assert evaluate(spark, values, S.clean_value("v")) == want


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789", min_size=1, max_size=14), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=12))
def test_pad_zeros(spark, values, n):
    assert evaluate(spark, values, S.pad_zeros("v", n)) == [v.rjust(n, "0") for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.text(alphabet="+-0123456789 x", max_size=12),
                          st.integers(-2**33, 2**33).map(str)), min_size=1, max_size=60))
def test_strict_int(spark, values):
    assert evaluate(spark, values, S.strict_int("v")) == [java_parse_int(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789+-a", max_size=6)), min_size=1, max_size=80))
def test_main_region(spark, values):
    assert evaluate(spark, values, S.main_region("v")) == [region_model(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1900, 2100), st.integers(1, 4)), min_size=1, max_size=40))
def test_quarter_index_roundtrip(spark, pairs):
    df = spark.createDataFrame([(i, y, q) for i, (y, q) in enumerate(pairs)], "i int, y int, q int")
    idx = S.quarter_index("y", "q")
    got = [tuple(r) for r in df.orderBy("i").select(S.year_of_index(idx), S.quarter_of_index(idx), idx).collect()]
    assert got == [(y, q, y * 4 + q - 1) for y, q in pairs]
