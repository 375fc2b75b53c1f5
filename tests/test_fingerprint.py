"""Person fingerprint against a brute-force model on a small fixture."""

import hashlib

from claimwise.operators import fingerprint as FP
from conftest import rows


BASE = [("p1", "1950-02-03", "", "2"), ("p1", "1949-12-31", "bad", "1"), ("p2", "", "", ""),
        ("p3", "xx", "2010-01-01", "W")]
REGION = [("p1", "01001"), ("p1", "09999"), ("p1", ""), ("p2", "999999"), ("p4", "05000")]
ICD = [("p1", 2011, "B1"), ("p1", 2010, "C2"), ("p1", 2010, "A0"), ("p1", 2010, "A0"), ("p3", 2012, "Z9")]
PZN = [("p1", 2010, "00000002"), ("p2", 2011, "00000001"), ("p2", 2011, "00000001"), ("p2", 2011, "00000001")]


def model():
    out = {}
    for pid in sorted({b[0] for b in BASE}):
        dobs = [b[1] for b in BASE if b[0] == pid and len(b[1]) == 10 and b[1][4] == "-"]
        dods = [b[2] for b in BASE if b[0] == pid and len(b[2]) == 10 and b[2][4] == "-"]
        gs = [b[3][:1] for b in BASE if b[0] == pid and b[3] and b[3][:1] < "9"]
        ks = [r[1] for r in REGION if r[0] == pid and r[1]]
        mins = [k for k in ks if k < "999999"]
        maxs = [k for k in ks if k > "000000"]

        def toks(rows_):
            return "_".join(code for _, code in sorted((y, code) for p, y, code in rows_ if p == pid))

        text = "_".join([min(dobs) if dobs else "1900-01-01", min(dods) if dods else "2999-12-31",
                         min(gs) if gs else "0", min(mins) if mins else "00000", max(maxs) if maxs else "00000",
                         toks(ICD) or "0000", toks(PZN) or "00000000"])
        out[pid] = (text, hashlib.sha256(text.encode()).hexdigest())
    return out


def frames(spark):
    b = spark.createDataFrame(BASE, "pid string, geburtsdatum string, sterbedatum string, geschlecht string")
    r = spark.createDataFrame(REGION, "pid string, kgs string")
    i = spark.createDataFrame(ICD, "pid string, bezugsjahr int, code string")
    p = spark.createDataFrame(PZN, "pid string, bezugsjahr int, code string")
    return b, r, i, p


def test_canonical_text_and_hash(spark):
    want = model()
    got = {r["pid"]: r["text"] for r in FP.canonical_text(*frames(spark)).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    assert got["p1"] == "1949-12-31_2999-12-31_1_01001_09999_A0_A0_C2_B1_00000002"
    fps = {r["pid"]: r["fingerprint"] for r in FP.fingerprints(*frames(spark)).collect()}
    assert fps == {k: v[1] for k, v in want.items()}


def test_only_base_persons(spark):
    got = {r["pid"] for r in FP.fingerprints(*frames(spark)).collect()}
    assert got == {"p1", "p2", "p3"}


def test_sentinel_union(spark):
    b, r, i, p = frames(spark)
    out = FP.codes_with_sentinel(i, FP.person_base(b))
    assert sorted(tuple(x) for x in out.collect()) == [
        ("p1", "A0"), ("p1", "B1"), ("p1", "C2"), ("p2", "0000"), ("p3", "Z9")]


def test_the_year_does_not_separate_equal_lists(spark):
    base = spark.createDataFrame([("a", "", "", ""), ("b", "", "", "")], "pid string, geburtsdatum string, sterbedatum string, geschlecht string")
    codes = spark.createDataFrame([("a", 2010, "A"), ("a", 2011, "A"), ("b", 2010, "A"), ("b", 2010, "A")], "pid string, bezugsjahr int, code string")
    none = spark.createDataFrame([], "pid string, kgs string")
    prints = {r["pid"]: r["fingerprint"] for r in FP.fingerprints(base, none, codes, codes).collect()}
    assert prints["a"] == prints["b"]


def yearly(spark):
    base = spark.createDataFrame([
        ("1", "1950-01-01", "", "2x", 2015), ("1", "1949-05-05", "2017-01-01", "1", 2016), ("2", "bad", "", "", 2016), ("3", "1960-02-02", "", "W", 2017)],
        "pid string, geburtsdatum string, sterbedatum string, geschlecht string, bezugsjahr int")
    region = spark.createDataFrame([("1", "00123", 2016), ("1", "99999", 2015), ("2", "", 2015), ("2", "1234567", 2017), ("9", "00001", 2015)],
                                   "pid string, kgs string, bezugsjahr int")
    icd = spark.createDataFrame([("1", "B", 2016), ("1", "A", 2016), ("1", "C", 2015), ("1", "A", 2016), ("2", "Z", 2017), ("9", "A", 2015)], "pid string, code string, bezugsjahr int")
    pzn = spark.createDataFrame([("3", "7", 2017), ("3", "7", 2015), ("1", "5", 2017)], "pid string, code string, bezugsjahr int")
    return base, region, icd, pzn


def test_years_added_give_the_fingerprints_from_scratch(spark, tmp_path):
    frames, path = yearly(spark), str(tmp_path / "states")
    whole = rows(FP.fingerprints(*frames))
    assert rows(FP.merged_fingerprints(FP.year_states(*frames))) == whole and len(whole) == 3
    FP.add_years(*frames, [2015, 2016], path)
    early = [df.filter("bezugsjahr < 2017") for df in frames]
    assert rows(FP.merged_fingerprints(spark.read.parquet(path))) == rows(FP.fingerprints(*early))
    FP.add_years(*frames, [2017], path)
    assert rows(FP.merged_fingerprints(spark.read.parquet(path))) == whole
    late = [df.filter("bezugsjahr > 2015") for df in frames]
    assert rows(FP.merged_fingerprints(spark.read.parquet(path), 2016, 2017)) == rows(FP.fingerprints(*late))


def test_a_year_is_replaced_and_the_others_stay(spark, tmp_path):
    frames, path = yearly(spark), str(tmp_path / "states")
    FP.add_years(*frames, [2015, 2016, 2017], path)
    other = [frames[0], frames[1], frames[2].replace("B", "Q", "code"), frames[3]]
    FP.add_years(*other, [2016], path)
    assert rows(FP.merged_fingerprints(spark.read.parquet(path))) == rows(FP.fingerprints(*other)) != rows(FP.fingerprints(*frames))
