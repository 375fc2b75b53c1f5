"""Overview and regional ratios (FIXTURES.md G5, G6)."""

from pyspark.sql import functions as F

from claimwise.operators import stats
from claimwise.operators import stats as ST
from conftest import rows


def padded(counts, lower, upper):
    return stats.overview({"x": counts}, lower, upper).select("year", "quarter", "cnt")


def counts(spark, data):
    return spark.createDataFrame(data, "year int, quarter int, cnt long")


def ratios(df):
    return [r["ratio"] for r in df.orderBy("year", "quarter").collect()]


def test_year_on_year(spark):
    c = counts(spark, [(2010, 1, 100), (2010, 2, 200), (2010, 3, 300), (2010, 4, 400),
                       (2011, 1, 200), (2011, 2, 400), (2011, 3, 1500), (2011, 4, 1200)])
    out = stats.year_on_year(padded(c, 2010, 2011))
    assert ratios(out) == [0.0, 0.0, 0.0, 0.0, 2.0, 2.0, 5.0, 3.0]
    flags = [r["out_of_tolerance"] for r in out.orderBy("year", "quarter").collect()]
    assert flags == [False] * 4 + [True, True, True, True]


def test_padding_single_point(spark):
    out = stats.year_on_year(padded(counts(spark, [(2010, 1, 5)]), 2010, 2010))
    assert rows(out, "year", "quarter", "cnt", "ratio") == [
        (2010, 1, 5, 0.0), (2010, 2, 0, 0.0), (2010, 3, 0, 0.0), (2010, 4, 0, 0.0)]


def test_zero_previous_year(spark):
    c = counts(spark, [(2010, q, 0) for q in (1, 2, 3, 4)] + [(2011, q, 7) for q in (1, 2, 3, 4)])
    assert ratios(stats.year_on_year(padded(c, 2010, 2011))) == [0.0] * 8


def test_gap_keeps_following_points(spark):
    # a gap in the middle must not shift the later points
    c = counts(spark, [(2010, 1, 10), (2010, 3, 30), (2011, 1, 20), (2011, 3, 90)])
    out = padded(c, 2010, 2011)
    assert rows(out, "year", "quarter", "cnt") == [
        (2010, 1, 10), (2010, 2, 0), (2010, 3, 30), (2010, 4, 0),
        (2011, 1, 20), (2011, 2, 0), (2011, 3, 90), (2011, 4, 0)]
    assert ratios(stats.year_on_year(out)) == [0.0, 0.0, 0.0, 0.0, 2.0, 0.0, 3.0, 0.0]


def test_overview_multiple_slices(spark):
    a = counts(spark, [(2010, 1, 1), (2011, 1, 2)])
    b = counts(spark, [(2011, 4, 9)])
    out = stats.overview({"a": a, "b": b}, 2010, 2011)
    assert out.count() == 16
    got = {(r["slice"], r["year"], r["quarter"]): r["ratio"] for r in out.collect()}
    assert got[("a", 2011, 1)] == 2.0 and got[("b", 2011, 4)] == 0.0


def test_reference_quarter(spark):
    c = counts(spark, [(2016, 4, 3), (2017, 3, 5), (2017, 4, 0), (2018, 1, 9)])
    assert rows(stats.reference_quarter(c, 2016, 2017)) == [(2017, 3)]


def cases(spark, per_quarter):
    data = []
    i = 0
    for (kv, y, q), n in per_quarter.items():
        for _ in range(n):
            data.append((kv, y, q, i, "KV"))
            i += 1
    return spark.createDataFrame(data, "kv string, year int, quarter int, case_id int, contract string")


def lookup(spark):
    return spark.createDataFrame([("01", "North", "1", None), ("02", "South", "2", "abc"),
                                  ("03", "Gone", "", None), ("04", "Note", "4", "xyz")],
                                 "kv string, kv_name string, km6_id string, hinweis string")


def test_regional_ratio(spark):
    ref = spark.createDataFrame([(2017, 3)], "year int, quarter int")
    c = cases(spark, {("01", 2017, 3): 300, ("01", 2016, 3): 200,
                      ("02", 2017, 3): 10, ("02", 2016, 1): 5, ("02", 2015, 3): 5})
    out = stats.regional_ratio(c, lookup(spark), ref)
    assert rows(out, "kv", "kv_name", "year", "quarter", "cnt", "prev_cnt", "ratio") == [
        ("01", "North", 2017, 3, 300, 200, 1.5),
        ("02", "South", 2017, 3, 10, 0, 0.0),
    ]


def test_regional_reference_absent(spark):
    ref = spark.createDataFrame([(2017, 3)], "year int, quarter int")
    c = cases(spark, {("01", 2016, 3): 4})
    out = stats.regional_ratio(c, lookup(spark), ref)
    assert rows(out, "kv", "cnt", "prev_cnt", "ratio") == [("01", 0, 4, 0.0), ("02", 0, 0, 0.0)]


def test_distinct_counts(spark):
    df = spark.createDataFrame([(2010, "2010-01-05", "1", "23"), (2010, "2010-01-05", "12", "3"),
                                (2010, "2010-02-01", "1", "23"), (2010, "2010-04-01", "1", "23")],
                               "y int, d string, a string, b string").withColumn("d", F.to_date("d"))
    concat = stats.concat_key_per_quarter(df, "y", "d", "a", "b")
    # '1' || '23' equals '12' || '3': one distinct key in Q1
    assert rows(concat) == [(2010, 1, 1), (2010, 2, 1)]
    daily = stats.daily_distinct_per_quarter(df, "y", "d", "a", "b")
    assert rows(daily) == [(2010, 1, 2), (2010, 2, 1)]


def test_all_datasets_are_those_one_by_one(spark):
    import random

    rng = random.Random(1)
    data = [(rng.choice("123"), rng.randrange(2), f"{rng.choice([2014, 2015, 2016, 2017])}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 4):02d}",
             rng.choice(["a", "b", "c", "d", None]), rng.choice("xyz")) for _ in range(600)]
    df = spark.createDataFrame(data, "h2ik string, flag_x int, day string, key string, kind string").withColumn("day", F.to_date("day"))
    year, quarter = F.year("day"), F.quarter("day")
    measures = [ST.Measure("cases", F.col("key"), year, quarter), ST.Measure("daily", F.col("key"), year, quarter, day=F.col("day")),
                ST.Measure("some", F.col("key"), year, quarter, where=F.col("kind") == "x")]
    sets = [ST.DataSet("one", 2014, 2016, ("cases", "daily"), ("1", "2")), ST.DataSet("two", 2015, 2017, ("cases", "some"), ("2", "3")),
            ST.DataSet("flag", 2016, 2017, ("daily",), flag="x"), ST.DataSet("none", 2015, 2015, ("cases",), ())]
    counts = ST.counts_by_dataset(df, sets, measures)
    got = {tuple(r)[:4]: r.cnt for r in counts.collect()}
    expected = {}
    for s in sets:
        own = df.filter(F.col("h2ik").isin(list(s.insurers))) if s.insurers is not None else df.filter("flag_x = 1")
        own = own.filter(year.between(s.start_year, s.end_year))
        one_by_one = {"cases": ST.cases_per_quarter(own, year, quarter, "key"), "daily": ST.daily_distinct_per_quarter(own, year, "day", "key"),
                      "some": ST.cases_per_quarter(own.filter("kind = 'x'"), year, quarter, "key")}
        for v in s.views:
            expected |= {(s.name, v, r.year, r.quarter): r.cnt for r in one_by_one[v].collect() if r.cnt}
    assert got == expected and len(got) > 30
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1  # the table is read once
    out = ST.overview_by_dataset([counts], sets).collect()
    assert len(out) == sum(len(s.views) * 4 * (s.end_year - s.start_year + 1) for s in sets)
    for r in out:
        before = got.get((r.dataset, r.slice, r.year - 1, r.quarter), 0)
        assert r.cnt == got.get((r.dataset, r.slice, r.year, r.quarter), 0)
        first = next(s.start_year for s in sets if s.name == r.dataset)
        assert r.ratio == (r.cnt / before if before and r.year > first else 0.0)


def test_a_dataset_has_insurers_or_a_flag():
    import pytest

    with pytest.raises(ValueError):
        ST.DataSet("x", 2015, 2016, (), ("1",), "f")
    with pytest.raises(ValueError):
        ST.DataSet("x", 2015, 2016, ())
