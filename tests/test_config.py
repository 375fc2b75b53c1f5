"""Configuration to plan: modes, mandatory fields, defaults."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.plans import config as C


def test_modes(spark, tmp_path):
    (tmp_path / "m.csv").write_text("k;v\n1;x\n")
    good = [{"mode": "STATIC", "valueName": "a", "value": "1"}, {"mode": "BS_TO_KV"}, {"mode": "APO_TYPE"}, {"mode": "FIX_DATES"}, {"mode": "PSEUDO_HASH"},
            {"mode": "DYNAMIC", "file": str(tmp_path / "m.csv"), "keyColumns": ["k"]},
            {"mode": "START_DATE", "endDateColumn": "e", "dayColumn": "d", "valueName": "s"}]
    kinds = [E.StaticColumn, E.RegionFromPractice, E.PharmacyType, E.FixMissingDates, E.PseudoHash, E.LookupColumns, E.StartDate]
    assert [type(C.step_of(spark, c)) for c in good] == kinds


@pytest.mark.parametrize("conf", [
    {}, {"mode": "NEW"}, {"mode": "STATIC", "value": "1"}, {"mode": "DDD"}, {"mode": "DDD", "sources": [], "keyColumn": "pzn", "targetTable": "t"},
    {"mode": "DDD", "sources": [{}], "targetTable": "t"}, {"mode": "DDD", "sources": [{}], "keyColumn": "pzn"}, {"mode": "DYNAMIC", "file": "x"}])
def test_invalid_configurations_do_nothing(spark, conf):
    step = C.step_of(spark, conf)
    assert isinstance(step, E.Noop) and step.reason
    df = spark.range(3)
    assert rows(E.run_chain(df, [step])) == rows(df)


def test_slices():
    assert C.slice_of(None, "2020-05-01").bounds() == (2017, 2020) and C.slice_of(None, None) is None
    assert C.slice_of({"column": "y", "startYear": "2010", "endYear": "2012"}, None).bounds() == (2010, 2012)
    assert C.slice_of({"previousYears": 1}, "2020-05-01").bounds() == (2019, 2020)


def test_unknown_operator(spark):
    with pytest.raises(ValueError, match="operator"):
        C.where_of(spark, {"column": "a", "operator": "NEAR", "values": ["1"]})


def orders(spark):
    return spark.createDataFrame([("1", "23"), ("2", "{23"), ("3", ""), ("4", None), ("5", "2")], "pid string, code string")


def export(spark, *filters, **more):
    conf = {"db": "ADB", "views": [{"name": "T"}], "filters": list(filters)}
    return rows(C.export_from_config(spark, conf, {"T": orders(spark), **more})["T"], "pid")


def test_configured_filters(spark, tmp_path):
    pattern = {"column": "code", "filterStrategy": {"type": "PATTERN", "regexPattern": "^$|[0-9]{2}"}}
    assert export(spark, {**pattern, "mode": "INCLUDE"}) == [("1",), ("3",), ("4",)]
    assert export(spark, {**pattern, "mode": "EXCLUDE"}) == [("2",), ("5",)]
    assert export(spark, {**pattern, "mode": "EXCLUDE", "table": "other"}) == export(spark) and len(export(spark)) == 5
    (tmp_path / "v.txt").write_text("1\n5\n")
    listed = {"column": "pid", "mode": "INCLUDE"}
    for strategy in ({"type": "UNIQUE_SET", "values": [1, 5]}, {"type": "UNIQUE_SET", "valueFile": str(tmp_path / "v.txt")}):
        assert export(spark, {**listed, "filterStrategy": strategy}) == [("1",), ("5",)]
    assert export(spark, {**listed, "filterStrategy": {"type": "UNIQUE_SET"}}) == []  # a filter that must drop every row does
    persons = spark.createDataFrame([("1", "M", ""), ("2", "", "")], "pid string, egk_nr_ma string, kv_nummer_ma string")
    padded = orders(spark).selectExpr("lpad(pid, 10, '0') AS pid", "code")
    staff = {"column": "pid", "mode": "EXCLUDE", "filterStrategy": {"type": "EMPLOYEE_PIDS"}}
    conf = {"sources": [{"db": "ADB", "views": [{"name": "T"}]}], "filters": [staff]}
    got = C.export_from_config(spark, conf, {"T": padded, C.STAFF_VIEW: persons})["T"]
    assert [r.pid for r in got.orderBy("pid").collect()] == ["0000000002", "0000000003", "0000000004", "0000000005"]


def test_own_strategies(spark, monkeypatch):
    class Short:
        def predicate(self, c):
            return F.length(c) < 2

    monkeypatch.setattr(C, "STRATEGIES", dict(C.STRATEGIES))
    C.register_strategy("SHORT", lambda spark, conf, frames: Short())
    assert export(spark, {"column": "code", "mode": "INCLUDE", "filterStrategy": {"type": "SHORT"}}) == [("3",), ("4",), ("5",)]
    with pytest.raises(ValueError, match="known already"):
        C.register_strategy("PATTERN", None)


@pytest.mark.parametrize("bad, said", [
    ({"column": "pid", "mode": "INCLUDE", "filterStrategy": {"type": "NEW"}}, "strategy"), ({"column": "pid", "mode": "INCLUDE"}, "strategy"),
    ({"column": "pid", "filterStrategy": {"type": "UNIQUE_SET"}}, "mode"), ({"mode": "INCLUDE", "filterStrategy": {"type": "UNIQUE_SET"}}, "column"),
    ({"column": "pid", "mode": "INCLUDE", "filterStrategy": {"type": "UNIQUE_SET"}, "colunm": "x"}, "colunm")])
def test_wrong_filters_are_errors(spark, bad, said):
    with pytest.raises(ValueError, match=said):
        export(spark, bad)


def test_unknown_keys_are_errors(spark):
    for conf in ({"db": "A", "view": []}, {"sources": [{"db": "A", "vews": []}]}, {"sources": [], "db": "A"}):
        with pytest.raises(ValueError, match="unknown keys"):
            C.export_from_config(spark, conf, {})


def test_sections_of_the_other_commands(spark):
    conf = {"statistics": {"datasets": [{"db": "ADB", "dataset": "a", "views": ["x"], "h2iks": [1, 2], "startYear": "2014", "endYear": 2016},
                                        {"db": "FDB", "dataset": "b", "views": ["x", "y"], "flag": "f", "startYear": 2015, "endYear": 2016}]},
            "decode": [{"name": "a", "h2iks": [1]}, {"name": "b", "h2iks": ["2"]}]}
    one, two = C.datasets_of(conf)
    assert (one.insurers, one.start_year, two.flag, two.views) == (("1", "2"), 2014, "f", ("x", "y"))
    assert [(d.name, d.insurers) for d in C.decodings_of(conf)] == [("a", ("1",)), ("b", ("2",))]
    for bad in ({"decode": [{"name": "a", "h2iks": [1]}, {"name": "a", "h2iks": [2]}]}, {"decode": [{"name": "a", "iks": [1]}]}):
        with pytest.raises(ValueError):
            C.decodings_of(bad)
    with pytest.raises(ValueError, match="exactly one"):
        C.scores_from_config(spark, {"cci": {"cciFile": "x", "startYear": 1, "endYear": 2, "sources": [{"db": "A", "dataset": "a"}]}}, spark.range(1), "2015-01-01")
