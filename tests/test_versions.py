"""Versions of a sliced table."""

import pytest
from conftest import rows

from claimwise.sources import versions as V


def master(spark):
    return spark.createDataFrame([("1", "a", 2015), ("2", "b", 2015), ("3", "c", 2016), ("4", "d", 2017)], "pid string, name string, year int")


def values(spark, **of):
    return spark.createDataFrame(list(of.items()) or [("", "")], "pid string, pid_hash string").selectExpr("substr(pid, 2) AS pid", "pid_hash")


def folder(version, slice_):
    return version.paths[slice_].rsplit("/", 2)[1].split("-")[0]


def test_updates_in_a_row_rewrite_changed_slices_only(spark, tmp_path):
    base = str(tmp_path / "t")
    assert V.newest(spark, base) is None
    V.create(master(spark), base, "year")
    assert rows(V.read(spark, base), "pid", "year") == [("1", 2015), ("2", 2015), ("3", 2016), ("4", 2017)]
    two = V.update_column(spark, base, values(spark, p1="x", p3="y"), "pid", "pid_hash")
    assert two.number == 2 and {folder(two, s) for s in two.paths} == {"v=2"}  # a new column: all slices
    assert rows(V.read(spark, base), "pid", "name", "pid_hash") == [("1", "a", "x"), ("2", "b", ""), ("3", "c", "y"), ("4", "d", "")]
    three = V.update_column(spark, base, values(spark, p1="x", p3="z", p9="no such person"), "pid", "pid_hash")
    assert [folder(three, s) for s in ("2015", "2016", "2017")] == ["v=2", "v=3", "v=2"]
    assert rows(V.read(spark, base), "pid", "pid_hash") == [("1", "x"), ("2", ""), ("3", "z"), ("4", "")]
    assert V.update_column(spark, base, values(spark, p1="x", p3="z"), "pid", "pid_hash") == three  # nothing changes: no version
    assert rows(V.read(spark, base, two), "pid", "pid_hash") == [("1", "x"), ("2", ""), ("3", "y"), ("4", "")]  # older ones stay readable
    assert rows(V.read(spark, base, slices=["2016"]), "pid") == [("3",)]


def test_an_interrupted_update_leaves_the_old_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    V.create(master(spark), base, "year")
    before = rows(V.read(spark, base))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(V, "_publish", broken)  # the rows are written, the manifest is not
        with pytest.raises(RuntimeError, match="lost"):
            V.update_column(spark, base, values(spark, p1="x"), "pid", "pid_hash")
    assert V.newest(spark, base).number == 1 and rows(V.read(spark, base)) == before
    assert V.update_column(spark, base, values(spark, p1="x"), "pid", "pid_hash").number == 2
    assert rows(V.read(spark, base), "pid", "pid_hash")[0] == ("1", "x")


def test_of_two_updates_of_one_version_the_second_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    first = V.create(master(spark), base, "year")
    V.update_column(spark, base, values(spark, p1="x"), "pid", "pid_hash")
    monkeypatch.setattr(V, "newest", lambda *_: first)  # a second writer that has read version 1
    with pytest.raises(Exception, match="(?i)exists"):
        V.update_column(spark, base, values(spark, p2="y"), "pid", "pid_hash")
    monkeypatch.undo()
    assert rows(V.read(spark, base), "pid", "pid_hash")[:2] == [("1", "x"), ("2", "")]


def test_missing_tables_and_empty_ones(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        V.read(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        V.update_column(spark, str(tmp_path / "none"), values(spark), "pid", "pid_hash")
    assert V.create(master(spark).limit(0), str(tmp_path / "e"), "year").paths == {}
    assert V.newest(spark, str(tmp_path / "e")).number == 1
