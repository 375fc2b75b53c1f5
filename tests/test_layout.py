"""Merge of the configured views of a slice layout."""

import gzip
import os

import pytest

from claimwise.plans import commands as C
from claimwise.sources import layout as L
from claimwise.sources import readers as R
from claimwise.sources import sinks as W


def put(path, lines, pack=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "".join(x + "\n" for x in lines).encode()
    with open(path, "wb") as f:
        f.write(gzip.compress(data) if pack and lines else data)


def conf(*views):
    return {"sources": [{"views": [{"name": v} for v in views]}]}


def got(frame):
    return sorted(map(tuple, frame.collect()))


def test_slices_of_reordered_headers_are_put_together_by_name(spark, tmp_path):
    root = str(tmp_path / "cache")
    put(f"{root}/ADB/d1/T_A/year=2015/part-0.csv.gz", ["x;y", "1;a", "2;"])
    put(f"{root}/ADB/d1/T_A/year=2016/part-0.csv.gz", ["y;x", "b;3"])
    put(f"{root}/ADB/d1/T_A/year=2016/part-1.csv.gz", ["y;x", " c ;4"])
    put(f"{root}/ADB/d1/T_A/year=2017/part-0.csv.gz", ["x;y"])  # a header only
    put(f"{root}/ADB/d1/T_A/year=2018/part-0.csv.gz", [])  # nothing at all
    put(f"{root}/ADB/d2/T_A/part-0.csv.gz", ["x;y", "9;other data set"])
    put(f"{root}/ADB/d1/T_B/part-0.csv.gz", ["x", "not configured"])
    merged = L.merge_configured(spark, conf("T_A", "T_C"), root, str(tmp_path / "out"))
    assert [(m.table.db, m.table.dataset, m.table.name) for m in merged] == [("ADB", "d1", "T_A"), ("ADB", "d2", "T_A")]
    assert len(merged[0].table.slices) == 3 and merged[0].frame.columns == ["x", "y", "year"]
    assert got(merged[0].frame) == [("1", "a", 2015), ("2", "", 2015), ("3", "b", 2016), ("4", " c ", 2016)]
    assert got(R.read_slices(spark, merged[0].path)) == [("1", "a", "2015"), ("2", "", "2015"), ("3", "b", "2016"), ("4", " c ", "2016")]
    assert got(merged[1].frame) == [("9", "other data set")]
    plan = merged[0].frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2  # one scan for each header, not for each slice


def test_files_named_after_database_table_and_slice(spark, tmp_path):
    root = str(tmp_path / "cache")
    put(f"{root}/ADB/d1/ACC_ADB_V_ADB_X.2015.csv.gz", ["a;b", "1;2"])
    put(f"{root}/ADB/d1/ACC_ADB_V_ADB_X.2016.csv.gz", ["b;a", "4;3"])
    put(f"{root}/ADB/d1/ACC_ADB_V_ADB_Y.2016.csv.gz", ["b;a", "no;no"])
    put(f"{root}/FDB/d1/ACC_FDB_V_FDB_X.csv.gz", ["a", "5"])
    merged = {(m.table.db, m.table.name): got(m.frame.select(*sorted(m.frame.columns))) for m in L.merge_configured(spark, conf("V_ADB_X", "V_FDB_X"), root)}
    assert merged == {("ADB", "V_ADB_X"): [("1", "2"), ("3", "4")], ("FDB", "V_FDB_X"): [("5",)]}
    assert L.file_name("V_EVA_Z") == "SB_HRI_V_EVA_Z" and L.file_name("Z") == "Z"


def test_other_columns_are_refused_unless_allowed(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/ADB/d1/T_A/year=2015/part-0.csv.gz", ["x;y", "1;a"])
    put(f"{root}/ADB/d1/T_A/year=2016/part-0.csv.gz", ["x;z", "2;b"])
    with pytest.raises(ValueError, match="different columns"):
        L.merge_configured(spark, conf("T_A"), root)
    frame = L.merge_configured(spark, conf("T_A"), root, allow_missing=True)[0].frame
    assert got(frame.select("x", "y", "z", "year")) == [("1", "a", "", 2015), ("2", "", "b", 2016)]


def test_tables_without_bytes_are_left_out(spark, tmp_path, caplog):
    put(f"{tmp_path}/ADB/d1/T_A/year=2015/part-0.csv.gz", [])
    assert L.merge_configured(spark, conf("T_A"), str(tmp_path)) == [] and "empty" in caplog.text


def test_what_the_sink_writes_is_found(spark, tmp_path):
    df = spark.createDataFrame([("1", "a;\"b", 2015), ("2", None, 2016)], "id string, v string, year int")
    W.write_slices(df, W.slice_path(str(tmp_path / "in"), "ACC_ADB", "d", "T"), "year")
    merged = C.merge_views(spark, {"views": [{"name": "T"}]}, str(tmp_path / "in"), str(tmp_path / "out"))
    assert got(R.read_slices(spark, merged[0].path)) == [("1", "a_b", "2015"), ("2", "", "2016")]
