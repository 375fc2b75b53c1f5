"""Readers and writers: strict delimited read, by-index read, slice round trip, merge."""

import os

import pytest
from pyspark.sql import functions as F

from claimwise.operators import quality as Q
from claimwise.session import scratch_path
from claimwise.sources import readers as R
from claimwise.sources import sinks as W
from conftest import rows


def test_strict_read_drops_malformed(spark, tmp_path):
    p = tmp_path / "decode.csv"
    p.write_text("h2ik;egk_nr;kv_nummer;pid\n1;E1;;0000000001\n1;E2\n\n2;E3;K3;0000000003\n")
    df = R.read_delimited_strict(spark, str(p), ["h2ik", "egk_nr", "kv_nummer", "pid"])
    assert df.count() == 2
    assert rows(df.select("pid")) == [("0000000001",), ("0000000003",)]


def test_by_index_pads_key(spark, tmp_path):
    p = tmp_path / "cat.csv"
    p.write_text("7;x;y\n\n123456789;a;b\n")
    df = R.read_by_index(spark, str(p), {"second": 2}, 0, "key", 8)
    assert rows(df.select("key", "second")) == [("00000007", "y"), ("123456789", "b")]


def test_slice_roundtrip_keeps_raw_values(spark):
    df = spark.createDataFrame([("a", "", " x ", 2010), ("b", "q", "y", 2011)],
                               "k string, e string, s string, bezugsjahr int")
    path = W.slice_path(scratch_path(spark, "t"), "ACC_ADB", "ds", "tbl")
    assert path.endswith("/ADB/ds/tbl")
    W.write_slices(df, path, "bezugsjahr")
    back = R.read_slices(spark, path)
    assert rows(back.select("k", "e", "s", F.col("bezugsjahr").cast("int"))) == [
        ("a", "", " x ", 2010), ("b", "q", "y", 2011)]


def test_merge_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    assert rows(W.merge_slices([a, b])) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "id int")
    with pytest.raises(ValueError):
        W.merge_slices([a, c])
    assert rows(W.merge_slices([a, c], allow_missing=True)) == [(1, "x"), (3, None)]


def test_db_short_name():
    assert W.db_short_name("ACC_ADB") == "ADB"
    assert W.db_short_name("FDB") == "FDB"


def test_clean_rules(spark):
    df = spark.createDataFrame([("ab#c", 1.5, "F-12x")], "t string, d double, fg string")
    rules = [Q.CleanRule("TYPE", "#", type="ANY"), Q.CleanRule("TYPE", "[^0-9Ee.+-]", type="FLOAT"),
             Q.CleanRule("NAME", "[^0-9]", column="FG")]
    r = Q.apply_clean_rules(df, rules).first()
    assert (r["t"], r["d"], r["fg"]) == ("abc", "1.5", "12")


def test_map_ids(spark):
    mapping = spark.createDataFrame([("1", "100"), ("2", "200"), ("3", "300"), ("4", "400")],
                                    "egk_nr string, pid string")
    data = spark.createDataFrame([("3", "C07"), ("4", "D08"), ("5", "E01")], "egk_nr string, icd string")
    out = Q.map_ids(data, mapping, "egk_nr", "pid")
    assert rows(out) == [("3", "C07", "300"), ("4", "D08", "400"), ("5", "E01", "")]


def test_separate_datasets(spark):
    sep = spark.createDataFrame([("A", "1"), ("B", "2")], "dataset string, h2ik string")
    df = spark.createDataFrame([("1", 10), ("2", 20), ("3", 30)], "h2ik string, v int")
    assert rows(Q.separate_datasets(df, sep), "dataset", "v") == [("A", 10), ("B", 20)]


def test_session_helpers(spark):
    from claimwise.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark)


def test_score_pattern_file(spark, tmp_path):
    from claimwise.operators.score import pattern_join

    p = tmp_path / "cci.csv"
    p.write_text("icd_code;disease_class;cci_weight\nI21;mi;1\n\nC7_;tumor;6\n")
    pats = R.read_score_patterns(spark, str(p))
    assert rows(pats) == [("C7_", "tumor", 6), ("I21", "mi", 1)]
    facts = spark.createDataFrame([("I214",), ("C781",), ("C7",), ("X",)], "icd_code string")
    assert rows(pattern_join(facts, pats), "icd_code", "pattern") == [("C781", "C7_"), ("I214", "I21")]


def test_export_bytes(spark, tmp_path):
    """Dirty values and names, on the bytes of the files."""
    import gzip

    from claimwise.operators.extract import ExtractSpec
    from claimwise.operators.rowfilters import FrameMeta
    from claimwise.plans.commands import export

    df = spark.createDataFrame([('a;b"c', " x\ty\r\nz ", None), ("\u0000q", "", "Z")], "ID string, Text string, Third string")
    export(df, ExtractSpec(), FrameMeta("ACC_DB", "t"), root=str(tmp_path))
    files = sorted((tmp_path / "DB" / "default" / "t").glob("*.gz"))
    lines = sorted(x for f in files for x in gzip.open(f).read().split(b"\n") if x and x != b"id;text;third")
    assert lines == [b"a_bc;x\ty  z;", b"q;;Z"]


def test_slices_with_another_header_are_refused(spark, tmp_path):
    import pytest

    (tmp_path / "a.csv").write_text("pid;name\n1;x\n")
    (tmp_path / "b.csv").write_text("name;pid\ny;2\n")
    with pytest.raises(Exception, match="header|schema"):
        R.read_slices(spark, str(tmp_path)).collect()


def test_few_files_per_slice(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16).selectExpr("id", "id % 3 AS year")
    W.write_slices(df, str(tmp_path / "s"), "year", fmt="csv")
    assert all(len(list(p.glob("*.gz"))) <= 2 for p in (tmp_path / "s").glob("year=*"))


def test_unset_shared_folder_is_an_error_off_a_local_master():
    import pytest

    from claimwise.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *args):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_rejects_come_back_and_the_header_is_known_by_its_place(spark, tmp_path):
    one, two = tmp_path / "in" / "a.csv", tmp_path / "in" / "b.csv"
    one.parent.mkdir()
    one.write_text('a;b\n1; x "q" \na;b\n\n2\n3;y;z\n;\n')
    two.write_text("a;b\n4;w\n")
    read = R.read_delimited_once(spark, str(one.parent), ["a", "b"], str(tmp_path / "out"))
    assert rows(read.rows) == [("", ""), ("1", ' x "q" '), ("4", "w"), ("a", "b")]  # a data line like the header is data
    assert sorted((r._file.rsplit("/", 1)[1], r._text, r._reason) for r in read.rejects.collect()) == [
        ("a.csv", "2", "1 fields instead of 2"), ("a.csv", "3;y;z", "3 fields instead of 2")]
    assert (read.n_rows, read.n_rejects) == (4, 2)
    assert rows(R.read_delimited_strict(spark, str(one.parent), ["a", "b"])) == rows(read.rows)
    assert R.read_delimited_strict(spark, str(one.parent), ["a", "b"]).count() == 4  # under column pruning too
    assert rows(R.read_delimited_strict(spark, str(two), ["a", "b"], header=False)) == [("4", "w"), ("a", "b")]


def test_another_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b;a\n1;2\n")
    with pytest.raises(Exception, match="(?i)header"):
        R.read_delimited_strict(spark, str(tmp_path / "x.csv"), ["a", "b"]).collect()


def test_malformed_values_are_counted_while_the_export_is_written(spark, tmp_path):
    from claimwise.operators.extract import ExtractSpec, Where
    from claimwise.operators.quality import MalformedCount, malformed_counts
    from claimwise.operators.rowfilters import FrameMeta
    from claimwise.plans import commands as C

    df = spark.createDataFrame([("1", "2015-01-01", "x"), ("a", "", "x"), ("", "01.01.2015", "x"), ("zz", "zz", "gone")], "N string, day string, k string")
    seen = MalformedCount({"n": "int", "day": "date", "absent": "int"})
    spec = ExtractSpec(where=(Where("k", ("x",)),))
    out = C.export(df, spec, FrameMeta("ACC_ADB", "T"), root=str(tmp_path), malformed=seen)
    assert seen.counts() == [("n", "int", 2, 1), ("day", "date", 2, 1)]
    assert rows(malformed_counts(out, {"n": "int", "day": "date"})) == sorted(seen.counts())
    assert rows(R.read_slices(spark, W.slice_path(str(tmp_path), "ACC_ADB", "default", "T")), "n") == [("",), ("1",), ("a",)]


def test_an_empty_result_leaves_no_file(spark, tmp_path):
    empty = spark.createDataFrame([], "a string, y int")
    for slice_col in (None, "y"):
        W.write_slices(empty, str(tmp_path / f"t{slice_col}"), slice_col)
        left = [f for _, _, names in os.walk(tmp_path / f"t{slice_col}") for f in names if f.startswith("part-")]
        assert left == []
    assert not (tmp_path / "tNone").exists()
    W.write_slices(spark.createDataFrame([("x", 1)], "a string, y int"), str(tmp_path / "full"))
    assert rows(R.read_slices(spark, str(tmp_path / "full"))) == [("x", "1")]


def test_predicates_cut_a_table_into_its_years(spark):
    got = R.year_predicates("bezugsjahr", 2014, 2016, ("h2ik IN ('1', '2')",))
    assert got == [f"bezugsjahr = {y} AND (h2ik IN ('1', '2'))" for y in (2014, 2015, 2016)]
    df = spark.createDataFrame([(h, y) for h in "123" for y in range(2012, 2019)], "h2ik string, bezugsjahr int")
    parts = [df.filter(p).count() for p in got]
    assert parts == [2, 2, 2] and df.filter(" OR ".join(f"({p})" for p in got)).count() == sum(parts)
    for bad in (("a b", 2014, 2015), ("x = 1 OR y", 2014, 2015), ("y", 2016, 2015)):
        with pytest.raises(ValueError):
            R.year_predicates(*bad)
