"""Extract conditions, year slices, joins and configured row filters."""

import pytest
from pyspark.sql import functions as F

from claimwise.operators import rowfilters as RF
from claimwise.operators.extract import ExtractSpec, JoinSpec, Where, YearSlice, extract, lower_columns
from claimwise.sources.readers import read_value_list
from conftest import rows


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "a", 2015, 10.0), (2, "b", 2016, 20.0), (3, "c", 2017, 30.0),
                                  (4, "d", 2018, 40.0), (5, "e", 2019, 50.0)],
                                 "pid int, name string, bezugsjahr int, amount double")


def test_inline_or_group(spark, people):
    out = extract(people, ExtractSpec(columns=("pid",), where=(Where("pid", (1, 2, 3), "=", "NUMERIC"),)))
    assert rows(out) == [(1,), (2,), (3,)]


def test_and_of_groups_and_global(spark, people):
    spec = ExtractSpec(columns=("pid",), global_where=(Where("amount", (15,), ">", "NUMERIC"),),
                       where=(Where("name", ("b", "c", "e")), Where("pid", (5,), "<", "NUMERIC")))
    assert rows(extract(people, spec)) == [(2,), (3,)]


def test_like_and_column_operand(spark, people):
    df = people.withColumn("limit", F.lit(25.0))
    spec = ExtractSpec(columns=("pid",), where=(Where("amount", ("limit",), "<", "COLUMN"),
                                                Where("name", ("a%", "_"), "like")))
    assert rows(extract(df, spec)) == [(1,), (2,)]


def test_empty_value_list_matches_nothing(spark, people):
    assert extract(people, ExtractSpec(where=(Where("pid", (), "=", "NUMERIC"),))).count() == 0


def test_values_from_file(spark, people, tmp_path):
    p = tmp_path / "pids.txt"
    p.write_text("1\n2\n\n3\n")
    vals = read_value_list(spark, str(p))
    spec = ExtractSpec(columns=("pid",), where=(Where("pid", op="=", kind="NUMERIC", value_frame=vals),))
    assert rows(extract(people, spec)) == [(1,), (2,), (3,)]
    lt = ExtractSpec(columns=("pid",), where=(Where("pid", op="<", kind="NUMERIC", value_frame=vals),))
    assert rows(extract(people, lt)) == [(1,), (2,)]


def test_unreadable_value_file_fails(spark, tmp_path):
    with pytest.raises(Exception):
        read_value_list(spark, str(tmp_path / "missing.txt")).count()


def test_year_slices(spark, people):
    fixed = extract(people, ExtractSpec(columns=("pid",), year_slice=YearSlice("bezugsjahr", 2016, 2017)))
    assert rows(fixed) == [(2,), (3,)]
    dyn = extract(people, ExtractSpec(columns=("pid",),
                                      year_slice=YearSlice("bezugsjahr", previous=3, as_of="2018-05-01")))
    assert rows(dyn) == [(1,), (2,), (3,), (4,)]
    unsliced = extract(people.drop("bezugsjahr"), ExtractSpec(year_slice=YearSlice("bezugsjahr", 2016, 2016)))
    assert unsliced.count() == 5


def test_projection_and_joins(spark, people):
    other = spark.createDataFrame([(1, "x"), (2, "y")], "pid int, tag string")
    inner = extract(people, ExtractSpec(columns=("pid", "tag"), joins=(JoinSpec(other, ("pid",)),)))
    assert rows(inner) == [(1, "x"), (2, "y")]
    left = extract(people, ExtractSpec(exclude=("name", "bezugsjahr", "amount"),
                                       joins=(JoinSpec(other, ("pid",), "left"),)))
    assert left.columns == ["pid", "tag"] and left.count() == 5
    assert lower_columns(people.toDF("PID", "Name", "BezugsJahr", "AMOUNT")).columns == \
        ["pid", "name", "bezugsjahr", "amount"]


def test_row_filters(spark):
    df = spark.createDataFrame([("0000000001", "abc"), ("0000000002", "ab"), ("0000000003", "x")],
                               "pid string, code string")
    meta = RF.FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO")
    inc = RF.RowFilter("code", RF.RegexStrategy("ab"), "INCLUDE")
    assert rows(RF.apply_filters(df, [inc], meta), "pid") == [("0000000002",)]
    exc = RF.RowFilter("code", RF.SetStrategy(("x",)), "EXCLUDE")
    assert rows(RF.apply_filters(df, [exc], meta), "pid") == [("0000000001",), ("0000000002",)]
    staff_src = spark.createDataFrame([("1", "M", ""), ("3", "", ""), ("12345678901", "", "K")],
                                      "pid string, egk_nr_ma string, kv_nummer_ma string")
    staff = RF.employee_ids(staff_src)
    emp = RF.RowFilter("pid", RF.FrameSetStrategy(staff), "EXCLUDE")
    assert rows(RF.apply_filters(df, [emp], meta), "pid") == [("0000000002",), ("0000000003",)]
    absent = RF.RowFilter("nope", RF.SetStrategy(("1",)), "INCLUDE")
    assert RF.apply_filters(df, [absent], meta).count() == 3
    other_table = RF.RowFilter("code", RF.SetStrategy(("zzz",)), "INCLUDE", table="AVK_ADB_T_KH_FALL")
    assert RF.apply_filters(df, [other_table], meta).count() == 3


def test_targets():
    meta = RF.FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO")
    assert RF.targets(meta, "adb", "am_evo")
    assert RF.targets(meta, None, "AM_EVO")
    assert RF.targets(meta, "ACC", None)
    assert not RF.targets(meta, "fdb", "am_evo")
    assert not RF.targets(meta, None, None)


def test_certain_diagnoses(spark):
    df = spark.createDataFrame([("G", "KV"), ("g", "kv"), ("V", "KV"), ("G", "kv ")], "s string, v string")
    out = RF.certain_diagnoses(df, "s", "v")
    assert rows(out) == [("G", "KV"), ("g", "kv")]


def test_data_family(spark):
    df = spark.createDataFrame([("1", 1), ("2", 0), ("3", 1)], "h2ik string, flag_x int")
    assert rows(RF.data_family(df, insurers=["1", "2"]), "h2ik") == [("1",), ("2",)]
    assert rows(RF.data_family(df, flag="x"), "h2ik") == [("1",), ("3",)]
    with pytest.raises(ValueError):
        RF.data_family(df)


def test_joins_with_shared_names_conditions_and_excludes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    right = spark.createDataFrame([(1, "x", 5, "s"), (1, "y", 9, "s"), (2, "z", 1, "s")], "id int, name string, n int, secret string")
    spec = ExtractSpec(joins=(JoinSpec(right, ("id",), "left", exclude=("secret",), where=(Where("n", (4,), ">", "NUMERIC"),)),))
    out = extract(left, spec)
    assert out.columns == ["id", "name", "name_1", "n"]
    assert rows(out) == [(1, "a", "x", 5), (1, "a", "y", 9)]  # id 2 has no partner that meets the condition
    free = extract(left, ExtractSpec(joins=(JoinSpec(right.filter("n > 4"), ("id",), "left", exclude=("secret",)),)))
    assert rows(free.na.fill({"name_1": "", "n": 0})) == [(1, "a", "x", 5), (1, "a", "y", 9), (2, "b", "", 0)]
    none = ExtractSpec(joins=(JoinSpec(right, ("id",), "left", where=(Where("n", ()),)),))
    assert rows(extract(left, none)) == []  # an empty list is met by no row


def test_numeric_operands_keep_their_digits(spark):
    df = spark.createDataFrame([(9007199254740992,), (9007199254740993,)], "k long")
    for value in ("9007199254740993", 9007199254740993):
        assert rows(extract(df, ExtractSpec(where=(Where("k", (value,), "=", "NUMERIC"),)))) == [(9007199254740993,)]
        assert rows(extract(df, ExtractSpec(where=(Where("k", (value,), "<", "NUMERIC"),)))) == [(9007199254740992,)]
    values = spark.createDataFrame([("9007199254740993",), ("no number",)], "v string")
    assert rows(extract(df, ExtractSpec(where=(Where("k", op="=", kind="NUMERIC", value_frame=values),)))) == [(9007199254740993,)]
    assert rows(extract(df, ExtractSpec(where=(Where("k", ("5.5",), ">", "NUMERIC"),)))) == [(9007199254740992,), (9007199254740993,)]


def test_like_patterns_of_any_number_take_one_equi_join(spark, capsys):
    from claimwise.operators.lookup import like_matches

    words = ["abc", "abd", "xyz", "a_c", "a%c", "", None, "bca", "zzabc"]
    patterns = ["a%", "%c", "_b_", "%b%", "abc", "", "a\\_c", "a\\%%", "%", None]
    values, pats = spark.createDataFrame([(w,) for w in words], "v string"), spark.createDataFrame([(p,) for p in patterns], "p string")
    values.createOrReplaceTempView("like_v")
    pats.createOrReplaceTempView("like_p")
    expected = spark.sql("SELECT DISTINCT v, p FROM like_v, like_p WHERE v LIKE p")
    assert rows(like_matches(values, pats)) == rows(expected)
    many = spark.range(150_000).selectExpr("concat('p', id, '%x') AS p")
    got = like_matches(spark.createDataFrame([("p77_x",), ("p1234x",), ("q",)], "v string"), many)
    assert rows(got) == sorted([("p1234x", "p1%x"), ("p1234x", "p1234%x"), ("p1234x", "p123%x"), ("p1234x", "p12%x"), ("p77_x", "p77%x"), ("p77_x", "p7%x")])
    got.explain()
    assert "NestedLoop" not in capsys.readouterr().out


def test_infix_patterns_probe_by_their_rarest_gram(spark, capsys):
    import random

    from claimwise.operators import lookup as L

    rng = random.Random(4)

    def word(kinds, n):
        return "".join(rng.choice(kinds) for _ in range(rng.randint(0, n)))

    words = sorted({word("abcé%_\\", 9) for _ in range(300)})
    patterns = {w + rng.choice(["%", "_", "%_", ""]) + word("ab%_c", 5) for w in (rng.choice("%_") + word("abc%_é", 6) for _ in range(400))}
    patterns = sorted(patterns | {"%", "_", "__", "%_%", "%\\%%", "_\\_%", "%a\\%b%", "%\\\\%", "%é%", "%absent%", "%ab%bc%"})
    values, pats = spark.createDataFrame([(w,) for w in words], "v string"), spark.createDataFrame([(p,) for p in patterns], "p string")
    values.createOrReplaceTempView("infix_v")
    pats.createOrReplaceTempView("infix_p")
    expected = spark.sql("SELECT v, p FROM infix_v, infix_p WHERE v LIKE p")
    got = L.like_matches(values, pats)
    assert rows(got) == rows(expected) and got.count() > 1000
    got.explain()
    assert "NestedLoop" not in capsys.readouterr().out

    # a pattern meets only the values of its rarest gram
    many = spark.range(20_000).selectExpr("concat('common ', id, ' tail') AS v").unionAll(spark.createDataFrame([("common xqz tail",)], "v string"))
    found = L.like_matches(many, spark.createDataFrame([("%mon xqz t%",), ("_ommon 77 %il",)], "p string"))
    assert rows(found) == [("common 77 tail", "_ommon 77 %il"), ("common xqz tail", "%mon xqz t%")]
