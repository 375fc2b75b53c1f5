"""Golden rows of the enrichment steps (reference unit tests, see FIXTURES.md G1-G4, G8)."""

import pytest
from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.operators.rowfilters import FrameMeta
from claimwise.sources.readers import read_by_index
from conftest import rows

AM_EVO = FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO")

MAIN_WITHOUT_NAME = ["1;000010000;0;20100101;", "2;000020000;1;20100101;", "3;000030000;2;20100101;",
                     "6;000060000;3;20100101;20101231", "7;000070000;4;;20101231", "8;000080000;5;;"]
MAIN_WITH_NAME = ["9;Neun;000090000;6;20100101;", "10;Zehn   *NV*;000100000;7;20100101;"]
SUPPLEMENT = ["1;000001000;1", "4;000000400;0"]


def write_lines(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


@pytest.fixture()
def without_name(spark, tmp_path):
    main = read_by_index(spark, write_lines(tmp_path, "main.csv", MAIN_WITHOUT_NAME),
                         {E.DDD: 1, E.APPFORM: 2, E.ADMISSION: 3, E.RETIREMENT: 4}, 0, "key", 8)
    supp = read_by_index(spark, write_lines(tmp_path, "supp.csv", SUPPLEMENT),
                         {E.GENERIC: 2, E.DDD: 1}, 0, "key", 8)
    return E.DrugCatalogue((E.CatalogueSource(main, (E.DDD, E.APPFORM), (E.ADMISSION, E.RETIREMENT)),
                            E.CatalogueSource(supp, (E.GENERIC, E.DDD))))


@pytest.fixture()
def with_name(spark, tmp_path):
    main = read_by_index(spark, write_lines(tmp_path, "named.csv", MAIN_WITH_NAME),
                         {E.DDD: 2, E.APPFORM: 3, E.ADMISSION: 4, E.RETIREMENT: 5, E.NAME: 1}, 0, "key", 8)
    supp = read_by_index(spark, write_lines(tmp_path, "supp2.csv", SUPPLEMENT),
                         {E.GENERIC: 2, E.DDD: 1}, 0, "key", 8)
    return E.DrugCatalogue((E.CatalogueSource(main, (E.DDD, E.APPFORM, E.NAME), (E.ADMISSION, E.RETIREMENT)),
                            E.CatalogueSource(supp, (E.GENERIC, E.DDD))))


def prescriptions(spark, items):
    return spark.createDataFrame([(pzn, "abcde", "10", day) for pzn, day in items],
                                 "pzn string, atc string, anzahl_packungen string, verordnungsdatum string")


def test_drug_catalogue_without_name(spark, without_name):
    rx = prescriptions(spark, [("00000001", "2010-04-01"), ("00000004", "2010-04-01"),
                               ("00000002", "2010-04-01"), ("00000006", "2011-04-01"),
                               ("00000007", "2011-04-01"), ("00000008", "2011-04-01"),
                               ("00000099", "2011-04-01")])
    out = E.run_chain(rx, [without_name], AM_EVO)
    assert out.columns == ["pzn", "atc", "anzahl_packungen", "verordnungsdatum", "DDD", "APPFORM",
                           "GENERIKENN", "Menge_berechnet"]
    got = {r["pzn"]: (r["DDD"], r["APPFORM"], r["GENERIKENN"], r["Menge_berechnet"]) for r in out.collect()}
    assert got == {
        "00000001": (10.0, "0", "1", None),     # later source overrides the dose
        "00000004": (4.0, "", "0", None),       # supplement only: always valid
        "00000002": (200.0, "1", "", None),     # main only
        "00000006": (0.0, "3", "", None),       # after retirement
        "00000007": (0.0, "4", "", None),       # retirement only, prescribed after it
        "00000008": (0.0, "5", "", None),       # neither date
        "00000099": (None, "", "", None),       # unknown package
    }


def test_drug_catalogue_with_name(spark, with_name):
    rx = prescriptions(spark, [("00000009", "2011-04-01"), ("00000010", "2011-04-01")])
    out = E.run_chain(rx, [with_name], AM_EVO)
    assert out.columns == ["pzn", "atc", "anzahl_packungen", "verordnungsdatum", "DDD", "APPFORM",
                           "STANAME", "GENERIKENN", "IS_CLASSIFIED", "Menge_berechnet"]
    got = {r["pzn"]: (r["DDD"], r["APPFORM"], r["STANAME"], r["IS_CLASSIFIED"]) for r in out.collect()}
    assert got == {"00000009": (900.0, "6", "Neun", "1"), "00000010": (1000.0, "7", "Zehn", "0")}


def test_drug_catalogue_row_key_is_not_padded(spark, without_name):
    rx = prescriptions(spark, [("1", "2010-04-01")])
    r = E.run_chain(rx, [without_name], AM_EVO).first()
    assert r["DDD"] is None and r["APPFORM"] == ""


def test_drug_catalogue_validity_window_edges(spark, without_name):
    # pzn 6: admitted 2010-01-01, retired 2010-12-31 (half-open)
    rx = prescriptions(spark, [("00000006", "2010-01-01"), ("00000006", "2010-12-30"),
                               ("00000006", "2010-12-31"), ("00000006", "2009-12-31")])
    got = sorted(r["verordnungsdatum"] + "=" + str(r["DDD"]) for r in E.run_chain(rx, [without_name], AM_EVO).collect())
    assert got == ["2009-12-31=0.0", "2010-01-01=600.0", "2010-12-30=600.0", "2010-12-31=0.0"]


def test_drug_catalogue_last_line_wins(spark, tmp_path):
    main = read_by_index(spark, write_lines(tmp_path, "dup.csv", ["5;000001000;a;;", "5;000002000;b;;"]),
                         {E.DDD: 1, E.APPFORM: 2}, 0, "key", 8)
    step = E.DrugCatalogue((E.CatalogueSource(main, (E.DDD, E.APPFORM)),
                            E.CatalogueSource(main.limit(0).select("key", F.lit("").alias(E.GENERIC)),
                                              (E.GENERIC,))))
    r = E.run_chain(prescriptions(spark, [("00000005", "2010-01-01")]), [step], AM_EVO).first()
    assert r["APPFORM"] == "b"


def test_drug_catalogue_without_package_count(spark, without_name):
    rx = spark.createDataFrame([("00000001",)], "pzn string")
    out = E.run_chain(rx, [without_name], AM_EVO)
    assert out.columns == ["pzn", "DDD", "APPFORM", "GENERIKENN"]
    assert tuple(out.first()) == ("00000001", "000001000", "0", "1")


def test_drug_catalogue_other_table_untouched(spark, without_name):
    rx = prescriptions(spark, [("00000001", "2010-04-01")])
    out = E.run_chain(rx, [without_name], FrameMeta("ACC_ADB", "AVK_ADB_T_HEMI_EVO"))
    assert out.columns == rx.columns


def test_start_date(spark):
    df = spark.createDataFrame([("2018-08-02", d) for d in ("(()3", "0", "2", " 5 ")],
                               "leistungs_ende string, kg_tage string")
    step = E.StartDate("leistungs_ende", "kg_tage", "kg_beginn", table="au_fall")
    out = E.run_chain(df, [step], FrameMeta("ACC_ADB", "AVK_ADB_T_AU_FALL"))
    assert [r["kg_beginn"] for r in out.collect()] == ["2018-08-02", "2018-08-02", "2018-08-01", "2018-08-02"]
    missing = E.run_chain(df.drop("kg_tage"), [step], FrameMeta("ACC_ADB", "AVK_ADB_T_AU_FALL"))
    assert [r["kg_beginn"] for r in missing.collect()] == [""] * 4


def test_fix_missing_dates(spark):
    data = [("KV", "2010", str(q), "", "") for q in (1, 2, 3, 4)] + [
        ("KV", "2010", "2", "20100405", "20100406"), ("SV", "2010", "1", "", "")]
    df = spark.createDataFrame(data, "vertrags_id string, bezugsjahr string, behandl_quartal string, "
                                     "behandl_beginn string, behandl_ende string")
    out = E.run_chain(df, [E.FixMissingDates()], FrameMeta("ACC_ADB", "AVK_ADB_T_ARZT_FALL"))
    got = [(r["behandl_beginn"], r["behandl_ende"]) for r in out.collect()]
    assert got == [("20100101", "20100331"), ("20100401", "20100630"), ("20100701", "20100930"),
                   ("20101001", "20101231"), ("20100405", "20100406"), ("", "")]


def test_pharmacy_type_step(spark):
    df = spark.createDataFrame([(None,), ("",), ("264637",), ("304637",), ("114637",)], "apothekenik string")
    out = E.run_chain(df, [E.PharmacyType(table="am_evo")], AM_EVO)
    assert [r["apo_typ"] for r in out.collect()] == ["", "", "26", "30", "00"]
    absent = E.run_chain(df.select(F.lit(1).alias("x")), [E.PharmacyType(table="am_evo")], AM_EVO)
    assert absent.columns == ["x"]


def test_region_step(spark):
    df = spark.createDataFrame([("15938",), (None,), ("",), ("1",)], "bs_nr string")
    out = E.run_chain(df, [E.RegionFromPractice()], AM_EVO)
    assert [r["kv"] for r in out.collect()] == ["17", "", "", ""]
    untouched = E.run_chain(df, [E.RegionFromPractice()], FrameMeta("ACC_ADB", "AVK_ADB_T_ARZT_FALL"))
    assert untouched.columns == ["bs_nr"]
    no_col = E.run_chain(df.select(F.lit("x").alias("y")), [E.RegionFromPractice()], AM_EVO)
    assert [r["kv"] for r in no_col.collect()] == ["", "", "", ""]


def test_lookup_columns(spark):
    mapping = spark.createDataFrame([("1", "123", "1337", "1")], "vertrags_id string, efn_id string, "
                                                                  "value1 string, value2 string")
    df = spark.createDataFrame([("1", "123"), ("1", "125")], "vertrags_id string, efn_id string")
    out = E.run_chain(df, [E.LookupColumns(mapping, ("vertrags_id", "efn_id"))])
    assert rows(out) == [("1", "123", "1337", "1"), ("1", "125", "", "")]
    missing_key = E.run_chain(df.drop("efn_id"), [E.LookupColumns(mapping, ("vertrags_id", "efn_id"))])
    assert rows(missing_key) == [("1", "", ""), ("1", "", "")]


def test_lookup_rejects_duplicate_keys(spark):
    mapping = spark.createDataFrame([("1", "a"), ("1", "b")], "k string, v string")
    df = spark.createDataFrame([("1",)], "k string")
    with pytest.raises(Exception, match="duplicate keys"):
        E.run_chain(df, [E.LookupColumns(mapping, ("k",))]).collect()


def test_static_column(spark):
    df = spark.createDataFrame([("a",)], "x string")
    meta = FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO")
    first = E.run_chain(df, [E.StaticColumn("h2ik", "1", first=True, table="am_evo")], meta)
    assert first.columns == ["h2ik", "x"]
    last = E.run_chain(df, [E.StaticColumn("h2ik", "1", table="am_evo")], meta)
    assert last.columns == ["x", "h2ik"]
    present = E.run_chain(first, [E.StaticColumn("h2ik", "2", table="am_evo")], meta)
    assert present.first()["h2ik"] == "1"
    excluded = E.run_chain(df, [E.StaticColumn("h2ik", "1", exclude_tables=("am_evo",))], meta)
    assert excluded.columns == ["x"]
    other = E.run_chain(df, [E.StaticColumn("h2ik", "1", table="hemi")], meta)
    assert other.columns == ["x"]


def test_pseudo_hash(spark):
    df = spark.createDataFrame([("0000000001",)], "pid string")
    out = E.run_chain(df, [E.PseudoHash()], FrameMeta("ACC_ADB", "AVK_ADB_T_VERS_STAMM"))
    import hashlib
    assert out.first()["pid_hash"] == hashlib.sha256(b"0000000001").hexdigest()


def test_noop(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert E.run_chain(df, [E.Noop("bad config")]).columns == ["x"]


def test_supplement_only_keys(spark, without_name):
    keys = E.supplement_only_keys(list(without_name.sources))
    assert rows(keys) == [("00000004",)]


def test_drug_catalogue_refuses_existing_label(spark, without_name):
    rx = prescriptions(spark, [("00000001", "2010-04-01")]).withColumn("ddd", F.lit("x"))
    with pytest.raises(ValueError):
        E.run_chain(rx, [without_name], AM_EVO)


def test_fingerprint_column_replaces_and_fills(spark):
    master = spark.createDataFrame([("p1", "old"), ("p2", "old")], "pid string, pid_hash string")
    fps = spark.createDataFrame([("p1", "abc")], "pid string, fingerprint string")
    out = E.run_chain(master, [E.FingerprintColumn(fps)], FrameMeta("ACC_ADB", "AVK_ADB_T_VERS_STAMM"))
    assert out.columns == ["pid", "pid_hash"]
    assert rows(out) == [("p1", "abc"), ("p2", "")]
    other = E.run_chain(master, [E.FingerprintColumn(fps)], FrameMeta("ACC_ADB", "AVK_ADB_T_KH_FALL"))
    assert rows(other) == [("p1", "old"), ("p2", "old")]


def test_repeated_catalogue_keys_do_not_multiply_rows(spark):
    frame = spark.createDataFrame([("1", "a"), ("01", "b"), ("2", "c")], "key string, WARENZ string")
    step = E.DrugCatalogue((E.CatalogueSource(frame, ("WARENZ",)),), "pzn", table="am_evo")
    df = spark.createDataFrame([("00000001",), ("00000002",), ("00000003",)], "pzn string")
    out = step(df, FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO"))
    assert rows(out, "pzn", "WARENZ") == [("00000001", "b"), ("00000002", "c"), ("00000003", "")]


def test_lookup_computes_its_mapping_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    mapping = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string").mapInArrow(counted, "k string, v string")
    out = E.LookupColumns(mapping, ("k",))(spark.createDataFrame([("a",), ("c",)], "k string"), FrameMeta())
    assert rows(out) == [("a", "1"), ("c", "")] and calls.value == 2
