from pyspark.sql import functions as F

from claimwise.functions import scalars as S


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_padding_never_truncates(spark):
    assert one(spark, S.pad_zeros("v", 10), "655") == "0000000655"
    assert one(spark, S.pad_zeros("v", 8), "655") == "00000655"
    assert one(spark, S.pad_zeros("v", 8), "123456789012") == "123456789012"


def test_pid_case_padding(spark):
    assert one(spark, S.pad_pid_10("v"), "1") == "0000000001"
    assert one(spark, S.pad_pid_10("v"), "12345678901") is None
    assert one(spark, S.pad_pid_5_to_9("v"), "12345") == "0000012345"
    assert one(spark, S.pad_pid_5_to_9("v"), "1234") is None
    assert one(spark, S.pad_pid_5_to_9("v"), "1234567890") is None


def test_clean_value(spark):
    assert one(spark, S.clean_value("v"), None) == ""
    assert one(spark, S.clean_value("v"), ' \t a;"b" \n') == "a_b"
    # characters above U+0020 are not trimmed
    assert one(spark, S.clean_value("v"), "x  ") == "x  "


def test_strict_int_is_java_parse_int(spark):
    assert one(spark, S.strict_int("v"), "2") == 2
    assert one(spark, S.strict_int("v"), "+2") == 2
    assert one(spark, S.strict_int("v"), " 5 ") is None
    assert one(spark, S.strict_int("v"), "(()3") is None
    assert one(spark, S.strict_int("v"), "99999999999") is None


def test_main_region(spark):
    assert one(spark, S.main_region("v"), "15938") == "17"
    for v in (None, "", "1"):
        assert one(spark, S.main_region("v"), v) == ""
    assert one(spark, S.main_region("v"), "0112") == "01"
    assert one(spark, S.main_region("v"), "99") == ""
    assert one(spark, S.main_region("v"), "ab12") == ""
    assert one(spark, S.main_region("v"), "9312") == "93"


def test_pharmacy_type(spark):
    expect = {None: "", "": "", "264637": "26", "304637": "30", "114637": "00"}
    for v, e in expect.items():
        assert one(spark, S.pharmacy_type("v"), v) == e


def test_quarter_texts(spark):
    df = spark.createDataFrame([("2010", str(q)) for q in (1, 2, 3, 4, 9)], "y string, q string")
    got = [tuple(r) for r in df.select(S.quarter_begin_text("y", "q"), S.quarter_end_text("y", "q")).collect()]
    assert got == [("20100101", "20100331"), ("20100401", "20100630"), ("20100701", "20100930"),
                   ("20101001", "20101231"), ("20100101", "20100331")]


def test_quarter_index_roundtrip(spark):
    df = spark.createDataFrame([(2010, 1), (2010, 4), (2011, 1)], "y int, q int")
    idx = df.select(S.quarter_index("y", "q").alias("i"))
    back = [tuple(r) for r in idx.select(S.year_of_index("i"), S.quarter_of_index("i")).collect()]
    assert back == [(2010, 1), (2010, 4), (2011, 1)]
    i = [r[0] for r in idx.collect()]
    assert i[2] - i[0] == 4 and i[2] - i[1] == 1


def test_package_name(spark):
    assert one(spark, S.clean_package_name("v"), "Zehn   *NV*") == "Zehn"
    assert one(spark, S.is_classified("v"), "Zehn   *NV*") == "0"
    assert one(spark, S.is_classified("v"), "Neun") == "1"
    assert one(spark, S.is_classified("v"), None) == ""


def test_full_match_and_tolerance(spark):
    assert one(spark, S.full_match("v", "a+"), "aaa") is True
    assert one(spark, S.full_match("v", "a+"), "aab") is False
    assert one(spark, S.full_match("v", "a|b"), "ab") is False
    assert one(spark, S.out_of_tolerance("v"), 1.6, "v double") is True
    assert one(spark, S.out_of_tolerance("v"), 1.0, "v double") is False


def test_sha256_matches_known_value(spark):
    assert one(spark, S.sha256_hex("v"), "abc") == \
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_card_wins(spark):
    df = spark.createDataFrame([("E1", "K1"), ("", "K2")], "e string, k string")
    assert [r[0] for r in df.select(S.card_wins("e", "k")).collect()] == ["", "K2"]


def test_iso_date(spark):
    assert one(spark, S.iso_date("v"), "2010-02-03").isoformat() == "2010-02-03"
    assert one(spark, S.iso_date("v"), "2010-2-3") is None
    assert one(spark, S.iso_date("v"), "2010-02-30") is None
    assert one(spark, F.col("v"), "x") == "x"


def test_year_list(spark):
    df = spark.createDataFrame([(2015, 2018)], "a int, b int")
    assert df.select(S.year_list("a", "b")).first()[0] == [2015, 2016, 2017, 2018]
