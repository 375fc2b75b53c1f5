"""Registered extract / filter / projection queries (PRJ1-5, FLT1-18, JON1-2, SCL1-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwise.functions.scalars import clean_value, pad_zeros
from claimwise.operators import enrich, rowfilters as RF
from claimwise.operators.extract import (ExtractSpec, JoinSpec, Where, YearSlice, extract,
                                         lower_columns)
from claimwise.plans import standins as S
from claimwise.plans.registry import register
from claimwise.session import scratch_path
from claimwise.sources.readers import read_value_list


@register("extract_columns", ["PRJ1"], "SELECT p_partkey, p_name, p_brand FROM part")
def extract_columns(spark, d):
    return extract(S.table(spark, d, "part"), ExtractSpec(columns=("p_partkey", "p_name", "p_brand")))


@register("extract_exclude", ["PRJ2", "PRJ3"], "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def extract_exclude(spark, d):
    return extract(S.table(spark, d, "part"), ExtractSpec(exclude=("p_size", "p_retailprice")))


@register("extract_or_groups", ["FLT1", "FLT2", "FLT3", "FLT4", "FLT5", "FLT6"], """
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_totalprice > 1000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND (o_orderstatus = 'F' OR o_orderstatus = 'P')""")
def extract_or_groups(spark, d):
    spec = ExtractSpec(
        columns=("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"),
        global_where=(Where("o_totalprice", (1000,), ">", "NUMERIC"),),
        where=(Where("o_orderpriority", ("1-URGENT", "2-HIGH")),
               Where("o_orderstatus", ("F", "P"))))
    return extract(S.table(spark, d, "orders"), spec)


@register("extract_like", ["FLT1", "FLT3"], """
SELECT p_partkey, p_name, p_type FROM part
WHERE (p_type LIKE 'PROMO%' OR p_type LIKE 'SMALL%') AND (p_name LIKE '%anvil' OR p_name LIKE '%ring')""")
def extract_like(spark, d):
    spec = ExtractSpec(columns=("p_partkey", "p_name", "p_type"),
                       where=(Where("p_type", ("PROMO%", "SMALL%"), "like"),
                              Where("p_name", ("%anvil", "%ring"), "like")))
    return extract(S.table(spark, d, "part"), spec)


@register("extract_column_compare", ["FLT1", "FLT2"], """
SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_quantity FROM lineitem
WHERE l_discount < l_tax AND l_quantity > 10""")
def extract_column_compare(spark, d):
    spec = ExtractSpec(columns=("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity"),
                       where=(Where("l_discount", ("l_tax",), "<", "COLUMN"),
                              Where("l_quantity", (10,), ">", "NUMERIC")))
    return extract(S.table(spark, d, "lineitem"), spec)


@register("extract_values_from_file", ["FLT7", "SRC7"], """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def extract_values_from_file(spark, d):
    # the value list is a text file (one id per line) written by Spark from customer
    path = scratch_path(spark, "values")
    (S.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
     .select(F.col("c_custkey").cast("string")).write.text(path))
    values = read_value_list(spark, path)
    spec = ExtractSpec(columns=("o_orderkey", "o_custkey", "o_totalprice"),
                       where=(Where("o_custkey", op="=", kind="NUMERIC", value_frame=values),))
    return extract(S.table(spark, d, "orders"), spec)


def _orders_with_year(spark, d):
    return S.table(spark, d, "orders").withColumn("bezugsjahr", F.year("o_orderdate"))



@register("extract_year_slices", ["FLT8"], """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS bezugsjahr, o_totalprice FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1998""")
def extract_year_slices(spark, d):
    spec = ExtractSpec(columns=("o_orderkey", "bezugsjahr", "o_totalprice"),
                       year_slice=YearSlice("bezugsjahr", 1996, 1998, date_column="o_orderdate"))
    return extract(_orders_with_year(spark, d), spec)


@register("extract_dynamic_years", ["FLT9", "D15"], """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS bezugsjahr, o_totalprice FROM orders
WHERE year(o_orderdate) BETWEEN 1998 AND 2001""")
def extract_dynamic_years(spark, d):
    spec = ExtractSpec(columns=("o_orderkey", "bezugsjahr", "o_totalprice"),
                       year_slice=YearSlice("bezugsjahr", previous=3, as_of=S.AS_OF, date_column="o_orderdate"))
    return extract(_orders_with_year(spark, d), spec)


@register("extract_unsliced", ["FLT10"], "SELECT p_partkey, p_type FROM part")
def extract_unsliced(spark, d):
    spec = ExtractSpec(columns=("p_partkey", "p_type"), year_slice=YearSlice("bezugsjahr", 1996, 1998))
    return extract(S.table(spark, d, "part"), spec)


@register("extract_join_inner", ["JON1"], """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderpriority = '1-URGENT'""")
def extract_join_inner(spark, d):
    cust = S.table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    spec = ExtractSpec(columns=("o_orderkey", "o_custkey", "c_name", "c_mktsegment"),
                       where=(Where("o_orderpriority", ("1-URGENT",)),),
                       joins=(JoinSpec(cust, ("o_custkey",), "inner", ("c_name", "c_mktsegment")),))
    return extract(S.table(spark, d, "orders"), spec)


@register("extract_join_left", ["JON2", "D9"], """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey""")
def extract_join_left(spark, d):
    o = S.table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    spec = ExtractSpec(columns=("c_custkey", "c_name", "o_orderkey", "o_totalprice"),
                       joins=(JoinSpec(o, ("c_custkey",), "left"),))
    return extract(S.table(spark, d, "customer"), spec)


@register("extract_join_where", ["JON1", "JON2", "FLT2"], """
SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_nationkey, CAST(c.c_custkey AS BIGINT) + 1 AS o_orderkey_1
FROM orders o LEFT OUTER JOIN customer c ON c.c_custkey = o.o_custkey
WHERE (c.c_mktsegment = 'BUILDING') AND (c.c_acctbal > 100.5)""")
def extract_join_where(spark, d):
    """Conditions and excluded columns on the joined frame of a left join, whose rows without a match fail the
    conditions; a shared column name is numbered."""
    cust = (S.table(spark, d, "customer").withColumn("o_orderkey", F.col("c_custkey") + 1)
            .withColumnRenamed("c_custkey", "o_custkey"))
    join = JoinSpec(cust, ("o_custkey",), "left", exclude=("c_mktsegment", "c_acctbal"),
                    where=(Where("c_mktsegment", ("BUILDING",)), Where("c_acctbal", ("100.5",), ">", "NUMERIC")))
    spec = ExtractSpec(exclude=("o_orderstatus", "o_orderdate", "o_orderpriority"), joins=(join,))
    return extract(S.table(spark, d, "orders"), spec)


@register("extract_like_values_from_file", ["FLT7", "SRC7"], """
SELECT p_partkey, p_name FROM part p WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT '%' || substr(c_name, -2) AS v FROM customer
                 UNION ALL SELECT 'a%'  UNION ALL SELECT '_o%r' UNION ALL SELECT p_name FROM part WHERE p_size < 3) x
  WHERE p.p_name LIKE x.v)""")
def extract_like_values_from_file(spark, d):
    """Patterns from a file, thousands of them, in one equi join on their literal ends."""
    path = scratch_path(spark, "patterns")
    ends = S.table(spark, d, "customer").select(F.concat(F.lit("%"), F.right("c_name", F.lit(2))).alias("value")).distinct()
    names = S.table(spark, d, "part").filter("p_size < 3").select(F.col("p_name").alias("value"))
    fixed = spark.createDataFrame([("a%",), ("_o%r",)], "value string")
    ends.unionByName(names).unionByName(fixed).write.text(path)
    spec = ExtractSpec(columns=("p_partkey", "p_name"),
                       where=(Where("p_name", op="like", value_frame=read_value_list(spark, path)),))
    return extract(S.table(spark, d, "part"), spec)


@register("extract_like_infix_from_file", ["JON6", "FLT7", "SRC7"], """
SELECT p_partkey, p_name, p_brand FROM part p WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT '%' || substr(c_name, 5, 6) || '%' AS v FROM customer
                 UNION ALL SELECT DISTINCT '%' || substr(p_name, 2, 4) || '_' || substr(p_name, 7, 2) || '%' FROM part WHERE p_size < 20
                 UNION ALL SELECT '_' || substr(p_name, 2, 3) || '%z_' FROM part WHERE p_size = 7
                 UNION ALL SELECT '%q%' UNION ALL SELECT '____') x
  WHERE p.p_name LIKE x.v)""")
def extract_like_infix_from_file(spark, d):
    """Hundreds of patterns without a literal end from a file: each probes the grams of the names by its rarest."""
    path = scratch_path(spark, "patterns")
    part = S.table(spark, d, "part")
    c = S.table(spark, d, "customer").selectExpr("'%' || substr(c_name, 5, 6) || '%' AS value").distinct()
    inside = part.filter("p_size < 20").selectExpr("'%' || substr(p_name, 2, 4) || '_' || substr(p_name, 7, 2) || '%' AS value").distinct()
    late = part.filter("p_size = 7").selectExpr("'_' || substr(p_name, 2, 3) || '%z_' AS value")
    fixed = spark.createDataFrame([("%q%",), ("____",)], "value string")
    c.unionAll(inside).unionAll(late).unionAll(fixed).write.text(path)
    spec = ExtractSpec(columns=("p_partkey", "p_name", "p_brand"), where=(Where("p_name", op="like", value_frame=read_value_list(spark, path)),))
    return extract(part, spec)


_BIG = "(CAST(o_orderkey AS BIGINT) + 9007199254740992)"


@register("extract_numeric_values", ["FLT2", "FLT7"], f"""
SELECT {_BIG} AS big_key, o_custkey FROM orders
WHERE {_BIG} IN (SELECT CAST(l_orderkey AS BIGINT) + 9007199254740992 FROM lineitem WHERE l_quantity > 45)
  AND {_BIG} > 9007199254740995 AND {_BIG} < (SELECT max(CAST(o_orderkey AS BIGINT)) + 9007199254740991 FROM orders)""")
def extract_numeric_values(spark, d):
    """16-digit ids, past the digits of a double: values from a file by =, inline by >, from a file by <."""
    big = F.lit(9007199254740992).cast("long")
    orders = S.table(spark, d, "orders").select((F.col("o_orderkey") + big).alias("big_key"), "o_custkey")
    path, top = scratch_path(spark, "values"), scratch_path(spark, "values")
    (S.table(spark, d, "lineitem").filter("l_quantity > 45").select((F.col("l_orderkey") + big).cast("string").alias("value"))
     .write.text(path))
    orders.agg((F.max("big_key") - 1).cast("string").alias("value")).write.text(top)
    spec = ExtractSpec(where=(Where("big_key", op="=", kind="NUMERIC", value_frame=read_value_list(spark, path)),
                              Where("big_key", ("9007199254740995",), ">", "NUMERIC"),
                              Where("big_key", op="<", kind="NUMERIC", value_frame=read_value_list(spark, top))))
    return extract(orders, spec)


@register("data_family_insurer", ["FLT15"],
          "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def data_family_insurer(spark, d):
    rows = S.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return RF.data_family(rows, insurers=["1-URGENT", "5-LOW"], insurer_col="o_orderpriority")


@register("data_family_flag", ["FLT15"], "SELECT o_orderkey, 1 AS flag_open FROM orders WHERE o_orderstatus = 'O'")
def data_family_flag(spark, d):
    rows = S.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "O").cast("int").alias("flag_open"))
    return RF.data_family(rows, flag="open")


_PART_META = RF.FrameMeta("ACC_CATALOGUE", "AVK_PART")


@register("filter_regex_include", ["FLT11", "FLT12"],
          "SELECT p_partkey, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#1[0-9]')")
def filter_regex_include(spark, d):
    f = RF.RowFilter("p_brand", RF.RegexStrategy("Brand#1[0-9]"), "INCLUDE")
    return RF.apply_filters(S.table(spark, d, "part"), [f], _PART_META).select("p_partkey", "p_brand")


@register("filter_regex_exclude", ["FLT11", "FLT12"],
          "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#1[0-9]')")
def filter_regex_exclude(spark, d):
    f = RF.RowFilter("p_brand", RF.RegexStrategy("Brand#1[0-9]"), "EXCLUDE")
    return RF.apply_filters(S.table(spark, d, "part"), [f], _PART_META).select("p_partkey", "p_brand")


@register("filter_set", ["FLT13"],
          "SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def filter_set(spark, d):
    f = RF.RowFilter("p_type", RF.SetStrategy(("PROMO", "SMALL")), "INCLUDE")
    return RF.apply_filters(S.table(spark, d, "part"), [f], _PART_META).select("p_partkey", "p_type")


@register("filter_chain", ["FLT11", "FLT12", "FLT13", "D1"], """
SELECT p_partkey, p_brand, p_type FROM part
WHERE regexp_full_match(p_brand, 'Brand#[0-9]') AND p_type NOT IN ('ECONOMY', 'LARGE')""")
def filter_chain(spark, d):
    fs = [RF.RowFilter("p_brand", RF.RegexStrategy("Brand#[0-9]"), "INCLUDE"),
          RF.RowFilter("p_type", RF.SetStrategy(("ECONOMY", "LARGE")), "EXCLUDE"),
          # column absent from the frame -> the filter does not apply
          RF.RowFilter("h2ik", RF.SetStrategy(("1",)), "INCLUDE"),
          # db restriction that does not match -> the filter does not apply
          RF.RowFilter("p_size", RF.SetStrategy(("1",)), "INCLUDE", db="ACC_ADB")]
    return RF.apply_filters(S.table(spark, d, "part"), fs, _PART_META).select(
        "p_partkey", "p_brand", "p_type")


def _person_ids(spark, d):
    """PID_AKTUELL stand-in: staff card for MACHINERY customers, staff number for negative balances."""
    c = S.table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("pid"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("M"), F.col("c_custkey")))
        .otherwise(F.lit("")).alias("egk_nr_ma"),
        F.when(F.col("c_acctbal") < 0, F.lit("K")).otherwise(F.lit("")).alias("kv_nummer_ma"))


@register("filter_employee_anti", ["FLT14", "SCL2", "SCL3"], """
SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS pid FROM orders
WHERE lpad(CAST(o_custkey AS VARCHAR), 10, '0') NOT IN (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer
  WHERE c_mktsegment = 'MACHINERY' OR c_acctbal < 0)""")
def filter_employee_anti(spark, d):
    staff = RF.employee_ids(_person_ids(spark, d))
    rows = S.table(spark, d, "orders").select("o_orderkey", pad_zeros("o_custkey", 10).alias("pid"))
    f = RF.RowFilter("pid", RF.FrameSetStrategy(staff), "EXCLUDE")
    return RF.apply_filters(rows, [f])


@register("clean_values", ["SCL1"], r"""
SELECT doc_id, regexp_replace(translate(COALESCE(text, ''), ';"', '_'),
                              '^[\x00-\x20]+|[\x00-\x20]+\z', '', 'g') AS text FROM documents""")
def clean_values(spark, d):
    return S.table(spark, d, "documents").select("doc_id", clean_value("text").alias("text"))


@register("rename_lower", ["PRJ5"], "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def rename_lower(spark, d):
    shouting = S.table(spark, d, "nation").toDF("N_NationKey", "N_NAME", "n_RegionKey")
    return lower_columns(shouting)


@register("static_first", ["PRJ4", "ENR9", "DOC4"],
          "SELECT '101575519' AS h2ik, n_nationkey, n_name, n_regionkey FROM nation")
def static_first(spark, d):
    step = enrich.StaticColumn("h2ik", "101575519", first=True, table="nation")
    return enrich.run_chain(S.table(spark, d, "nation"), [step], RF.FrameMeta("TPCH", "nation"))


@register("static_last", ["PRJ4", "ENR9", "D10"],
          "SELECT n_nationkey, n_name, n_regionkey, 'X' AS dataset FROM nation")
def static_last(spark, d):
    steps = [enrich.StaticColumn("dataset", "X", first=False, table="nation"),
             # already present -> skipped
             enrich.StaticColumn("dataset", "Y", first=False, table="nation"),
             # excluded table -> skipped
             enrich.StaticColumn("other", "Z", first=False, exclude_tables=("nation",))]
    return enrich.run_chain(S.table(spark, d, "nation"), steps, RF.FrameMeta("TPCH", "nation"))
