"""Registered I/O and data-quality queries (SRC4, SNK1-3, SET2, DOC1-3, DOC5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.operators import quality as Q
from claimwise.plans import standins as S
from claimwise.plans.q_decode import _SQL_IDS, _ids_and_unwanted
from claimwise.operators import decode as D
from claimwise.plans.registry import register
from claimwise.session import scratch_path
from claimwise.sources import layout as L
from claimwise.sources import readers as R
from claimwise.sources import sinks as W


def _orders_export(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority",
                    F.to_date("o_orderdate").cast("string").alias("o_orderdate"),
                    F.year("o_orderdate").alias("bezugsjahr"))


@register("slices_roundtrip", ["SNK1", "SNK2", "SRC4", "SNK3"], """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS bezugsjahr FROM orders""")
def slices_roundtrip(spark, d):
    root = scratch_path(spark, "cache")
    path = W.slice_path(root, "ACC_ADB", "dataset1", "orders")
    W.write_slices(_orders_export(spark, d), path, "bezugsjahr", fmt="csv", encoding="iso-8859-1")
    back = R.read_slices(spark, path, encoding="iso-8859-1")
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", "o_orderdate",
                       F.col("bezugsjahr").cast("int").alias("bezugsjahr"))


@register("export_file", ["SNK1", "SCL1", "PRJ5", "SRC4"], r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  replace(replace(regexp_replace(translate(COALESCE(text, '') || ' "q" ; ' || COALESCE(lang, ''), ';"', '_'),
    '^[\x00-\x20]+|[\x00-\x20]+\z', '', 'g'), chr(13), ' '), chr(10), ' ') AS text, source
FROM documents""")
def export_file(spark, d):
    """Dirty values (separator, quotes, line breaks, upper-case names) exported to files, whose lines are then
    split at the separator alone."""
    from claimwise.operators.extract import ExtractSpec
    from claimwise.operators.rowfilters import FrameMeta
    from claimwise.plans.commands import export

    docs = S.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("DOC_ID"),
        F.concat(F.coalesce("text", F.lit("")), F.lit(' "q" ; '), F.coalesce("lang", F.lit(""))).alias("Text"), "source")
    root = scratch_path(spark, "export")
    export(docs, ExtractSpec(), FrameMeta("ACC_DOCS", "documents"), root=root)
    lines = spark.read.option("lineSep", "\n").text(W.slice_path(root, "ACC_DOCS", "default", "documents"))
    parts = F.split("value", ";", -1)
    return lines.filter("value != 'doc_id;text;source'").select(*[parts[i].alias(n) for i, n in enumerate(("doc_id", "text", "source"))])


def _separation(spark):
    # separation configuration: dataset -> insurers
    return spark.createDataFrame(
        [("urgent", "1-URGENT"), ("urgent", "2-HIGH"), ("routine", "3-MEDIUM"), ("routine", "5-LOW")],
        "dataset string, h2ik string")


@register("dataset_split", ["DOC3"], """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent' ELSE 'routine' END AS dataset,
  CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority AS h2ik
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""")
def dataset_split(spark, d):
    rows = _orders_export(spark, d).withColumnRenamed("o_orderpriority", "h2ik")
    split = Q.separate_datasets(rows, _separation(spark))
    path = scratch_path(spark, "separated")
    W.write_slices(split, path, "dataset", fmt="csv")
    back = R.read_slices(spark, path)
    return back.select("dataset", F.col("o_orderkey").cast("long").alias("o_orderkey"), "h2ik")


@register("merge_slices", ["SET2", "SNK3", "D7"], """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
FROM orders""")
def merge_slices(spark, d):
    o = _orders_export(spark, d)
    root = scratch_path(spark, "merge")
    a = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderpriority", "o_orderdate")
    b = o.filter(F.col("o_orderpriority") != "1-URGENT").select("o_orderpriority", "o_orderkey")
    W.write_slices(a, f"{root}/a", fmt="parquet")
    W.write_slices(b, f"{root}/b", fmt="parquet")
    frames = [spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")]
    merged = W.merge_slices(frames, allow_missing=True)
    return merged.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", "o_orderdate")


@register("merge_configured_views", ["SNK3", "SNK2", "SRC4", "SET2"], """
SELECT 'T_ORDERS' AS view, CAST(o_orderkey AS BIGINT) AS key, o_orderpriority AS label, CAST(year(o_orderdate) AS INTEGER) AS slice FROM orders
UNION ALL SELECT 'T_CUSTOMER', CAST(c_custkey AS BIGINT), c_mktsegment, NULL FROM customer""")
def merge_configured_views(spark, d):
    """A slice tree of three views, one of them not configured; the orders have another column order from 1996 on."""
    root, out = scratch_path(spark, "cache"), scratch_path(spark, "production")
    o = _orders_export(spark, d)
    orders = W.slice_path(root, "ACC_ADB", "d1", "T_ORDERS")
    W.write_slices(o.filter("bezugsjahr < 1996"), orders, "bezugsjahr")
    W.write_slices(o.filter("bezugsjahr >= 1996").select("o_orderdate", "bezugsjahr", "o_orderpriority", "o_orderkey"), orders, "bezugsjahr", mode="append")
    customer = S.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment")
    W.write_slices(customer, W.slice_path(root, "ACC_ADB", "d2", "T_CUSTOMER"))
    W.write_slices(customer, W.slice_path(root, "ACC_ADB", "d2", "T_OTHER"))
    conf = {"sources": [{"db": "ACC_ADB", "views": [{"name": "T_ORDERS"}, {"name": "T_CUSTOMER"}, {"name": "T_ABSENT"}]}]}
    merged = {m.table.name: R.read_slices(spark, m.path) for m in L.merge_configured(spark, conf, root, out)}
    kinds = {"T_ORDERS": ("o_orderkey", "o_orderpriority", F.col("bezugsjahr")), "T_CUSTOMER": ("c_custkey", "c_mktsegment", F.lit(None))}
    parts = [df.select(F.lit(name).alias("view"), F.col(kinds[name][0]).cast("long").alias("key"), F.col(kinds[name][1]).alias("label"),
                       kinds[name][2].cast("int").alias("slice")) for name, df in merged.items()]
    return reduce(DataFrame.unionAll, parts)


# Cleaning rules (fixed configuration values): the ANY rule keeps letters, digits,
# whitespace, ();,./\ umlauts, sharp s, section sign, euro sign, [ ] _ -.
ANY_EXCLUDE = r"[^A-Za-z0-9 \t\n\x0B\f\r();,./\\äöüß§€\[\]_-]"
DIGITS_ONLY = r"[^0-9]"


@register("clean_rules", ["DOC1"], r"""
SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9 \t\n\x0B\f\r();,./\\äöüß§€\[\]_-]', '', 'g') AS text,
  regexp_replace(regexp_replace(source, '[^A-Za-z0-9 \t\n\x0B\f\r();,./\\äöüß§€\[\]_-]', '', 'g'), '[^0-9]', '', 'g') AS source,
  regexp_replace(lang, '[^A-Za-z0-9 \t\n\x0B\f\r();,./\\äöüß§€\[\]_-]', '', 'g') AS lang
FROM documents""")
def clean_rules(spark, d):
    docs = S.table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    rules = [Q.CleanRule("TYPE", ANY_EXCLUDE, type="ANY"),
             Q.CleanRule("NAME", DIGITS_ONLY, column="SOURCE"),
             Q.CleanRule("TYPE", r"[^0-9Ee.+-]", type="FLOAT")]   # no float column: no effect
    return Q.apply_clean_rules(docs, rules)


@register("id_mapping", ["DOC2", "JON4"], "WITH " + _SQL_IDS + """,
mp AS (SELECT egk_nr, pid FROM s3 WHERE egk_nr <> '')
SELECT ids.row_id, ids.egk_nr, COALESCE(mp.pid, '') AS pid
FROM ids LEFT JOIN mp ON mp.egk_nr = ids.egk_nr""")
def id_mapping(spark, d):
    ids, unwanted = _ids_and_unwanted(spark, d)
    decoded = D.clean_ids(ids, unwanted, ["seen", "row_id"])
    egk2pid = decoded.filter(F.col("egk_nr") != "").select("egk_nr", "pid")
    target = ids.select("row_id", "egk_nr")
    return Q.map_ids(target, egk2pid, "egk_nr", "pid")


@register("malformed_counts", ["D13", "DOC1"], """
WITH t AS (
  SELECT CASE WHEN l_linenumber = 3 THEN ' 5 ' WHEN l_linenumber = 4 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS packages,
    CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%d.%m.%Y') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day,
    CASE WHEN l_quantity > 40 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS amount FROM lineitem)
SELECT 'packages' AS "column", 'int' AS kind, count(*) FILTER (packages <> '') AS n_values,
  count(*) FILTER (packages <> '' AND NOT regexp_full_match(packages, '[+-]?[0-9]+')) AS n_malformed FROM t
UNION ALL SELECT 'day', 'date', count(*) FILTER (day <> ''), count(*) FILTER (NOT regexp_full_match(day, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) FROM t
UNION ALL SELECT 'amount', 'float', count(*) FILTER (amount <> ''), count(*) FILTER (amount = 'n/a') FROM t""")
def malformed_counts(spark, d):
    li = S.table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") == 3, " 5 ").when(F.col("l_linenumber") == 4, "").otherwise(F.col("l_partkey").cast("string")).alias("packages"),
        F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("l_quantity") > 40, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("amount"))
    return Q.malformed_counts(li, {"packages": "int", "day": "date", "amount": "float"})


@register("strict_read_rejects", ["SRC3", "D13"], """
WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p,
  CASE WHEN o_orderstatus = 'P' THEN 'a;b' WHEN o_orderstatus = 'O' AND o_totalprice > 250000 THEN NULL ELSE o_clerk END AS c
  FROM (SELECT *, 'c' || CAST(o_custkey AS VARCHAR) AS o_clerk FROM orders)),
l AS (SELECT k, p, c, CASE WHEN c IS NULL THEN 2 WHEN c = 'a;b' THEN 4 ELSE 3 END AS n FROM t)
SELECT CASE WHEN n = 3 THEN k END AS key, CASE WHEN n = 3 THEN p END AS priority, CASE WHEN n = 3 THEN c END AS clerk,
  CASE WHEN n <> 3 THEN k || ';' || p || COALESCE(';' || c, '') END AS line,
  CASE WHEN n <> 3 THEN CAST(n AS VARCHAR) || ' fields instead of 3' END AS reason,
  (SELECT count(*) FROM l WHERE n = 3) + 1 AS n_rows, (SELECT count(*) FROM l WHERE n <> 3) AS n_rejects
FROM l
UNION ALL SELECT 'key', 'priority', 'clerk', NULL, NULL, (SELECT count(*) FROM l WHERE n = 3) + 1, (SELECT count(*) FROM l WHERE n <> 3)""")
def strict_read_rejects(spark, d):
    """Files with lines of too few and too many fields and a data line that equals the header: rows, rejects and counts of one scan."""
    clerk = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    odd = F.when(F.col("o_orderstatus") == "P", "a;b").when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 250000), F.lit(None)).otherwise(clerk)
    lines = S.table(spark, d, "orders").select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority", odd).alias("key;priority;clerk"))
    lines = lines.unionAll(spark.createDataFrame([("key;priority;clerk",)], "line string"))
    path = scratch_path(spark, "strict")
    lines.write.option("header", True).option("sep", R.NO_SEP).option("quote", "\u0000").csv(path)
    read = R.read_delimited_once(spark, path, ["key", "priority", "clerk"], scratch_path(spark, "strict-read"))
    none = F.lit(None).cast("string")
    both = read.rows.select("key", "priority", "clerk", none.alias("line"), none.alias("reason")).unionAll(
        read.rejects.select(none, none, none, "_text", "_reason"))
    return both.withColumns({"n_rows": F.lit(read.n_rows).cast("long"), "n_rejects": F.lit(read.n_rejects).cast("long")})


@register("code_page_roundtrip", ["DOC5"], """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ' – „' || p_brand || '“ ' || CAST(p_size AS VARCHAR) || ' € äöüß' AS label FROM part""")
def code_page_roundtrip(spark, d):
    """Characters that windows-1252 has at 0x80 to 0x9F, written and read in that code page."""
    size = F.col("p_size").cast("string")
    part = S.table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.concat("p_name", F.lit(" – „"), "p_brand", F.lit("“ "), size, F.lit(" € äöüß")).alias("label"))
    path = scratch_path(spark, "cp1252")
    W.write_slices(part, path, fmt="csv", encoding="windows-1252")
    return R.read_slices(spark, path, encoding="windows-1252")
