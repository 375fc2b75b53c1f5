"""Registered person queries (AGG8-11, AGG17-18, JON12, ENR11, SCL6, SCL13, SCL16, SET1, SET3, FLT16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwise.functions.scalars import coarse_quarter_date
from claimwise.operators import enrich as E
from claimwise.operators import fingerprint as FP
from claimwise.operators.rowfilters import FrameMeta, certain_diagnoses
from claimwise.plans import standins as S
from claimwise.plans.registry import register


def customer_rows(spark, d):
    """Vers_Stamm stand-in: one row per customer."""
    c = S.table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        S.pid_of("c_custkey").alias("pid"),
        F.when(k % 11 == 0, F.lit("")).when(k % 13 == 0, F.lit("unknown"))
        .otherwise(F.date_format(F.date_add(F.lit("1930-01-01").cast("date"), ((k * 37) % 25000).cast("int")), "yyyy-MM-dd"))
        .alias("geburtsdatum"),
        F.when(F.col("c_acctbal") < 0, F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (k % 700).cast("int")),
                                                     "yyyy-MM-dd")).otherwise(F.lit("")).alias("sterbedatum"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("1"))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("2"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit("W"))
        .otherwise(F.lit("2x")).alias("geschlecht"))


def base_rows(spark, d):
    """All rows of Vers_Stamm: those of the customers and extra rows from pending orders."""
    o = S.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    extra = o.select(
        S.pid_of("o_custkey").alias("pid"),
        F.date_format(F.add_months(F.to_date("o_orderdate"), -720), "yyyy-MM-dd").alias("geburtsdatum"),
        F.lit("").alias("sterbedatum"), F.lit("1").alias("geschlecht"))
    return customer_rows(spark, d).unionByName(extra)


def region_rows(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(
        S.pid_of("o_custkey").alias("pid"), F.year("o_orderdate").alias("bezugsjahr"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(""))
        .otherwise(F.lpad((F.col("o_totalprice").cast("long") % 100000).cast("string"), 5, "0")).alias("kgs"))


def diagnosis_rows(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(
        S.pid_of("o_custkey").alias("pid"), F.year("o_orderdate").alias("bezugsjahr"),
        F.concat(F.lit("I"), (F.col("o_totalprice").cast("long") % 7).cast("string")).alias("code"),
        F.when(F.col("o_orderstatus") == "F", F.lit("G")).when(F.col("o_orderstatus") == "O", F.lit("g"))
        .otherwise(F.lit("V")).alias("diagnosesicherheit"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("KV")).otherwise(F.lit("kv ")).alias("vertrags_id"))


def drug_rows(spark, d):
    li = S.table(spark, d, "lineitem")
    o = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(o, "l_orderkey").select(
        S.pid_of("o_custkey").alias("pid"), F.year("l_shipdate").alias("bezugsjahr"),
        F.lpad((F.col("l_partkey") % 50).cast("string"), 8, "0").alias("code"))


def _fingerprints(spark, d):
    icd = certain_diagnoses(diagnosis_rows(spark, d))
    return FP.fingerprints(base_rows(spark, d), region_rows(spark, d), icd, drug_rows(spark, d))


_SQL_ROWS = """
base AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS pid,
    CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'unknown'
         ELSE strftime(DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER), '%Y-%m-%d') END AS geburtsdatum,
    CASE WHEN c_acctbal < 0 THEN strftime(DATE '2000-01-01' + CAST(c_custkey % 700 AS INTEGER), '%Y-%m-%d') ELSE '' END
      AS sterbedatum,
    CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'AUTOMOBILE' THEN '2' WHEN 'MACHINERY' THEN ''
         WHEN 'FURNITURE' THEN 'W' ELSE '2x' END AS geschlecht
  FROM customer
  UNION ALL
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0'), strftime(CAST(o_orderdate AS DATE) - INTERVAL 720 MONTH, '%Y-%m-%d'),
    '', '1'
  FROM orders WHERE o_orderstatus = 'P'),
region AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS pid,
    CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE lpad(CAST(CAST(trunc(o_totalprice) AS BIGINT) % 100000 AS VARCHAR), 5, '0') END
      AS kgs
  FROM orders),
diag AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS pid, CAST(year(o_orderdate) AS INTEGER) AS y,
    'I' || CAST(CAST(trunc(o_totalprice) AS BIGINT) % 7 AS VARCHAR) AS c
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 2 = 0),
drug AS (
  SELECT lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS pid, CAST(year(l.l_shipdate) AS INTEGER) AS y,
    lpad(CAST(l.l_partkey % 50 AS VARCHAR), 8, '0') AS c
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
pb AS (
  SELECT pid,
    min(CASE WHEN regexp_full_match(geburtsdatum, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(geburtsdatum AS DATE) END) AS dob,
    min(CASE WHEN regexp_full_match(sterbedatum, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(sterbedatum AS DATE) END) AS dod,
    min(CASE WHEN substr(geschlecht, 1, 1) <> '' AND substr(geschlecht, 1, 1) < '9' THEN substr(geschlecht, 1, 1) END) AS gender
  FROM base GROUP BY pid),
kg AS (
  SELECT pid, min(CASE WHEN kgs <> '' AND kgs < '999999' THEN kgs END) AS min_kgs,
    max(CASE WHEN kgs > '000000' THEN kgs END) AS max_kgs
  FROM region GROUP BY pid),
icd AS (
  SELECT pid, string_agg(c, '_' ORDER BY y, c) AS icds FROM diag GROUP BY pid),
pzn AS (
  SELECT pid, string_agg(c, '_' ORDER BY y, c) AS pzns FROM drug GROUP BY pid),
fp AS (
  SELECT pb.pid, sha256(concat_ws('_', COALESCE(CAST(dob AS VARCHAR), '1900-01-01'), COALESCE(CAST(dod AS VARCHAR), '2999-12-31'),
    COALESCE(gender, '0'), COALESCE(min_kgs, '00000'), COALESCE(max_kgs, '00000'), COALESCE(icds, '0000'),
    COALESCE(pzns, '00000000'))) AS fingerprint
  FROM pb LEFT JOIN kg ON kg.pid = pb.pid LEFT JOIN icd ON icd.pid = pb.pid LEFT JOIN pzn ON pzn.pid = pb.pid)
"""


@register("person_minmax", ["AGG8", "AGG9", "SCL13", "SCL16", "D14", "AGG17"], "WITH " + _SQL_ROWS + """
SELECT pb.pid, COALESCE(dob, DATE '1900-01-01') AS dob, COALESCE(dod, DATE '2999-12-31') AS dod,
  COALESCE(gender, '0') AS gender, COALESCE(min_kgs, '00000') AS min_kgs, COALESCE(max_kgs, '00000') AS max_kgs
FROM pb LEFT JOIN kg ON kg.pid = pb.pid""")
def person_minmax(spark, d):
    return FP.person_summary(base_rows(spark, d), region_rows(spark, d))


@register("person_fingerprint", ["AGG10", "AGG11", "JON12", "FLT16", "SCL12", "SCL16", "D6"],
          "WITH " + _SQL_ROWS + "SELECT pid, fingerprint FROM fp")
def person_fingerprint(spark, d):
    return _fingerprints(spark, d)


@register("fingerprint_append", ["ENR11", "SNK5"], "WITH " + _SQL_ROWS + """
SELECT c.c_custkey, lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') AS pid, c.c_name, COALESCE(fp.fingerprint, '') AS pid_hash
FROM customer c LEFT JOIN fp ON fp.pid = lpad(CAST(c.c_custkey AS VARCHAR), 10, '0')""")
def fingerprint_append(spark, d):
    master = S.table(spark, d, "customer").select(
        "c_custkey", S.pid_of("c_custkey").alias("pid"), "c_name",
        F.lit("stale").alias("pid_hash"))
    step = E.FingerprintColumn(_fingerprints(spark, d))
    updated = E.run_chain(master, [step], FrameMeta("ACC_ADB", "AVK_ADB_T_VERS_STAMM"))
    # the updated master table is a new version next to the old one
    from claimwise.session import scratch_path
    from claimwise.sources import versions as V

    base = scratch_path(spark, "vers_stamm")
    V.create(updated.withColumn("region", F.substring("pid", -1, 1)), base, "region")
    return V.read(spark, base).drop("region")


def _yearly(spark, d):
    """The four frames with a year each; customers stand in the first one."""
    extra = S.table(spark, d, "orders").filter(F.col("o_orderstatus") == "P").select(
        S.pid_of("o_custkey").alias("pid"), F.date_format(F.add_months(F.to_date("o_orderdate"), -720), "yyyy-MM-dd").alias("geburtsdatum"),
        F.lit("").alias("sterbedatum"), F.lit("1").alias("geschlecht"), F.year("o_orderdate").alias("bezugsjahr"))
    base = customer_rows(spark, d).withColumn("bezugsjahr", F.lit(FIRST_YEAR)).unionByName(extra)
    return base, region_rows(spark, d), certain_diagnoses(diagnosis_rows(spark, d)), drug_rows(spark, d)


#: First and last year of the data, and the last year that is there before the others are added.
FIRST_YEAR, LAST_YEAR, KNOWN_YEAR = 1992, 2010, 1997


@register("fingerprint_incremental", ["AGG8", "AGG9", "AGG10", "AGG11", "JON12", "D6"],
          "WITH " + _SQL_ROWS + "SELECT pid, fingerprint FROM fp")
def fingerprint_incremental(spark, d):
    """States of the years up to 1997 are stored, later years are added, one year is computed again; the merged fingerprints."""
    from claimwise.session import scratch_path

    path = scratch_path(spark, "states")
    frames = _yearly(spark, d)
    FP.add_years(*frames, list(range(FIRST_YEAR, KNOWN_YEAR + 1)), path)
    FP.add_years(*frames, list(range(KNOWN_YEAR, LAST_YEAR + 1)), path)
    return FP.merged_fingerprints(spark.read.parquet(path), FIRST_YEAR, LAST_YEAR)


@register("fingerprint_from_config", ["AGG8", "AGG9", "AGG10", "AGG11", "JON12"], "WITH " + _SQL_ROWS
          .replace("FROM customer\n  UNION ALL", "FROM customer WHERE false\n  UNION ALL")
          .replace("FROM orders WHERE o_orderstatus = 'P')", "FROM orders WHERE o_orderstatus = 'P' AND year(o_orderdate) BETWEEN 1996 AND 1998)")
          .replace("AS kgs\n  FROM orders)", "AS kgs\n  FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998)")
          .replace("AND o_orderkey % 2 = 0)", "AND o_orderkey % 2 = 0 AND year(o_orderdate) BETWEEN 1996 AND 1998)")
          .replace("ON o.o_orderkey = l.l_orderkey)", "ON o.o_orderkey = l.l_orderkey WHERE year(l.l_shipdate) BETWEEN 1996 AND 1998)")
          + "SELECT pid, fingerprint FROM fp")
def fingerprint_from_config(spark, d):
    """Fingerprints over the configured years alone, from stored states of which one year is there before."""
    from claimwise.plans.config import fingerprints_from_config as run
    from claimwise.session import scratch_path

    base, region, _, drugs = _yearly(spark, d)
    states = scratch_path(spark, "states")
    FP.add_years(base, region, certain_diagnoses(diagnosis_rows(spark, d)), drugs, [1997], states)
    return run({"hashing": {"minYear": 1996, "maxYear": 1998}}, base, region, diagnosis_rows(spark, d), drugs, states)


@register("master_versions", ["SNK5", "ENR11"], """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS pid, c_name, CAST(c_nationkey AS INTEGER) AS region,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN '' WHEN c_nationkey < 4 THEN sha256(c_name || '2') ELSE sha256(c_name) END AS pid_hash,
  CASE WHEN c_nationkey < 4 THEN 3 ELSE 2 END AS written
FROM customer""")
def master_versions(spark, d):
    """A master table by region in three versions: created, a column added, the column changed for some regions' persons."""
    from claimwise.session import scratch_path
    from claimwise.sources import versions as V

    base = scratch_path(spark, "master")
    c = S.table(spark, d, "customer")
    V.create(c.select(S.pid_of("c_custkey").alias("pid"), "c_name", F.col("c_nationkey").alias("region")), base, "region")
    wanted = c.filter("c_mktsegment <> 'MACHINERY'")
    for text in (F.col("c_name"), F.when(F.col("c_nationkey") < 4, F.concat("c_name", F.lit("2"))).otherwise(F.col("c_name"))):
        V.update_column(spark, base, wanted.select(S.pid_of("c_custkey").alias("pid"), F.sha2(text, 256).alias("pid_hash")), "pid", "pid_hash")
    last = V.newest(spark, base)
    written = {s: int(p.split("/v=")[1].split("-")[0]) for s, p in last.paths.items()}
    by_slice = spark.createDataFrame([(int(s), n) for s, n in written.items()], "region int, written int")
    return V.read(spark, base, last).join(by_slice, "region").select("pid", "c_name", "region", "pid_hash", "written")


@register("distinct_union_sentinel", ["SET1", "SET3"], "WITH " + _SQL_ROWS + """
SELECT DISTINCT pid, c AS code FROM diag
UNION
SELECT pid, '0000' AS code FROM pb WHERE pid NOT IN (SELECT pid FROM diag)""")
def distinct_union_sentinel(spark, d):
    icd = certain_diagnoses(diagnosis_rows(spark, d))
    persons = FP.person_base(base_rows(spark, d))
    return FP.codes_with_sentinel(icd, persons)


@register("distinct_persons_from_year", ["AGG18", "SCL6"], """
SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS pid,
  CAST(year(o_orderdate) AS VARCHAR) || '-0' || CAST(quarter(o_orderdate) AS VARCHAR) || '-01' AS first_quarter
FROM orders WHERE year(o_orderdate) >= 2000""")
def distinct_persons_from_year(spark, d):
    o = S.table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("date"))
    return o.select(S.pid_of("o_custkey").alias("pid"),
                    coarse_quarter_date(F.to_date("o_orderdate")).alias("first_quarter")).distinct()
