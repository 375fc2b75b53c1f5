"""Registered statistics queries (AGG1-6, AGG15, WIN3-4, WIN6, JON7-8, SNK7, SCL15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from claimwise.operators import stats
from claimwise.plans import standins as S
from claimwise.plans.registry import register

Y0, Y1 = S.STAT_YEARS


def _years(df, column, bounded):
    """Rows of the configured years, by the stored date: the bounds reach the scan."""
    c = F.col(column)
    return df.filter((c >= F.lit(dt.date(Y0, 1, 1))) & (c < F.lit(dt.date(Y1 + 1, 1, 1)))) if bounded else df


def _slices(spark, d, bounded=False):
    li = _years(S.table(spark, d, "lineitem"), "l_shipdate", bounded)
    o = _years(S.table(spark, d, "orders"), "o_orderdate", bounded)
    cases = _years(S.outpatient_cases(spark, d), "o_orderdate", bounded)
    ship = F.to_date("l_shipdate")
    odate = F.to_date("o_orderdate")
    return {
        "remedies": stats.cases_per_date_quarter(li, F.year(ship), ship, "l_orderkey"),
        "hospital": stats.cases_pre_aggregated(o, F.year(odate), odate, "o_orderkey"),
        "outpatient": stats.contract_cases_per_quarter(
            cases, "bezugsjahr", "behandl_quartal", "efn_id", "vertrags_id"),
        "sick_leave": stats.concat_key_per_quarter(
            cases, "bezugsjahr", "behandl_datum", "pid", F.col("behandl_datum").cast("string")),
        "prescriptions": stats.daily_distinct_per_quarter(
            li, F.year(ship), ship, "l_orderkey", "l_partkey", "l_suppkey"),
    }


_COUNTS_SQL = {
    "remedies": """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
            COUNT(DISTINCT l_orderkey) AS cnt FROM lineitem GROUP BY 1, 2""",
    "hospital": """SELECT year, quarter, CAST(SUM(n) AS BIGINT) AS cnt FROM (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
            COUNT(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1, 2) v GROUP BY year, quarter""",
    "outpatient": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
            COUNT(DISTINCT o_orderkey) AS cnt FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2""",
    "sick_leave": """SELECT year, quarter, CAST(SUM(n) AS BIGINT) AS cnt FROM (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
            COUNT(DISTINCT lpad(CAST(o_custkey AS VARCHAR), 10, '0') || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS n
            FROM orders GROUP BY 1, 2) a GROUP BY year, quarter""",
    "prescriptions": """SELECT year, quarter, CAST(SUM(n) AS BIGINT) AS cnt FROM (
            SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_shipdate AS DATE) AS d,
            CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
            COUNT(DISTINCT CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR)) AS n
            FROM lineitem GROUP BY 1, 2, 3) v GROUP BY year, quarter""",
}


@register("overview_cases", ["AGG1", "SCL4"], _COUNTS_SQL["remedies"])
def overview_cases(spark, d):
    return _slices(spark, d)["remedies"]


@register("overview_hospital", ["AGG2"], _COUNTS_SQL["hospital"])
def overview_hospital(spark, d):
    return _slices(spark, d)["hospital"]


@register("overview_cases_contract", ["AGG3", "D8"], _COUNTS_SQL["outpatient"])
def overview_cases_contract(spark, d):
    return _slices(spark, d)["outpatient"]


@register("overview_concat_key", ["AGG4"], _COUNTS_SQL["sick_leave"])
def overview_concat_key(spark, d):
    return _slices(spark, d)["sick_leave"]


@register("overview_daily_distinct", ["AGG5"], _COUNTS_SQL["prescriptions"])
def overview_daily_distinct(spark, d):
    return _slices(spark, d)["prescriptions"]


_SLICE_NAMES = list(_COUNTS_SQL)
_ALL_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS slice, year, quarter, cnt FROM ({sql}) s_{i}"
    for i, (name, sql) in enumerate(_COUNTS_SQL.items()))
_OVERVIEW_SQL = f"""
WITH counts AS ({_ALL_COUNTS}),
cal AS (
  SELECT s.slice, CAST(y.y AS INTEGER) AS year, CAST(q.q AS INTEGER) AS quarter
  FROM (VALUES {", ".join(f"('{n}')" for n in _SLICE_NAMES)}) s(slice),
       range({Y0}, {Y1 + 1}) y(y), range(1, 5) q(q)
),
padded AS (
  SELECT cal.slice, cal.year, cal.quarter, COALESCE(c.cnt, 0) AS cnt
  FROM cal LEFT JOIN counts c ON c.slice = cal.slice AND c.year = cal.year AND c.quarter = cal.quarter
),
r AS (
  SELECT slice, year, quarter, cnt,
    CASE WHEN lag(cnt, 4) OVER w IS NULL OR lag(cnt, 4) OVER w = 0 THEN CAST(0 AS DOUBLE)
         ELSE cnt / CAST(lag(cnt, 4) OVER w AS DOUBLE) END AS ratio,
    row_number() OVER w AS pos
  FROM padded WINDOW w AS (PARTITION BY slice ORDER BY year, quarter)
)
"""


@register("overview_ratio", ["WIN3", "WIN4", "SCL15"],
          _OVERVIEW_SQL + "SELECT slice, year, quarter, cnt, ratio, "
                          "(pos > 4 AND (ratio > 1.5 OR ratio < 0.5)) AS out_of_tolerance FROM r")
def overview_ratio(spark, d):
    return stats.overview(_slices(spark, d, True), Y0, Y1)


@register("overview_pivot", ["SNK7"],
          _OVERVIEW_SQL + "SELECT year, quarter, "
          + ", ".join(f"max(CASE WHEN slice = '{n}' THEN cnt END) AS {n}" for n in _SLICE_NAMES)
          + " FROM r GROUP BY year, quarter")
def overview_pivot(spark, d):
    return stats.overview_pivot(stats.overview(_slices(spark, d, True), Y0, Y1), _SLICE_NAMES)


_REF_SQL = f"""SELECT year, quarter FROM ({_COUNTS_SQL['outpatient']}) c
WHERE cnt > 0 AND year BETWEEN {Y0} AND {Y1} ORDER BY year DESC, quarter DESC LIMIT 1"""


@register("reference_quarter", ["AGG15", "SRT2"], _REF_SQL)
def reference_quarter(spark, d):
    return stats.reference_quarter(_slices(spark, d, True)["outpatient"], Y0, Y1)


@register("regional_ratio", ["AGG6", "JON7", "JON8", "WIN6", "FLT17", "SRT1", "D3", "D16"], f"""
WITH ref AS ({_REF_SQL}),
cases AS (
  SELECT o.o_orderkey AS id, CAST(year(o.o_orderdate) AS INTEGER) AS y, CAST(quarter(o.o_orderdate) AS INTEGER) AS q,
         lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS kv
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderstatus IN ('F', 'O')
),
a AS (
  SELECT kv,
    COUNT(DISTINCT CASE WHEN y = ref.year THEN id END) AS cnt,
    COUNT(DISTINCT CASE WHEN y = ref.year - 1 THEN id END) AS prev_cnt
  FROM cases, ref WHERE q = ref.quarter AND (y = ref.year OR y = ref.year - 1) GROUP BY kv
),
lk AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS kv, n_name AS kv_name,
    CASE WHEN n_regionkey = 4 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS km6_id,
    CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN n_nationkey % 3 = 1 THEN 'lab note' ELSE 'other' END AS hinweis
  FROM nation
)
SELECT lk.kv, lk.kv_name, ref.year, ref.quarter, COALESCE(a.cnt, 0) AS cnt, COALESCE(a.prev_cnt, 0) AS prev_cnt,
  CASE WHEN COALESCE(a.prev_cnt, 0) > 0 THEN a.cnt / CAST(a.prev_cnt AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ratio
FROM lk LEFT JOIN a ON a.kv = lk.kv CROSS JOIN ref
WHERE lk.km6_id <> '' AND (lk.hinweis IS NULL OR lk.hinweis LIKE '%ab%')
""")
def regional_ratio(spark, d):
    ref = stats.reference_quarter(_slices(spark, d, True)["outpatient"], Y0, Y1)
    return stats.regional_ratio(S.outpatient_cases(spark, d), S.region_lookup(spark, d), ref,
                                year="bezugsjahr", quarter="behandl_quartal", case_id="efn_id",
                                region="kv", contract_col="vertrags_id",
                                regions=S.person_regions(spark, d), region_key="o_custkey", date_column="o_orderdate")


_SETS = {"statistics": {"datasets": [
    {"db": "ADB", "dataset": "first", "views": ["remedies", "prescriptions", "hospital", "outpatient", "sick_leave"], "h2iks": ["A", "N", "1-URGENT", "2-HIGH"], "startYear": 1995, "endYear": 1998},
    {"db": "ADB", "dataset": "wide", "views": ["remedies", "hospital", "outpatient"], "h2iks": ["R", "A", "1-URGENT", "5-LOW"], "startYear": 1993, "endYear": 2001},
    {"db": "FDB", "dataset": "flagged", "views": ["prescriptions", "outpatient"], "flag": "large", "startYear": 1996, "endYear": 1999}]}}


def _set_counts(slice_, key, year, quarter, table, insurer, flag, day="NULL", where="true"):
    """Oracle: the counts of one slice, one query per data set."""
    parts = []
    for s in _SETS["statistics"]["datasets"]:
        if slice_ in s["views"]:
            member = f"{flag}" if s.get("flag") else f"{insurer} IN ({', '.join(repr(x) for x in s['h2iks'])})"
            parts.append(f"""SELECT '{s['dataset']}' AS dataset, '{slice_}' AS slice, CAST({year} AS INTEGER) AS year, CAST({quarter} AS INTEGER) AS quarter,
              COUNT(DISTINCT (COALESCE(CAST({day} AS VARCHAR), '') || '|' || CAST({key} AS VARCHAR))) AS cnt
              FROM {table} WHERE {member} AND {year} BETWEEN {s['startYear']} AND {s['endYear']} AND {where} GROUP BY ALL""")
    return " UNION ALL ".join(parts)


_LINE = ("year(l_shipdate)", "quarter(l_shipdate)", "lineitem", "l_returnflag", "l_quantity > 25")
_ORDER = ("year(o_orderdate)", "quarter(o_orderdate)", "orders", "o_orderpriority", "o_totalprice > 150000")
_BY_SET_SQL = "WITH counts AS (" + " UNION ALL ".join([
    _set_counts("remedies", "l_orderkey", *_LINE),
    _set_counts("prescriptions", "CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR)", *_LINE, day="CAST(l_shipdate AS DATE)"),
    _set_counts("hospital", "o_orderkey", *_ORDER), _set_counts("outpatient", "o_orderkey", *_ORDER, where="o_orderstatus IN ('F', 'O')"),
    _set_counts("sick_leave", "lpad(CAST(o_custkey AS VARCHAR), 10, '0') || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)", *_ORDER)]) + "),\ncal AS (" + " UNION ALL ".join(
    f"SELECT '{s['dataset']}' AS dataset, v AS slice, CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter "
    f"FROM (SELECT unnest({s['views']}) AS v), range({s['startYear']}, {s['endYear'] + 1}) t(y), range(1, 5) u(q)" for s in _SETS["statistics"]["datasets"]) + """),
padded AS (SELECT cal.*, COALESCE(c.cnt, 0) AS cnt FROM cal LEFT JOIN counts c USING (dataset, slice, year, quarter)),
r AS (SELECT *, lag(cnt, 4) OVER w AS before, row_number() OVER w AS pos FROM padded WINDOW w AS (PARTITION BY dataset, slice ORDER BY year, quarter)),
x AS (SELECT *, CASE WHEN COALESCE(before, 0) = 0 THEN CAST(0 AS DOUBLE) ELSE cnt / CAST(before AS DOUBLE) END AS ratio FROM r)
SELECT dataset, slice, year, quarter, cnt, ratio, (pos > 4 AND (ratio > 1.5 OR ratio < 0.5)) AS out_of_tolerance FROM x"""


def _counts_of_all_sets(spark, d, sets):
    """One frame of counts for each table, which is scanned once."""
    li, o = S.table(spark, d, "lineitem"), S.table(spark, d, "orders")
    ship, day = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    lines = li.select("l_orderkey", "l_partkey", "l_suppkey", ship.alias("ship"), F.col("l_returnflag").alias("h2ik"), (F.col("l_quantity") > 25).alias("flag_large"))
    cases = o.select("o_orderkey", S.pid_of("o_custkey").alias("pid"), day.alias("day"), F.col("o_orderpriority").alias("h2ik"),
                     F.col("o_orderstatus").isin("F", "O").alias("kv"), (F.col("o_totalprice") > 150000).alias("flag_large"))
    at = (F.year("ship"), F.quarter("ship"))
    of = (F.year("day"), F.quarter("day"))
    return [stats.counts_by_dataset(lines, sets, [
        stats.Measure("remedies", F.col("l_orderkey").cast("string"), *at),
        stats.Measure("prescriptions", F.concat(*[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey")]), *at, day=F.col("ship"))]),
        stats.counts_by_dataset(cases, sets, [
            stats.Measure("hospital", F.col("o_orderkey").cast("string"), *of),
            stats.Measure("outpatient", F.col("o_orderkey").cast("string"), *of, where=F.col("kv")),
            stats.Measure("sick_leave", F.concat("pid", F.col("day").cast("string")), *of)])]


@register("overview_all_datasets", ["SNK7", "AGG1", "AGG2", "AGG3", "AGG4", "AGG5", "FLT15", "WIN3", "WIN4", "SCL15"], _BY_SET_SQL)
def overview_all_datasets(spark, d):
    """The overviews of three configured data sets that share insurers and have their own slices and years."""
    from claimwise.plans.config import datasets_of

    sets = datasets_of(_SETS)
    return stats.overview_by_dataset(_counts_of_all_sets(spark, d, sets), sets)


_REPORT_SQL = """
SELECT 'Kasse ' || lower(c_mktsegment) AS insurance, 'S' || CAST(c_nationkey % 3 AS VARCHAR) AS setup,
  CAST(2000 + c_nationkey % 3 AS VARCHAR) AS grouper_year, CAST(2001 + c_nationkey % 3 AS VARCHAR) AS benefit_year,
  CAST(2002 + c_nationkey % 3 AS VARCHAR) AS reporting_year, CAST(1 + count(*) % 4 AS VARCHAR) AS quarter,
  CAST(count(*) AS VARCHAR) AS configuration
FROM customer GROUP BY c_mktsegment, c_nationkey % 3"""


@register("morbidity_report_lookup", ["SRC9", "JON13"],
          "SELECT * FROM (" + _REPORT_SQL + ") r WHERE contains(lower(insurance), 'building') "
          "OR contains(lower(insurance), 'acc_adb')")
def morbidity_report_lookup(spark, d):
    """Report file (written from customer by Spark), read back, rows of the insurer whose
    name contains the database or the dataset name."""
    from claimwise.session import scratch_path
    from claimwise.sources.readers import read_morbidity_report
    from claimwise.sources.sinks import write_slices

    c = S.table(spark, d, "customer")
    m = F.col("c_nationkey") % 3
    report = (c.groupBy(F.col("c_mktsegment"), m.alias("_m")).agg(F.count("*").alias("_n"))
              .select(F.concat(F.lit("Kasse "), F.lower("c_mktsegment")).alias("insurance"),
                      F.concat(F.lit("S"), F.col("_m").cast("string")).alias("setup"),
                      (F.col("_m") + 2000).cast("string").alias("grouper_year"),
                      (F.col("_m") + 2001).cast("string").alias("benefit_year"),
                      (F.col("_m") + 2002).cast("string").alias("reporting_year"),
                      (F.col("_n") % 4 + 1).cast("string").alias("quarter"),
                      F.col("_n").cast("string").alias("configuration")))
    path = scratch_path(spark, "morbi")
    write_slices(report, path, fmt="csv")
    return stats.report_for_dataset(read_morbidity_report(spark, path), "ACC_ADB", "Building")


@register("cases_per_listed_year", ["SCL17", "AGG1"], f"""
SELECT CAST(y AS INTEGER) AS year, h2ik, CAST(COALESCE(n, 0) AS BIGINT) AS cnt
FROM (SELECT y, h2ik FROM range({Y0}, {Y1 + 1}) t(y), (SELECT DISTINCT o_orderpriority AS h2ik FROM orders)) k
LEFT JOIN (SELECT year(o_orderdate) AS oy, o_orderpriority AS op, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY ALL) c
  ON c.oy = k.y AND c.op = k.h2ik""")
def cases_per_listed_year(spark, d):
    """Cases of every insurer in every configured year, years without cases as 0."""
    from claimwise.functions.scalars import year_list

    cases = S.outpatient_cases(spark, d)
    counts = cases.groupBy(F.col("bezugsjahr").alias("year"), "h2ik").agg(F.count_distinct("efn_id").alias("cnt"))
    listed = cases.select("h2ik").distinct().withColumn("year", F.explode(year_list(F.lit(Y0), F.lit(Y1))))
    return listed.join(counts, ["year", "h2ik"], "left").select("year", "h2ik", F.coalesce("cnt", F.lit(0)).alias("cnt"))
