"""Registered comorbidity-score queries (JON6, WIN5, AGG12, SCL14, SRC8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwise.operators import score as SC
from claimwise.plans import standins as S
from claimwise.plans.registry import register

YEARS = S.STAT_YEARS

# Score pattern configuration (icd_code prefix, disease class, weight); in
# production this is the pattern file read with ``sources.readers.read_score_patterns``.
PATTERNS = [
    ("AF", "af", 1), ("AF3", "af", 3), ("NO", "no", 2), ("R_7", "r7", 4),
    ("RF1", "rf", 6), ("N%5", "n5", 1), ("AO12", "ao", 5), ("NF", "nf", 2),
]


# Configured insurers of the score sources.
INSURERS = ["0", "1", "2"]


def patterns(spark):
    return spark.createDataFrame(PATTERNS, "icd_code string, disease_class string, cci_weight int")


def diagnosis_facts(spark, d, *more):
    """Diagnosis facts from lineitem: person = supplier, code from flags, line and part; ``more``: further columns."""
    li = S.table(spark, d, "lineitem")
    ship = F.to_date("l_shipdate")
    return li.select(
        S.pid_of("l_suppkey").alias("pid"),
        F.when(F.col("l_returnflag").isin("A", "N"), F.lit("arzt_diagnose"))
        .otherwise(F.lit("kh_diagnose")).alias("source_table"),
        F.year(ship).alias("year"), F.quarter(ship).alias("quarter"),
        F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"),
                 (F.col("l_partkey") % 10).cast("string")).alias("icd_code"),
        (F.col("l_orderkey") % 3).cast("string").alias("h2ik"), *more)


_PATS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', {c})" for a, b, c in PATTERNS) + \
    ") p(pattern, disease_class, cci_weight)"
_FACTS_SQL = f"""
facts AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS pid,
    CASE WHEN l_returnflag IN ('A', 'N') THEN 'arzt_diagnose' ELSE 'kh_diagnose' END AS source_table,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
    l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) || CAST(l_partkey % 10 AS VARCHAR) AS icd_code,
    CAST(l_orderkey % 3 AS VARCHAR) AS h2ik
  FROM lineitem),
m AS (SELECT f.*, p.pattern, p.disease_class, p.cci_weight FROM facts f JOIN {_PATS_SQL}
      ON f.icd_code LIKE p.pattern || '%')
"""


@register("score_pattern_join", ["JON6"], "WITH " + _FACTS_SQL + "SELECT * FROM m")
def score_pattern_join(spark, d):
    return SC.pattern_join(diagnosis_facts(spark, d), patterns(spark))


@register("score_patterns_from_file", ["SRC8", "JON6"], "WITH " + _FACTS_SQL.replace(f"JOIN {_PATS_SQL}", """JOIN (
  SELECT 'N%' || CAST(p_size AS VARCHAR) AS pattern, 'c' || CAST(p_size % 7 AS VARCHAR) AS disease_class,
    CAST(p_size % 5 + 1 AS INTEGER) AS cci_weight FROM part WHERE p_type = 'PROMO' GROUP BY p_size) p""") + "SELECT * FROM m")
def score_patterns_from_file(spark, d):
    """Patterns written as a file (derived from part) and read back."""
    from claimwise.session import scratch_path
    from claimwise.sources.readers import read_score_patterns

    path = scratch_path(spark, "patterns")
    size = F.col("p_size")
    (S.table(spark, d, "part").filter("p_type = 'PROMO'").select("p_size").distinct()
     .select(F.concat(F.lit("N%"), size.cast("string")).alias("icd_code"), F.concat(F.lit("c"), (size % 7).cast("string")).alias("disease_class"),
             (size % 5 + 1).alias("cci_weight"))
     .write.option("header", True).option("sep", ";").csv(path))
    return SC.pattern_join(diagnosis_facts(spark, d), read_score_patterns(spark, path))


_Y0, _Y1 = YEARS
_FIRST, _LAST = _Y0 * 4, _Y1 * 4 + 3
_CAP = int(S.AS_OF[:4]) * 4 + 3


def _qtext(idx: str, begin: bool) -> str:
    mm = ("'0101'", "'0401'", "'0701'", "'1001'") if begin else ("'0331'", "'0630'", "'0930'", "'1231'")
    return (f"CAST(CAST(floor({idx} / 4) AS BIGINT) AS VARCHAR) || CASE {idx} % 4 WHEN 0 THEN {mm[0]} "
            f"WHEN 1 THEN {mm[1]} WHEN 2 THEN {mm[2]} ELSE {mm[3]} END")


@register("score_sliding", ["WIN5", "AGG12", "SCL14", "SNK6", "D4", "D5"], "WITH " + _FACTS_SQL + f""",
red AS (
  SELECT source_table, pid, year * 4 + quarter - 1 AS qi, disease_class, max(cci_weight) AS w, min(h2ik) AS ins
  FROM m WHERE year * 4 + quarter - 1 BETWEEN {_FIRST} AND least({_LAST + 3}, {_CAP}) GROUP BY ALL),
win AS (SELECT CAST(s AS BIGINT) AS st FROM range({_FIRST}, {_LAST + 1}) t(s)),
x AS (SELECT red.*, win.st FROM red JOIN win ON red.qi BETWEEN win.st AND least(win.st + 3, {_CAP})),
pc AS (SELECT source_table, pid, st, disease_class, max(w) AS w, min(ins) AS ins FROM x GROUP BY ALL),
sc AS (SELECT source_table, pid, st, CAST(sum(w) AS INTEGER) AS weight, min(ins) AS h2ik FROM pc GROUP BY ALL)
SELECT source_table, pid, {_qtext('st', True)} AS window_start, {_qtext(f'least(st + 3, {_CAP})', False)} AS window_end,
  weight, h2ik FROM sc""")
def score_sliding(spark, d):
    matched = SC.pattern_join(diagnosis_facts(spark, d), patterns(spark))
    return SC.sliding_scores(matched, _Y0, _Y1, S.AS_OF, insurers=INSURERS)


@register("score_files", ["SNK6", "WIN5"], "WITH " + _FACTS_SQL + f""",
red AS (
  SELECT source_table, pid, year * 4 + quarter - 1 AS qi, disease_class, max(cci_weight) AS w, min(h2ik) AS ins
  FROM m WHERE year * 4 + quarter - 1 BETWEEN {_FIRST} AND least({_LAST + 3}, {_CAP}) GROUP BY ALL),
win AS (SELECT CAST(s AS BIGINT) AS st FROM range({_FIRST}, {_LAST + 1}) t(s)),
x AS (SELECT red.*, win.st FROM red JOIN win ON red.qi BETWEEN win.st AND least(win.st + 3, {_CAP})),
pc AS (SELECT source_table, pid, st, disease_class, max(w) AS w, min(ins) AS ins FROM x GROUP BY ALL),
sc AS (SELECT source_table, pid, st, CAST(sum(w) AS INTEGER) AS weight, min(ins) AS h2ik FROM pc GROUP BY ALL)
SELECT source_table, pid, {_qtext('st', True)} AS window_start, {_qtext(f'least(st + 3, {_CAP})', False)} AS window_end,
  weight, h2ik FROM sc""")
def score_files(spark, d):
    """Score rows written as files partitioned by source table and window start, then
    read back (the partition columns come back from the directory names)."""
    from claimwise.session import scratch_path
    from claimwise.sources.sinks import write_scores

    path = scratch_path(spark, "cci")
    write_scores(score_sliding(spark, d), path)
    back = spark.read.parquet(path)
    return back.select("source_table", "pid", F.col("window_start").cast("string").alias("window_start"),
                       "window_end", "weight", "h2ik")


_SOURCES = [{"db": "ADB", "dataset": "first", "iks": ["0", "1"]}, {"db": "ADB", "dataset": "second", "iks": ["1", "2"]}, {"db": "FDB", "dataset": "flagged", "flag": "large"}]
_MEMBERS = {"first": "h2ik IN ('0', '1')", "second": "h2ik IN ('1', '2')", "flagged": "flag_large"}


@register("scores_from_config", ["WIN5", "AGG12", "JON6", "SRC8", "SCL14", "FLT15"], "WITH " + _FACTS_SQL.replace("AS h2ik\n", "AS h2ik, l_quantity > 25 AS flag_large\n") + f""",
s AS ({" UNION ALL ".join(f"SELECT '{n}' AS dataset, * FROM m WHERE {w}" for n, w in _MEMBERS.items())}),
red AS (
  SELECT dataset, source_table, pid, year * 4 + quarter - 1 AS qi, disease_class, max(cci_weight) AS w, min(h2ik) AS ins
  FROM s WHERE year * 4 + quarter - 1 BETWEEN {_FIRST} AND least({_LAST + 3}, {_CAP}) GROUP BY ALL),
win AS (SELECT CAST(s AS BIGINT) AS st FROM range({_FIRST}, {_LAST + 1}) t(s)),
x AS (SELECT red.*, win.st FROM red JOIN win ON red.qi BETWEEN win.st AND least(win.st + 3, {_CAP})),
pc AS (SELECT dataset, source_table, pid, st, disease_class, max(w) AS w, min(ins) AS ins FROM x GROUP BY ALL),
sc AS (SELECT dataset, source_table, pid, st, CAST(sum(w) AS INTEGER) AS weight, min(ins) AS h2ik FROM pc GROUP BY ALL)
SELECT dataset, source_table, pid, {_qtext('st', True)} AS window_start, {_qtext(f'least(st + 3, {_CAP})', False)} AS window_end,
  weight, h2ik FROM sc""")
def scores_from_config(spark, d):
    """Scores of three configured sources, two of which share an insurer and one goes by a flag, with patterns from a file."""
    from claimwise.plans.config import scores_from_config as run
    from claimwise.session import scratch_path

    path = scratch_path(spark, "patterns")
    patterns(spark).write.option("header", True).option("sep", ";").csv(path)
    facts = diagnosis_facts(spark, d, (F.col("l_quantity") > 25).alias("flag_large"))
    conf = {"cci": {"cciFile": path, "startYear": _Y0, "endYear": _Y1, "sources": _SOURCES}}
    return run(spark, conf, facts, S.AS_OF)
