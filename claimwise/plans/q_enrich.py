"""Registered enrichment queries (ENR1-8, JON4-5, AGG13-14, SCL5-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.operators.rowfilters import FrameMeta
from claimwise.plans import standins as S
from claimwise.plans.registry import register

AM_EVO = FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO")
ARZT_FALL = FrameMeta("ACC_ADB", "AVK_ADB_T_ARZT_FALL")
VERS_STAMM = FrameMeta("ACC_ADB", "AVK_ADB_T_VERS_STAMM")


def prescriptions(spark, d, stored=()):
    """AM_EVO stand-in (export layer: strings); ``stored``: columns of the table that stay beside."""
    li = S.table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", *stored,
        F.when(F.col("l_linenumber") == 7, F.col("l_partkey").cast("string"))
        .otherwise(F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("pzn"),
        F.col("l_quantity").cast("string").alias("anzahl_packungen"),
        F.to_date("l_shipdate").cast("string").alias("verordnungsdatum"),
        F.when(F.col("l_suppkey") < 5, F.col("l_suppkey").cast("string"))
        .otherwise((F.col("l_suppkey") * 1013).cast("string")).alias("bs_nr"),
        F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("26"), F.col("l_suppkey")))
        .when(F.col("l_suppkey") % 5 == 1, F.concat(F.lit("30"), F.col("l_suppkey")))
        .when(F.col("l_suppkey") % 5 == 2, F.lit(""))
        .when(F.col("l_suppkey") % 5 == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("11"), F.col("l_suppkey"))).alias("apothekenik"),
    )


def _main_source(spark, d, with_pack=False, with_name=False):
    p = S.table(spark, d, "part").filter(F.col("p_type") != "PROMO")
    cols = [
        F.col("p_partkey").alias("key"),
        F.lpad(F.floor(F.col("p_retailprice") * 10).cast("long").cast("string"), 9, "0").alias(E.DDD),
        F.col("p_brand").alias(E.APPFORM),
        F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(
            F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size") * 40), "yyyyMMdd"))
        .alias(E.ADMISSION),
        F.when(F.col("p_size") > 35, F.date_format(
            F.date_add(F.lit("1996-06-01").cast("date"), F.col("p_size") * 30), "yyyyMMdd"))
        .otherwise(F.lit("")).alias(E.RETIREMENT),
    ]
    data, meta = [E.DDD, E.APPFORM], [E.ADMISSION, E.RETIREMENT]
    if with_pack:
        cols.append(F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(
            F.col("p_size").cast("string")).alias(E.PACK_SIZE))
        meta.append(E.PACK_SIZE)
    if with_name:
        cols.append(F.when(F.col("p_size") % 6 == 0, F.concat("p_name", F.lit("  *NV* x")))
                    .when(F.col("p_size") % 6 == 1, F.concat("p_name", F.lit(" NV")))
                    .otherwise(F.col("p_name")).alias(E.NAME))
        data.append(E.NAME)
    return E.CatalogueSource(p.select(*cols), tuple(data), tuple(meta))


def _supplement(spark, d):
    p = S.table(spark, d, "part").filter(F.col("p_type").isin("PROMO", "SMALL"))
    return E.CatalogueSource(p.select(
        F.col("p_partkey").alias("key"),
        F.when(F.col("p_size") % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias(E.GENERIC),
        F.lpad((F.col("p_size") * 100).cast("string"), 9, "0").alias(E.DDD)),
        (E.GENERIC, E.DDD))


def _drug(spark, d, with_pack=False, with_name=False):
    step = E.DrugCatalogue((_main_source(spark, d, with_pack, with_name), _supplement(spark, d)))
    return E.run_chain(prescriptions(spark, d), [step], AM_EVO)


def _drug_sql(select: str, with_pack=False, with_name=False, rx_extra: str = "", rx_where: str = "") -> str:
    extra_main = ""
    extra_cat = ""
    if with_pack:
        extra_main += ", CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS pack"
        extra_cat += ", m.pack"
    if with_name:
        extra_main += (", CASE WHEN p_size % 6 = 0 THEN p_name || '  *NV* x' "
                       "WHEN p_size % 6 = 1 THEN p_name || ' NV' ELSE p_name END AS nm")
        extra_cat += ", m.nm"
    return f"""
WITH main AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS k,
    lpad(CAST(CAST(floor(p_retailprice * 10) AS BIGINT) AS VARCHAR), 9, '0') AS ddd,
    p_brand AS appform,
    CASE WHEN p_size % 5 = 0 THEN '' ELSE strftime(DATE '1995-01-01' + p_size * 40, '%Y%m%d') END AS adm,
    CASE WHEN p_size > 35 THEN strftime(DATE '1996-06-01' + p_size * 30, '%Y%m%d') ELSE '' END AS ret
    {extra_main}
  FROM part WHERE p_type <> 'PROMO'),
supp AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS k, lpad(CAST(p_size * 100 AS VARCHAR), 9, '0') AS ddd,
    CASE WHEN p_size % 2 = 0 THEN '1' ELSE '0' END AS gen
  FROM part WHERE p_type IN ('PROMO', 'SMALL')),
cat AS (
  SELECT COALESCE(m.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.ddd ELSE m.ddd END AS ddd,
    m.appform, s.gen, m.k IS NOT NULL AS rng,
    CASE WHEN m.k IS NOT NULL AND m.adm <> '' THEN CAST(strptime(m.adm, '%Y%m%d') AS DATE) END AS sd,
    CASE WHEN m.k IS NOT NULL AND m.ret <> '' THEN CAST(strptime(m.ret, '%Y%m%d') AS DATE) END AS ed
    {extra_cat}
  FROM main m FULL OUTER JOIN supp s ON m.k = s.k),
rx AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN CAST(l_partkey AS VARCHAR) ELSE lpad(CAST(l_partkey AS VARCHAR), 8, '0') END AS pzn,
    l_quantity AS pk, CAST(l_shipdate AS DATE) AS d {rx_extra}
  FROM lineitem {rx_where}),
j AS (SELECT * FROM rx LEFT JOIN cat ON cat.k = rx.pzn)
SELECT {select} FROM j"""


def _gate(v: str) -> str:
    z = "CAST(0 AS DOUBLE)"
    return (f"(CASE WHEN NOT COALESCE(rng, false) THEN {v} "
            f"WHEN sd IS NOT NULL AND ed IS NULL THEN CASE WHEN d >= sd THEN {v} ELSE {z} END "
            f"WHEN sd IS NULL AND ed IS NOT NULL THEN CASE WHEN d < ed THEN {v} ELSE {z} END "
            f"WHEN sd IS NOT NULL AND ed IS NOT NULL THEN CASE WHEN d >= sd AND d < ed THEN {v} ELSE {z} END "
            f"ELSE {z} END)")


_DDD_SQL = ("CASE WHEN COALESCE(ddd, '') = '' THEN NULL ELSE "
            + _gate("CAST(ddd AS BIGINT) / CAST(1000 AS DOUBLE) * pk") + ' END AS "DDD"')


@register("drug_doses", ["ENR2", "JON5", "AGG13", "AGG14", "SCL7", "SCL9"], _drug_sql(
    "l_orderkey, l_linenumber, pzn, " + _DDD_SQL
    + ", COALESCE(appform, '') AS \"APPFORM\", COALESCE(gen, '') AS \"GENERIKENN\""))
def drug_doses(spark, d):
    return _drug(spark, d).select("l_orderkey", "l_linenumber", "pzn", E.DDD, E.APPFORM, E.GENERIC)


@register("drug_amount", ["ENR2", "SCL8", "SCL9"], _drug_sql(
    "l_orderkey, l_linenumber, pzn, " + _DDD_SQL
    + ", CASE WHEN COALESCE(pack, '') = '' THEN NULL ELSE "
    + _gate("CAST(pack AS BIGINT) / CAST(10 AS DOUBLE) * pk") + ' END AS "Menge_berechnet"',
    with_pack=True))
def drug_amount(spark, d):
    return _drug(spark, d, with_pack=True).select("l_orderkey", "l_linenumber", "pzn", E.DDD, E.AMOUNT)


@register("drug_name_flag", ["ENR2", "SCL10", "SCL11"], _drug_sql(
    "l_orderkey, l_linenumber, pzn, " + _DDD_SQL
    + ", CASE WHEN k IS NULL THEN '' WHEN nm IS NULL THEN '' "
      "ELSE regexp_replace(split_part(nm, '*NV*', 1), '^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') END AS \"STANAME\""
    + ", CASE WHEN k IS NULL THEN '' WHEN nm IS NULL THEN '' WHEN contains(nm, 'NV') THEN '0' ELSE '1' END"
      " AS \"IS_CLASSIFIED\"",
    with_name=True))
def drug_name_flag(spark, d):
    return _drug(spark, d, with_name=True).select(
        "l_orderkey", "l_linenumber", "pzn", E.DDD, E.NAME, E.IS_CLASSIFIED)


@register("region_map", ["ENR3", "SCL5"], """
SELECT l_orderkey, l_linenumber, bs_nr,
  CASE WHEN length(bs_nr) < 2 THEN '' ELSE (CASE
    WHEN sub = 1 THEN '01' WHEN sub = 2 THEN '02' WHEN sub = 3 THEN '03'
    WHEN sub BETWEEN 6 AND 17 THEN '17' WHEN sub BETWEEN 18 AND 20 THEN '20'
    WHEN sub IN (21, 24, 25, 27, 28, 31, 37, 38) THEN '38' WHEN sub BETWEEN 39 AND 46 THEN '46'
    WHEN sub BETWEEN 47 AND 51 THEN '51' WHEN sub BETWEEN 52 AND 62 THEN '52'
    WHEN sub BETWEEN 63 AND 71 THEN '71' WHEN sub = 72 THEN '72' WHEN sub = 73 THEN '73'
    WHEN sub = 78 THEN '78' WHEN sub IN (79, 80, 81, 83) THEN '83' WHEN sub IN (85, 86, 87, 88) THEN '88'
    WHEN sub IN (89, 90, 91, 93) THEN '93' WHEN sub IN (94, 95, 96, 98) THEN '98' ELSE '' END) END AS kv
FROM (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_suppkey < 5 THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey * 1013 AS VARCHAR) END AS bs_nr
      FROM lineitem) x,
LATERAL (SELECT TRY_CAST(substr(bs_nr, 1, 2) AS INTEGER) AS sub) y""")
def region_map(spark, d):
    out = E.run_chain(prescriptions(spark, d), [E.RegionFromPractice()], AM_EVO)
    return out.select("l_orderkey", "l_linenumber", "bs_nr", "kv")


@register("pharmacy_type", ["ENR4"], """
SELECT l_orderkey, l_linenumber,
  CASE WHEN ik IS NULL OR ik = '' THEN '' WHEN substr(ik, 1, 2) IN ('26', '30') THEN substr(ik, 1, 2) ELSE '00' END
  AS apo_typ
FROM (SELECT l_orderkey, l_linenumber,
  CASE l_suppkey % 5 WHEN 0 THEN '26' || CAST(l_suppkey AS VARCHAR) WHEN 1 THEN '30' || CAST(l_suppkey AS VARCHAR)
       WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '11' || CAST(l_suppkey AS VARCHAR) END AS ik FROM lineitem) x""")
def pharmacy_type_q(spark, d):
    step = E.PharmacyType(table="am_evo")
    return E.run_chain(prescriptions(spark, d), [step], AM_EVO).select("l_orderkey", "l_linenumber", "apo_typ")


def _sick_leave(spark, d):
    o = S.table(spark, d, "orders")
    k = F.col("o_orderkey") % 5
    return o.select(
        "o_orderkey",
        F.to_date("o_orderdate").cast("string").alias("leistungs_ende"),
        F.when(k == 0, F.lit("3")).when(k == 1, F.lit("0")).when(k == 2, F.lit("(()3"))
        .when(k == 3, F.lit(" 5 ")).otherwise(F.lit("12")).alias("kg_tage"))


@register("start_date", ["ENR6", "D13"], """
SELECT o_orderkey,
  strftime(CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) - 2
               WHEN o_orderkey % 5 = 4 THEN CAST(o_orderdate AS DATE) - 11
               ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS kg_beginn
FROM orders""")
def start_date(spark, d):
    step = E.StartDate("leistungs_ende", "kg_tage", "kg_beginn", table="au_fall")
    return E.run_chain(_sick_leave(spark, d), [step], FrameMeta("ACC_ADB", "AVK_ADB_T_AU_FALL")).select(
        "o_orderkey", "kg_beginn")


def _arzt_fall(spark, d):
    c = S.outpatient_cases(spark, d)
    k = F.col("efn_id") % 3
    return c.select(
        "efn_id", "vertrags_id",
        F.col("bezugsjahr").cast("string").alias("bezugsjahr"),
        F.col("behandl_quartal").cast("string").alias("behandl_quartal"),
        F.when(k == 0, F.lit("")).otherwise(F.date_format("behandl_datum", "yyyyMMdd")).alias("behandl_beginn"),
        F.when(k == 1, F.lit("")).otherwise(F.date_format("behandl_datum", "yyyyMMdd")).alias("behandl_ende"))


@register("fix_dates", ["ENR7", "SCL4", "D8"], """
SELECT efn_id, vertrags_id,
  CASE WHEN upper(vertrags_id) = 'KV' AND b = '' THEN y || CASE q WHEN 2 THEN '0401' WHEN 3 THEN '0701' WHEN 4 THEN '1001' ELSE '0101' END ELSE b END AS behandl_beginn,
  CASE WHEN upper(vertrags_id) = 'KV' AND e = '' THEN y || CASE q WHEN 2 THEN '0630' WHEN 3 THEN '0930' WHEN 4 THEN '1231' ELSE '0331' END ELSE e END AS behandl_ende
FROM (SELECT o_orderkey AS efn_id,
        CASE o_orderstatus WHEN 'F' THEN 'KV' WHEN 'O' THEN 'kv' ELSE 'SV' END AS vertrags_id,
        CAST(year(o_orderdate) AS VARCHAR) AS y, quarter(o_orderdate) AS q,
        CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS b,
        CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE strftime(o_orderdate, '%Y%m%d') END AS e
      FROM orders) x""")
def fix_dates(spark, d):
    out = E.run_chain(_arzt_fall(spark, d), [E.FixMissingDates()], ARZT_FALL)
    return out.select("efn_id", "vertrags_id", "behandl_beginn", "behandl_ende")


@register("pid_hash", ["ENR8", "SCL12"], """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS pid, sha256(lpad(CAST(c_custkey AS VARCHAR), 10, '0')) AS pid_hash
FROM customer""")
def pid_hash(spark, d):
    base = S.table(spark, d, "customer").select(S.pid_of("c_custkey").alias("pid"))
    return E.run_chain(base, [E.PseudoHash()], VERS_STAMM)


@register("lookup_append", ["ENR5", "JON4", "D12"], """
WITH m AS (
  SELECT o_orderstatus AS k1, o_orderpriority AS k2, CAST(count(*) AS VARCHAR) AS value1,
         CAST(min(o_orderkey) AS VARCHAR) AS value2
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2)
SELECT o_orderkey, o_orderstatus, o_orderpriority, COALESCE(m.value1, '') AS value1, COALESCE(m.value2, '') AS value2
FROM orders LEFT JOIN m ON m.k1 = o_orderstatus AND m.k2 = o_orderpriority""")
def lookup_append(spark, d):
    o = S.table(spark, d, "orders")
    mapping = (o.filter(F.col("o_orderstatus") != "P")
               .groupBy(F.col("o_orderstatus").alias("vertrags_id"), F.col("o_orderpriority").alias("efn_id"))
               .agg(F.count("*").cast("string").alias("value1"),
                    F.min("o_orderkey").cast("string").alias("value2")))
    rows = o.select("o_orderkey", F.col("o_orderstatus").alias("vertrags_id"),
                    F.col("o_orderpriority").alias("efn_id"))
    out = E.run_chain(rows, [E.LookupColumns(mapping, ("vertrags_id", "efn_id"))], ARZT_FALL)
    return out.select("o_orderkey", F.col("vertrags_id").alias("o_orderstatus"),
                      F.col("efn_id").alias("o_orderpriority"), "value1", "value2")


_REGION_CASE = """CASE WHEN length(bs_nr) < 2 THEN '' ELSE (CASE
    WHEN sub = 1 THEN '01' WHEN sub = 2 THEN '02' WHEN sub = 3 THEN '03'
    WHEN sub BETWEEN 6 AND 17 THEN '17' WHEN sub BETWEEN 18 AND 20 THEN '20'
    WHEN sub IN (21, 24, 25, 27, 28, 31, 37, 38) THEN '38' WHEN sub BETWEEN 39 AND 46 THEN '46'
    WHEN sub BETWEEN 47 AND 51 THEN '51' WHEN sub BETWEEN 52 AND 62 THEN '52'
    WHEN sub BETWEEN 63 AND 71 THEN '71' WHEN sub = 72 THEN '72' WHEN sub = 73 THEN '73'
    WHEN sub = 78 THEN '78' WHEN sub IN (79, 80, 81, 83) THEN '83' WHEN sub IN (85, 86, 87, 88) THEN '88'
    WHEN sub IN (89, 90, 91, 93) THEN '93' WHEN sub IN (94, 95, 96, 98) THEN '98' ELSE '' END) END"""

_RX_EXTRA = """, CASE WHEN l_suppkey < 5 THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey * 1013 AS VARCHAR) END AS bs_nr,
    TRY_CAST(substr(CASE WHEN l_suppkey < 5 THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey * 1013 AS VARCHAR) END, 1, 2)
             AS INTEGER) AS sub,
    CASE l_suppkey % 5 WHEN 0 THEN '26' || CAST(l_suppkey AS VARCHAR) WHEN 1 THEN '30' || CAST(l_suppkey AS VARCHAR)
       WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '11' || CAST(l_suppkey AS VARCHAR) END AS ik"""


@register("export_chain", ["ENR1", "FLT18", "FLT8", "FLT11", "FLT12", "SRC1", "SRC2", "SCL18"], _drug_sql(
    "'101575519' AS h2ik, l_orderkey, l_linenumber, pzn, " + _REGION_CASE + " AS kv, "
    "CASE WHEN ik IS NULL OR ik = '' THEN '' WHEN substr(ik, 1, 2) IN ('26', '30') THEN substr(ik, 1, 2) "
    "ELSE '00' END AS apo_typ, " + _DDD_SQL,
    rx_extra=_RX_EXTRA,
    rx_where="WHERE year(l_shipdate) BETWEEN 1996 AND 2000 "
             "AND NOT regexp_full_match(CASE WHEN l_linenumber = 7 THEN CAST(l_partkey AS VARCHAR) "
             "ELSE lpad(CAST(l_partkey AS VARCHAR), 8, '0') END, '0000[0-9]{2}')"))
def export_chain(spark, d):
    """The export of one view: year slice, configured row filter, then the ordered
    enrichment chain (steps for other tables and invalid steps leave the frame as it is)."""
    from claimwise.operators import rowfilters as RF
    from claimwise.operators.extract import ExtractSpec, YearSlice, extract

    rx = prescriptions(spark, d, ("l_shipdate",)).withColumn("bezugsjahr", F.year("l_shipdate"))
    view = extract(rx, ExtractSpec(year_slice=YearSlice("bezugsjahr", 1996, 2000, date_column="l_shipdate"), exclude=("l_shipdate",)))
    view = RF.apply_filters(view, [RF.RowFilter("pzn", RF.RegexStrategy("0000[0-9]{2}"), "EXCLUDE")], AM_EVO)
    steps = [
        E.StaticColumn("h2ik", "101575519", first=True, table="am_evo"),
        E.FixMissingDates(),                       # targets outpatient cases: skipped here
        E.Noop("unknown mode"),
        E.RegionFromPractice(),
        E.PharmacyType(table="am_evo"),
        E.DrugCatalogue((_main_source(spark, d), _supplement(spark, d))),
        E.PseudoHash(),                            # targets the master table: skipped here
    ]
    out = E.run_chain(view, steps, AM_EVO)
    return out.select("h2ik", "l_orderkey", "l_linenumber", "pzn", "kv", "apo_typ", E.DDD)


@register("catalogue_by_index_file", ["SRC5", "ENR2", "JON5"], """
SELECT l.l_orderkey, l.l_linenumber,
  CASE WHEN l.l_returnflag = 'R' THEN 'R' || CAST(l.l_partkey AS VARCHAR) ELSE lpad(CAST(l.l_partkey AS VARCHAR), 8, '0') END AS pzn,
  COALESCE(CASE WHEN p.p_size < 10 THEN p.p_type ELSE p.p_brand END, '') AS "WARENZ"
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND l.l_returnflag <> 'R'""")
def catalogue_by_index_file(spark, d):
    """A headerless catalogue of several files whose keys repeat (the last line of a key wins), read by position and
    appended; the package ids of returned lines are unknown to it."""
    from claimwise.plans.config import step_of
    from claimwise.session import scratch_path

    part = S.table(spark, d, "part")
    first = part.select(F.lit(0).alias("no"), "p_partkey", F.concat_ws(";", F.lit("x"), "p_partkey", "p_brand").alias("value"))
    again = part.filter("p_size < 10").select(F.lit(1).alias("no"), "p_partkey", F.concat_ws(";", F.lit("y"), "p_partkey", "p_type").alias("value"))
    path = scratch_path(spark, "catalogue")
    # the order of lines is that of the files' names and of the lines in them
    first.unionByName(again).repartitionByRange("no", "p_partkey").sortWithinPartitions("no", "p_partkey").select("value").write.text(path)
    step = step_of(spark, {"mode": "DDD", "targetTable": "am_evo", "keyColumn": "pzn", "sources": [
        {"file": path, "keyColumnIndex": 1, "columns": [{"index": 2, "column": "WARENZ"}]}]})
    pzn = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("R"), F.col("l_partkey").cast("string"))).otherwise(F.lpad(F.col("l_partkey").cast("string"), 8, "0"))
    rx = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", pzn.alias("pzn"))
    return E.run_chain(rx, [step], FrameMeta("ACC_ADB", "AVK_ADB_T_AM_EVO"))


@register("export_from_config", ["ENR1", "ENR10", "SRC6", "FLT5", "FLT8", "JON2"], """
SELECT 'D1' AS dataset, o.o_orderkey, CASE WHEN o.o_orderpriority = '5-LOW' THEN 'x' ELSE CAST(o.o_custkey AS VARCHAR) END AS mapped,
  CAST(o.o_custkey AS VARCHAR) AS o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS bezugsjahr, c.c_name, COALESCE(m.c_mktsegment, '') AS segment
FROM orders o LEFT OUTER JOIN customer c ON c.c_custkey = o.o_custkey
LEFT OUTER JOIN customer m ON m.c_custkey = o.o_custkey AND o.o_orderpriority <> '5-LOW'
WHERE c.c_acctbal > 0 AND year(o.o_orderdate) BETWEEN 1996 AND 1998 AND o.o_orderstatus IN ('F', 'O')""")
def export_from_config(spark, d):
    """A whole export from one configuration text: slice, conditions (of the joined view too), join, static column, mapping file
    with keys that miss, and steps without effect (unknown mode, catalogue without sources)."""
    import json

    from claimwise.plans.config import export_from_config as run
    from claimwise.session import scratch_path

    path = scratch_path(spark, "mapping")
    customer = S.table(spark, d, "customer")
    (customer.select(F.col("c_custkey").cast("string").alias("mapped"), F.col("c_mktsegment").alias("segment"))
     .write.option("header", True).option("sep", ";").csv(path))
    key = F.col("o_custkey").cast("string")
    orders = S.table(spark, d, "orders").withColumn("bezugsjahr", F.year("o_orderdate")).withColumns(
        {"mapped": F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise(key), "o_custkey": key})
    frames = {"ORDERS": orders, "CUSTOMER": customer.withColumn("o_custkey", F.col("c_custkey").cast("string"))}
    conf = {
        "db": "ACC_ADB", "datasetName": "d1", "yearSlice": {"column": "bezugsjahr", "startYear": 1996, "endYear": 1998, "dateColumn": "o_orderdate"},
        "where": [{"column": "o_orderstatus", "operator": "EQUAL", "columnType": "STRING", "values": ["F", "O"]}],
        "views": [{"name": "ORDERS", "columns": ["o_orderkey", "mapped", "o_custkey", "bezugsjahr", "c_name"], "joins": [
            {"name": "CUSTOMER", "joinType": "LEFT", "onColumns": ["o_custkey"], "excludeColumns": ["c_custkey"],
             "where": [{"column": "c_acctbal", "operator": "GREATER", "columnType": "NUMERIC", "values": ["0"]}]}]}],
        "transformers": [{"mode": "STATIC", "valueName": "dataset", "value": "D1", "order": "FIRST", "targetTable": "ORDERS"},
                         {"mode": "DYNAMIC", "file": path, "keyColumns": ["mapped"]}, {"mode": "SOMETHING"}, {"mode": "DDD", "keyColumn": "pzn"}]}
    return run(spark, json.dumps(conf), frames)["ORDERS"]


class _Prefix:
    """A user's own strategy: values that start with a text."""

    def __init__(self, text: str):
        self.text = text

    def predicate(self, c):
        return c.startswith(self.text)


@register("export_filters_from_config", ["FLT11", "FLT12", "FLT13", "FLT14", "ENR1"], """
SELECT o_orderkey, o_orderpriority, o_orderstatus, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS pid FROM orders
WHERE regexp_full_match(o_orderpriority, '[1-4]-.*') AND o_orderstatus NOT IN ('P') AND NOT starts_with(o_orderpriority, '4')
  AND lpad(CAST(o_custkey AS VARCHAR), 10, '0') NOT IN (
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer WHERE c_mktsegment = 'MACHINERY' OR c_acctbal < 0)""")
def export_filters_from_config(spark, d):
    """Configured filters: a pattern, a value set, staff ids and a user's own strategy; one names another database and does not apply."""
    from claimwise.functions.scalars import pad_zeros
    from claimwise.plans import config as C
    from claimwise.plans.q_extract import _person_ids

    if "STARTS_WITH" not in C.STRATEGIES:
        C.register_strategy("STARTS_WITH", lambda spark, c, frames: _Prefix(c["text"]))
    orders = S.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", pad_zeros("o_custkey", 10).alias("pid"))
    frames = {"T_ORDERS": orders, "T_PERSONS": _person_ids(spark, d)}
    conf = {"sources": [{"db": "ACC_ADB", "views": [{"name": "T_ORDERS"}]}], "filters": [
        {"name": "urgent", "column": "o_orderpriority", "filterStrategy": {"type": "PATTERN", "regexPattern": "[1-4]-.*"}, "mode": "INCLUDE"},
        {"name": "open", "column": "o_orderstatus", "table": "t_orders", "filterStrategy": {"type": "UNIQUE_SET", "values": ["P"]}, "mode": "EXCLUDE"},
        {"name": "staff", "column": "pid", "database": "ACC_ADB", "filterStrategy": {"type": "EMPLOYEE_PIDS", "view": "T_PERSONS"}, "mode": "EXCLUDE"},
        {"name": "own", "column": "o_orderpriority", "filterStrategy": {"type": "STARTS_WITH", "text": "4"}, "mode": "EXCLUDE"},
        {"name": "elsewhere", "column": "o_orderstatus", "database": "ACC_FDB", "filterStrategy": {"type": "UNIQUE_SET"}, "mode": "INCLUDE"}]}
    return C.export_from_config(spark, conf, frames)["T_ORDERS"]
