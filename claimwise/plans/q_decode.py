"""Registered id-decode queries (AGG7, JON9-11, WIN1-2, AGG16, SCL3, SCL19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimwise.operators import decode as D
from claimwise.plans import standins as S
from claimwise.plans.registry import register

INSURERS = ["1", "2", "3", "4"]


def _id_columns(k):
    return [
        F.when(k % 97 == 0, F.lit("")).otherwise(F.substring("o_orderpriority", 1, 1)).alias("h2ik"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("E"), (k % 2000).cast("string"))).alias("egk_nr"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("K"), (k % 3000).cast("string"))).alias("kv_nummer"),
        F.when(k % 89 == 0, F.lit("")).otherwise((F.col("o_custkey") + 10000).cast("string")).alias("pid"),
        F.to_date("o_orderdate").alias("seen"), k.alias("row_id")]


def id_rows(spark, d):
    """PID_AKTUELL stand-in from orders: one id row per order, cards and numbers shared."""
    return S.table(spark, d, "orders").select(*_id_columns(F.col("o_orderkey")))


def membership(spark, d):
    """MENSCH_AKTUELL stand-in: validity end per (insurer, card, person), same scan of orders."""
    o = S.table(spark, d, "orders")
    rows = o.select(*_id_columns(F.col("o_orderkey")), "o_totalprice")
    # every seventh order carries no validity end (NULL), like a person without membership
    valid_to = F.when(F.col("row_id") % 7 != 0, F.date_add("seen", (F.col("o_totalprice").cast("int") % 400)))
    return (rows.groupBy("h2ik", "egk_nr", F.col("pid").alias("k_mensch_id"))
            .agg(F.max(valid_to).alias("max_gueltig_bis")))


def _decode_sql(insurers, all_rows=True):
    """Oracle: id rows, exclusion list of the insurers' cards, three first-wins passes (``s0b`` to ``s3``)."""
    own = "(" + ", ".join(f"'{x}'" for x in insurers) + ")"
    return f"""
ids AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE substr(o_orderpriority, 1, 1) END AS h2ik,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'E' || CAST(o_orderkey % 2000 AS VARCHAR) END AS egk_nr,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'K' || CAST(o_orderkey % 3000 AS VARCHAR) END AS kv_nummer,
    CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE CAST(o_custkey + 10000 AS VARCHAR) END AS pid,
    CAST(o_orderdate AS DATE) AS seen, o_orderkey AS row_id, o_totalprice
  FROM orders),
ends AS (
  SELECT h2ik, egk_nr, pid, max(CASE WHEN row_id % 7 <> 0 THEN seen + CAST(CAST(trunc(o_totalprice) AS BIGINT) % 400 AS INTEGER) END) AS until
  FROM ids GROUP BY ALL),
holders AS (
  SELECT DISTINCT a.egk_nr, a.pid, COALESCE(ends.until, DATE '0001-01-01') AS until
  FROM ids a LEFT JOIN ends ON ends.h2ik = a.h2ik AND ends.egk_nr = a.egk_nr AND ends.pid = a.pid
  WHERE a.h2ik IN {own} AND a.egk_nr <> ''
    AND EXISTS (SELECT 1 FROM ids b WHERE b.egk_nr = a.egk_nr AND b.h2ik IN {own} AND b.row_id <> a.row_id)),
earliest AS (SELECT egk_nr, min(until) AS until FROM holders GROUP BY egk_nr),
unwanted AS (
  SELECT DISTINCT CASE WHEN length(pid) BETWEEN 5 AND 9 THEN lpad(pid, 10, '0') END AS pid
  FROM holders JOIN earliest USING (egk_nr, until)),
s0b AS (
  SELECT h2ik, egk_nr, kv_nummer, CASE WHEN length(pid) < 10 THEN lpad(pid, 10, '0') ELSE pid END AS pid, seen, row_id
  FROM ids WHERE h2ik <> '' AND pid <> '' AND {"true" if all_rows else "h2ik IN " + own}
    AND NOT EXISTS (SELECT 1 FROM unwanted u WHERE u.pid = CASE WHEN length(ids.pid) < 10 THEN lpad(ids.pid, 10, '0') ELSE ids.pid END)),
s1 AS (SELECT a.* FROM s0b a JOIN (SELECT pid, min((seen, row_id)) AS f FROM s0b GROUP BY pid) m ON m.pid = a.pid AND m.f = (a.seen, a.row_id)),
s2 AS (SELECT a.* FROM s1 a LEFT JOIN (SELECT egk_nr, min((seen, row_id)) AS f FROM s1 GROUP BY egk_nr) m USING (egk_nr)
       WHERE a.egk_nr = '' OR m.f = (a.seen, a.row_id)),
s3 AS (SELECT a.* FROM s2 a LEFT JOIN (SELECT kv_nummer, min((seen, row_id)) AS f FROM s2 GROUP BY kv_nummer) m USING (kv_nummer)
       WHERE a.kv_nummer = '' OR m.f = (a.seen, a.row_id))
"""


_SQL_IDS = _decode_sql(INSURERS)


def _unwanted(spark, d):
    return D.outdated_card_holders(id_rows(spark, d), membership(spark, d), INSURERS)


def _ids_and_unwanted(spark, d):
    """The id rows and the exclusion list, each computed once for all that reads them."""
    from claimwise.session import written

    ids = written(id_rows(spark, d), "ids")
    return ids, written(D.outdated_card_holders(ids, membership(spark, d), INSURERS), "unwanted")


@register("duplicate_cards_rank", ["AGG7", "JON9", "JON10", "WIN1", "SCL3", "SET3"],
          "WITH " + _SQL_IDS + "SELECT pid FROM unwanted WHERE pid IS NOT NULL")
def duplicate_cards_rank(spark, d):
    return _unwanted(spark, d)


@register("decode_clean", ["WIN2", "JON11", "SCL19", "SCL2"],
          "WITH " + _SQL_IDS + """SELECT h2ik, egk_nr, CASE WHEN egk_nr = '' THEN kv_nummer ELSE '' END AS kv_nummer, pid
          FROM s3""")
def decode_clean(spark, d):
    return D.clean_ids(id_rows(spark, d), _unwanted(spark, d), ["seen", "row_id"])


DECODINGS = [{"name": "first", "h2iks": ["1", "2", "3"]}, {"name": "second", "h2iks": ["3", "5"]}, {"name": "none", "h2iks": ["9"]}]


@register("decode_all_datasets", ["WIN1", "WIN2", "AGG7", "JON9", "JON10", "JON11", "SCL19"], " UNION ALL ".join(
    f"SELECT * FROM (WITH {_decode_sql(x['h2iks'], False)} SELECT '{x['name']}' AS dataset, h2ik, egk_nr, "
    "CASE WHEN egk_nr = '' THEN kv_nummer ELSE '' END AS kv_nummer, pid FROM s3)" for x in DECODINGS))
def decode_all_datasets(spark, d):
    """The decode files of three configured data sets, which share an insurer, in one run."""
    from claimwise.plans.config import decodings_of

    return D.decode_all(id_rows(spark, d), membership(spark, d), decodings_of({"decode": DECODINGS}), ["seen", "row_id"])


@register("decode_loss", ["AGG16"], "WITH " + _SQL_IDS + """
SELECT n_input, n_valid, n_input - n_valid AS n_duplicates,
  CASE WHEN n_valid > 0 THEN (n_input - n_valid) / CAST(n_valid AS DOUBLE) END AS loss,
  (CASE WHEN n_valid > 0 THEN (n_input - n_valid) / CAST(n_valid AS DOUBLE) END) > 0.05 AS warn
FROM (SELECT (SELECT count(*) FROM s0b) AS n_input, (SELECT count(*) FROM s3) AS n_valid) x""")
def decode_loss(spark, d):
    ids, unwanted = _ids_and_unwanted(spark, d)
    mapping = D.clean_ids(ids, unwanted, ["seen", "row_id"])
    return D.loss_ratio(D.decode_input(ids, unwanted), mapping)


@register("decode_file_roundtrip", ["SNK4", "SRC3"],
          "WITH " + _SQL_IDS + """SELECT h2ik, egk_nr, CASE WHEN egk_nr = '' THEN kv_nummer ELSE '' END AS kv_nummer, pid
          FROM s3""")
def decode_file_roundtrip(spark, d):
    """Decode file written as ``;`` text with a header, read back with the strict
    field-count reader (lines with another field count are dropped)."""
    from claimwise.session import scratch_path
    from claimwise.sources.readers import read_delimited_strict
    from claimwise.sources.sinks import write_decode_file

    path = scratch_path(spark, "decoding")
    write_decode_file(D.clean_ids(id_rows(spark, d), _unwanted(spark, d), ["seen", "row_id"]), path)
    return read_delimited_strict(spark, path, ["h2ik", "egk_nr", "kv_nummer", "pid"])
