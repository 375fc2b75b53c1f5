"""Claims-shaped frames derived from the driver's star-schema tables.

The claims warehouse is not available; these frames give its tables the
columns the operators name, computed by Spark from the given parquet tables
(so every query's work grows with the tables).

person            customer        pid = c_custkey padded to 10, insurer = c_mktsegment
outpatient case   orders          efn_id = o_orderkey, year/quarter of o_orderdate,
                                  contract from o_orderstatus (F -> 'KV', O -> 'kv', P -> 'SV'),
                                  insurer = o_orderpriority
region            nation          kv = n_nationkey as 2 digits
prescription      lineitem        pzn = l_partkey (8 digits), packages = l_quantity,
                                  prescription date = l_shipdate, physician = l_suppkey
drug catalogue    part            main / supplement sources by p_type
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.functions.scalars import pad_zeros

# Configured year range of the statistics (covers the whole driver data).
STAT_YEARS = (1995, 2001)
# "Today" for dynamic year slices and score windows (injected, never the wall clock).
AS_OF = "2001-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pid_of(custkey) -> F.Column:
    return pad_zeros(F.col(custkey) if isinstance(custkey, str) else custkey, 10)


def outpatient_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("efn_id"),
        F.col("o_custkey"),
        F.col("o_orderdate"),  # the stored date, on which bounds reach the scan
        pid_of("o_custkey").alias("pid"),
        F.year(d).alias("bezugsjahr"),
        F.quarter(d).alias("behandl_quartal"),
        d.alias("behandl_datum"),
        F.col("o_orderpriority").alias("h2ik"),
        F.when(F.col("o_orderstatus") == "F", "KV").when(F.col("o_orderstatus") == "O", "kv")
        .otherwise("SV").alias("vertrags_id"),
    )


def person_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of each person (o_custkey, kv)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("kv"))


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete region lookup (kv, kv_name, km6_id, hinweis) from nation."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("kv"),
        F.col("n_name").alias("kv_name"),
        F.when(F.col("n_regionkey") == 4, F.lit("")).otherwise(
            F.col("n_regionkey").cast("string")).alias("km6_id"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("n_nationkey") % 3 == 1, F.lit("lab note"))
        .otherwise(F.lit("other")).alias("hinweis"),
    )
