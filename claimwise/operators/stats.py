"""Quarterly case statistics: counts per quarter, year-on-year ratios, per-region details.

Shapes
------
counts    (year int, quarter int, cnt long)            one slice
overview  (slice, year, quarter, cnt, ratio, out_of_tolerance)
regional  (kv, kv_name, year, quarter, cnt, prev_cnt, ratio)

Scale notes
-----------
* Distinct counts are planned by Spark as a two-level aggregation: partial
  de-duplication on (group, key) first, so a quarter holding a third of all
  rows only ships partial counts through the final shuffle.
* The calendar is built from the configured year bounds (years * 4 * slices
  rows), never from the data, so the padding join and the ``lag`` window
  run over a frame whose size does not grow with the input.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwise.functions.scalars import (as_col, concat_key, is_contract, out_of_tolerance, quarter_index,
                                         quarter_of_index, year_of_index)


# --- AGG1 / AGG3: distinct cases per (year, quarter) ------------------------------------

def cases_per_quarter(df: DataFrame, year, quarter, case_id) -> DataFrame:
    """count(distinct case_id) grouped by year and quarter."""
    return (df.groupBy(as_col(year).cast("int").alias("year"),
                       as_col(quarter).cast("int").alias("quarter"))
            .agg(F.countDistinct(as_col(case_id)).alias("cnt")))


def cases_per_date_quarter(df: DataFrame, year, date, case_id) -> DataFrame:
    """AGG1: reference year + quarter of a date."""
    return cases_per_quarter(df, year, F.quarter(as_col(date)), case_id)


def cases_pre_aggregated(df: DataFrame, year, date, case_id) -> DataFrame:
    """AGG2: distinct per (year, quarter) then summed over equal keys.

    The outer sum runs over keys that are already unique, so it equals AGG1;
    it is expressed as AGG1 (one aggregation, no extra shuffle)."""
    return cases_per_date_quarter(df, year, date, case_id)


def contract_cases_per_quarter(df: DataFrame, year, quarter, case_id, contract_col,
                               contract: str = "KV") -> DataFrame:
    """AGG3: distinct cases of one contract type, quarter given as a column."""
    return cases_per_quarter(df.filter(is_contract(contract_col, contract)), year, quarter, case_id)


def concat_key_per_quarter(df: DataFrame, year, date, *key_parts) -> DataFrame:
    """AGG4: count(distinct a || b) per (year, quarter of date).

    Text concatenation is kept on purpose: it is what the warehouse computes
    ('1' || '23' equals '12' || '3'; NULL parts drop the row)."""
    return cases_per_quarter(df, year, F.quarter(as_col(date)), concat_key(*key_parts))


def daily_distinct_per_quarter(df: DataFrame, year, date, *key_parts) -> DataFrame:
    """AGG5: count(distinct a||b||c) per day, then summed per (year, quarter).

    Two aggregations; the first groups by the day, so its distinct
    de-duplication is spread over (day, key) and the second only sums one
    number per day."""
    d = as_col(date)
    per_day = (df.groupBy(as_col(year).cast("int").alias("year"), d.alias("_day"),
                          F.quarter(d).alias("quarter"))
               .agg(F.countDistinct(concat_key(*key_parts)).alias("_n")))
    return per_day.groupBy("year", "quarter").agg(F.sum("_n").cast("long").alias("cnt"))


# --- all configured data sets at once ---------------------------------------------------

@dataclass(frozen=True)
class DataSet:
    """A configured data set: rows of its insurers or, without those, rows whose ``flag_<flag>`` is 1; its slices and years."""

    name: str
    start_year: int
    end_year: int
    views: tuple[str, ...]
    insurers: tuple[str, ...] | None = None
    flag: str | None = None

    def __post_init__(self):
        if (self.insurers is None) == (self.flag is None):
            raise ValueError(f"data set {self.name}: give exactly one of insurers or flag")


@dataclass(frozen=True)
class Measure:
    """What one slice counts: distinct ``key`` per (year, quarter), per day as well if ``day`` is given, of the rows where ``where`` holds."""

    slice: str
    key: Column
    year: Column
    quarter: Column
    day: Column | None = None
    where: Column | None = None


def counts_by_dataset(df: DataFrame, datasets: list[DataSet], measures: list[Measure], insurer: str = "h2ik") -> DataFrame:
    """(dataset, slice, year, quarter, cnt) of all data sets and of all measures of one table, in one scan and one aggregation.

    A row becomes one entry for each measure it counts in and each data set that has the row and the measure's slice: at most data sets
    times measures, both configured.  Entries are made distinct on the mappers, so a hot insurer or key
    sends each of its keys once per task.  NULL keys count nothing; only the years of the data set count."""
    entries = []
    for s in datasets:
        member = F.col(insurer).isin(list(s.insurers)) if s.insurers is not None else F.col(f"flag_{s.flag}").cast("int") == 1
        for m in measures:
            if m.slice in s.views:
                wanted = member & m.year.between(s.start_year, s.end_year) & m.key.isNotNull()
                if m.where is not None:
                    wanted = wanted & m.where
                entries.append(F.when(wanted, F.struct(
                    F.lit(s.name).alias("dataset"), F.lit(m.slice).alias("slice"), m.year.cast("int").alias("year"), m.quarter.cast("int").alias("quarter"),
                    (m.day if m.day is not None else F.lit(None)).cast("date").alias("day"), m.key.cast("string").alias("key"))))
    kind = "array<struct<dataset:string,slice:string,year:int,quarter:int,day:date,key:string>>"
    each = df.select(F.explode(F.array_compact(F.array(*entries)) if entries else F.lit(None).cast(kind)).alias("e")).select("e.*")
    return each.distinct().groupBy("dataset", "slice", "year", "quarter").agg(F.count("*").alias("cnt"))


def overview_by_dataset(counts: list[DataFrame], datasets: list[DataSet]) -> DataFrame:
    """Overview (dataset, slice, year, quarter, cnt, ratio, out_of_tolerance) of all data sets, each over its own years and slices.

    ``counts``: frames of ``counts_by_dataset``, which share no slice."""
    every = reduce(DataFrame.unionByName, counts)
    spark = every.sparkSession
    calendar = spark.createDataFrame([(s.name, v, s.start_year, s.end_year) for s in datasets for v in s.views], "dataset string, slice string, a int, b int")
    calendar = (calendar.select("dataset", "slice", F.explode(F.sequence("a", "b")).alias("year"))
                .select("*", F.explode(F.array(*map(F.lit, range(1, 5)))).alias("quarter")))
    keys = ["dataset", "slice", "year", "quarter"]
    # at most a row per quarter of the calendar, which is made of parameters
    padded = calendar.join(F.broadcast(every.filter(F.col("quarter").between(1, 4))), keys, "left").select(
        *keys, F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("cnt"))
    return year_on_year(padded)


# --- WIN4 / WIN3 / SCL15: padding, ratios, tolerance ----------------------------------

def quarter_calendar(spark, lower_year: int, upper_year: int, slices: list[str] | None = None) -> DataFrame:
    """Every (slice, year, quarter) of the closed year range (parameter-sized, no join)."""
    n = (upper_year - lower_year + 1) * 4
    cal = spark.range(n).select(
        (F.floor(F.col("id") / 4) + lower_year).cast("int").alias("year"),
        (F.col("id") % 4 + 1).cast("int").alias("quarter"))
    if slices is None:
        return cal
    return cal.select(F.explode(F.array(*[F.lit(s) for s in slices])).alias("slice"), "year", "quarter")


def year_on_year(padded: DataFrame) -> DataFrame:
    """ratio = cnt / cnt four quarters earlier; 0.0 when the earlier count is 0 or absent.

    ``out_of_tolerance`` flags ratios outside [0.5, 1.5], except on the first four
    quarters of the series (nothing to compare with)."""
    part = [c for c in ("dataset", "slice") if c in padded.columns]
    w = Window.partitionBy(*part).orderBy("year", "quarter")
    prev = F.lag("cnt", 4).over(w)
    ratio = F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(F.col("cnt") / prev.cast("double"))
    pos = F.row_number().over(w)
    out = (padded.withColumn("ratio", ratio)
           .withColumn("_pos", pos)
           .withColumn("out_of_tolerance", (F.col("_pos") > 4) & out_of_tolerance("ratio"))
           .drop("_pos"))
    return out


def overview(slices: dict[str, DataFrame], lower_year: int, upper_year: int) -> DataFrame:
    """Long overview over several slices (slice, year, quarter, cnt, ratio, out_of_tolerance)."""
    labelled = [df.select(F.lit(name).alias("slice"), "year", "quarter", "cnt")
                for name, df in slices.items()]
    # Only the configured years and real quarters count (the reference's statistics
    # queries are restricted to the configured years).  Each slice then has at most
    # one row per calendar quarter, so the counts are bounded by the calendar size
    # and are broadcast into the calendar join (no shuffle of either side).
    counts = reduce(DataFrame.unionByName, labelled).filter(
        F.col("year").between(lower_year, upper_year) & F.col("quarter").between(1, 4))
    spark = counts.sparkSession
    cal = quarter_calendar(spark, lower_year, upper_year, list(slices))
    padded = (cal.join(F.broadcast(counts), ["slice", "year", "quarter"], "left")
              .select("slice", "year", "quarter",
                      F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("cnt")))
    return year_on_year(padded)


def overview_pivot(long: DataFrame, slices: list[str]) -> DataFrame:
    """Report table: one row per (data set, if any, year, quarter), one count column per slice (SNK7)."""
    by = [c for c in ("dataset",) if c in long.columns]
    return (long.groupBy(*by, "year", "quarter").pivot("slice", slices)
            .agg(F.first("cnt")))


# --- AGG15 / SRT2: reference quarter ---------------------------------------------------

def reference_quarter(counts: DataFrame, lower_year: int | None = None,
                      upper_year: int | None = None) -> DataFrame:
    """Latest (year, quarter) with a positive count, within the year bounds; one row."""
    c = counts.filter(F.col("cnt") > 0)
    if lower_year is not None:
        c = c.filter(F.col("year") >= lower_year)
    if upper_year is not None:
        c = c.filter(F.col("year") <= upper_year)
    # latest quarter as the maximum of the integer quarter index (hash aggregation)
    latest = c.agg(F.max(quarter_index("year", "quarter")).alias("_m"))
    return (latest.filter(F.col("_m").isNotNull())
            .select(year_of_index(F.col("_m")).alias("year"), quarter_of_index(F.col("_m")).alias("quarter")))


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a frame that has at most one row (broadcast equi join
    on a constant key; the broadcast side is bounded to one row by construction)."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


# --- AGG6 / JON7 / JON8 / WIN6: regional ratio ------------------------------------------

def region_lookup_filter(lookup: DataFrame) -> DataFrame:
    """Keep lookup rows with a km6 id and a null note or a note containing 'ab'."""
    return lookup.filter((F.col("km6_id") != "") &
                         (F.col("hinweis").isNull() | F.col("hinweis").like("%ab%")))


def regional_ratio(cases: DataFrame, lookup: DataFrame, ref: DataFrame,
                   year="year", quarter="quarter", case_id="case_id", region="kv",
                   contract_col="contract", contract: str = "KV",
                   regions: DataFrame | None = None, region_key: str | None = None, date_column: str | None = None) -> DataFrame:
    """Per region: distinct cases in the reference quarter and in the same quarter a
    year before; ratio = ref / prev when prev > 0 else 0.0.

    ``ref`` (one row at most) is computed first; its two quarters are literals for the cases, and with ``date_column``, the stored date that
    year and quarter come from, two date ranges for their scan.  So the pairing of rows becomes one
    distinct and a conditional count per region.  With ``regions`` (``region_key``, ``region``)
    the cases get their region only after that filter.  Every region of the filtered
    lookup appears, with zero counts when it has no cases; without a reference quarter there are no rows."""
    at = ref.first()
    ry, rq = (at["year"], at["quarter"]) if at else (0, 0)
    y, q = as_col(year).cast("int"), as_col(quarter).cast("int")
    place = as_col(region if regions is None else region_key)
    scoped = cases.filter(is_contract(contract_col, contract) & (q == rq) & y.isin(ry, ry - 1))
    if date_column:
        d = F.col(date_column)
        spans = [(_dt.date(x, 3 * rq - 2, 1), _dt.date(x + rq // 4, 3 * rq % 12 + 1, 1)) for x in (ry, ry - 1)] if at else []
        scoped = scoped.filter(reduce(or_, [(d >= F.lit(a)) & (d < F.lit(b)) for a, b in spans], F.lit(False)))
    scoped = scoped.select(place.alias("kv"), as_col(case_id).alias("_id"), (y == ry).alias("_now"))
    if regions is not None:
        of = regions.select(as_col(region_key).alias("_rk"), as_col(region).alias("_region"))
        scoped = scoped.join(of, F.col("kv") == F.col("_rk")).drop("kv", "_rk").withColumnRenamed("_region", "kv")
    per_region = scoped.filter("_id IS NOT NULL").distinct().groupBy("kv").agg(
        F.count(F.when(F.col("_now"), 1)).alias("cnt"), F.count(F.when(~F.col("_now"), 1)).alias("prev_cnt"))
    lk = region_lookup_filter(lookup).select("kv", "kv_name").filter(F.lit(at is not None))
    out = lk.join(per_region, "kv", "left").select(
        "kv", "kv_name", F.lit(ry).cast("int").alias("year"), F.lit(rq).cast("int").alias("quarter"),
        F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"), F.coalesce("prev_cnt", F.lit(0)).cast("long").alias("prev_cnt"))
    out = out.withColumn(
        "ratio", F.when(F.col("prev_cnt") > 0, F.col("cnt") / F.col("prev_cnt").cast("double"))
        .otherwise(F.lit(0.0)))
    # report order; the frame has one row per lookup region (bounded), so one sorted
    # partition is enough and no range-partitioning sample job is needed
    return out.coalesce(1).sortWithinPartitions("kv")


# --- JON13: report lookup -----------------------------------------------------------------

def report_for_dataset(report: DataFrame, db: str, dataset: str, insurer_col: str = "insurance") -> DataFrame:
    """Rows of a pre-computed report whose insurer name contains the database or the
    dataset name (case-insensitive)."""
    name = F.lower(F.col(insurer_col))
    return report.filter(name.contains(db.lower()) | name.contains(dataset.lower()))
