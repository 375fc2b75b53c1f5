"""Per-person content fingerprint over the master, region, diagnosis and drug tables.

Canonical text per person::

    dob _ dod _ gender _ min_kgs _ max_kgs _ icd tokens _ pzn tokens

with defaults 1900-01-01 / 2999-12-31 / 0 / 00000 / 00000 / 0000 / 00000000.
Codes are ordered by (year, code), duplicates kept; the year orders but is not
written, so equal lists from other years are equal.  The fingerprint is the SHA-256
hex of the text.

Scale: codes are first counted per (pid, year, code) — a partial aggregation,
so a person with a huge number of rows is reduced on the mappers — and the
per-person list is then bounded by the number of distinct (year, code) pairs
(code vocabulary x years); only the text itself grows with a person's rows (a placeholder id
that holds very many rows has a text as long as its rows).  The four per-person
frames are joined 1:1 on pid from the base persons (only base persons get a
fingerprint).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.functions.scalars import empty_if_null, iso_date

# Fixed values that define results: defaults of the canonical text.
DEFAULT_GENDER = "0"
DEFAULT_DOB = "1900-01-01"
DEFAULT_DOD = "2999-12-31"
DEFAULT_KGS = "00000"
NO_ICD = "0000"
NO_PZN = "00000000"
# Sentinels of the accumulator: values at or beyond them never win.
GENDER_CEILING = "9"
KGS_MIN_CEILING = "999999"
KGS_MAX_FLOOR = "000000"


def person_base(base: DataFrame, pid="pid", dob="geburtsdatum", dod="sterbedatum",
                gender="geschlecht") -> DataFrame:
    """min birth date, min death date (ISO dates only), min gender character."""
    g = F.substring(empty_if_null(gender), 1, 1)
    # characters below '9' are ASCII, so the minimum is taken on the character code
    # (an integer keeps the aggregation hash-based) and turned back into text
    code = F.when((g != "") & (g < GENDER_CEILING), F.ascii(g))
    agg = base.groupBy(F.col(pid).alias("pid")).agg(
        F.min(iso_date(dob)).alias("_dob"),
        F.min(iso_date(dod)).alias("_dod"),
        F.min(code).alias("_gcode"))
    return agg.select("pid", "_dob", "_dod", F.when(F.col("_gcode").isNotNull(), F.chr("_gcode")).alias("_gender"))


def person_kgs(region: DataFrame, pid="pid", kgs="kgs") -> DataFrame:
    """min / max municipality code in string order; blanks ignored."""
    k = empty_if_null(kgs)
    return region.groupBy(F.col(pid).alias("pid")).agg(
        F.min(F.when((k != "") & (k < KGS_MIN_CEILING), k)).alias("_min_kgs"),
        F.max(F.when(k > KGS_MAX_FLOOR, k)).alias("_max_kgs"))


def person_codes(facts: DataFrame, out: str, pid="pid", year="bezugsjahr", code="code") -> DataFrame:
    """Codes per person, ordered by (year, code), duplicates kept, joined with '_'."""
    counted = facts.groupBy(F.col(pid).alias("pid"), F.col(year).cast("int").alias("_y"),
                            F.col(code).cast("string").alias("_c")).agg(F.count("*").alias("_n"))
    # the n copies are written out per token after the aggregation by count
    per = counted.groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("_y", "_c", F.col("_n").cast("int").alias("_n")))).alias("_l"))
    tokens = F.transform("_l", lambda s: F.array_join(F.array_repeat(s["_c"], s["_n"]), "_"))
    return per.select("pid", F.array_join(tokens, "_").alias(out))


def canonical_text(base: DataFrame, region: DataFrame, icd: DataFrame, pzn: DataFrame) -> DataFrame:
    """(pid, text) for every base person."""
    persons = person_base(base)
    j = (persons.join(person_kgs(region), "pid", "left")
         .join(person_codes(icd, "_icd"), "pid", "left")
         .join(person_codes(pzn, "_pzn"), "pid", "left"))
    text = F.concat_ws(
        "_",
        F.coalesce(F.col("_dob").cast("string"), F.lit(DEFAULT_DOB)),
        F.coalesce(F.col("_dod").cast("string"), F.lit(DEFAULT_DOD)),
        F.coalesce("_gender", F.lit(DEFAULT_GENDER)),
        F.coalesce("_min_kgs", F.lit(DEFAULT_KGS)),
        F.coalesce("_max_kgs", F.lit(DEFAULT_KGS)),
        F.coalesce("_icd", F.lit(NO_ICD)),
        F.coalesce("_pzn", F.lit(NO_PZN)))
    return j.select("pid", text.alias("text"))


def fingerprints(base: DataFrame, region: DataFrame, icd: DataFrame, pzn: DataFrame) -> DataFrame:
    """(pid, fingerprint) — SHA-256 hex of the canonical text."""
    return canonical_text(base, region, icd, pzn).select("pid", F.sha2("text", 256).alias("fingerprint"))


def year_states(base: DataFrame, region: DataFrame, icd: DataFrame, pzn: DataFrame, year: str = "bezugsjahr") -> DataFrame:
    """What each year tells of a person, mergeable over years: (pid, year, in_base, dob, dod, gender, min_kgs, max_kgs, icd, pzn).

    ``icd`` and ``pzn`` are the year's codes in order with their numbers, so a state is bounded by the code vocabulary, however
    many rows a person has.  All four frames have a ``year``; codes are counted on the mappers, then all meet in one aggregation."""
    def counted(facts: DataFrame, into: str) -> DataFrame:
        rows = facts.groupBy(F.col("pid"), F.col(year).cast("int").alias("year"), F.col("code").cast("string").alias("c")).agg(F.count("*").cast("int").alias("n"))
        return rows.select("pid", "year", F.struct("c", "n").alias(into))

    g = F.substring(empty_if_null("geschlecht"), 1, 1)
    k = empty_if_null("kgs")
    persons = base.select("pid", F.col(year).cast("int").alias("year"), F.lit(True).alias("in_base"), iso_date("geburtsdatum").alias("dob"),
                          iso_date("sterbedatum").alias("dod"), F.when((g != "") & (g < GENDER_CEILING), F.ascii(g)).alias("gender"))
    regions = region.select("pid", F.col(year).cast("int").alias("year"), F.when((k != "") & (k < KGS_MIN_CEILING), k).alias("min_kgs"),
                            F.when(k > KGS_MAX_FLOOR, k).alias("max_kgs"))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [persons, regions, counted(icd, "icd"), counted(pzn, "pzn")])
    return every.groupBy("pid", "year").agg(
        F.coalesce(F.max("in_base"), F.lit(False)).alias("in_base"), F.min("dob").alias("dob"), F.min("dod").alias("dod"), F.min("gender").alias("gender"),
        F.min("min_kgs").alias("min_kgs"), F.max("max_kgs").alias("max_kgs"), *[F.sort_array(F.collect_list(c)).alias(c) for c in ("icd", "pzn")])


def merged_fingerprints(states: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """(pid, fingerprint) from the states of the years within the bounds; equal to ``fingerprints`` over the rows of those years."""
    if first_year is not None:
        states = states.filter(F.col("year") >= first_year)
    if last_year is not None:
        states = states.filter(F.col("year") <= last_year)
    lists = [F.sort_array(F.collect_list(F.when(F.size(c) > 0, F.struct("year", c)))).alias(f"_{c}") for c in ("icd", "pzn")]
    persons = states.groupBy("pid").agg(
        F.max("in_base").alias("in_base"), F.min("dob").alias("dob"), F.min("dod").alias("dod"), F.min("gender").alias("gender"),
        F.min("min_kgs").alias("min_kgs"), F.max("max_kgs").alias("max_kgs"), *lists).filter("in_base")

    def tokens(c: str, none: str):
        years = F.transform(f"_{c}", lambda s: F.array_join(F.transform(s[c], lambda x: F.array_join(F.array_repeat(x["c"], x["n"]), "_")), "_"))
        return F.when(F.size(f"_{c}") > 0, F.array_join(years, "_")).otherwise(none)

    text = F.concat_ws(
        "_", F.coalesce(F.col("dob").cast("string"), F.lit(DEFAULT_DOB)), F.coalesce(F.col("dod").cast("string"), F.lit(DEFAULT_DOD)),
        F.when(F.col("gender").isNotNull(), F.chr("gender")).otherwise(DEFAULT_GENDER), F.coalesce("min_kgs", F.lit(DEFAULT_KGS)),
        F.coalesce("max_kgs", F.lit(DEFAULT_KGS)), tokens("icd", NO_ICD), tokens("pzn", NO_PZN))
    return persons.select("pid", F.sha2(text, 256).alias("fingerprint"))


def save_states(states: DataFrame, path: str) -> None:
    """Write states by year: the years among them are replaced, others stay as they are."""
    states.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def add_years(base: DataFrame, region: DataFrame, icd: DataFrame, pzn: DataFrame, years: list[int], path: str, year: str = "bezugsjahr") -> None:
    """Compute the states of some years alone and put them to the others below ``path``."""
    of = [df.filter(F.col(year).cast("int").isin(years)) for df in (base, region, icd, pzn)]
    save_states(year_states(*of, year=year), path)


def person_summary(base: DataFrame, region: DataFrame) -> DataFrame:
    """Person min/max values with defaults (pid, dob, dod, gender, min_kgs, max_kgs)."""
    j = person_base(base).join(person_kgs(region), "pid", "left")
    return j.select(
        "pid",
        F.coalesce(F.col("_dob"), F.lit(DEFAULT_DOB).cast("date")).alias("dob"),
        F.coalesce(F.col("_dod"), F.lit(DEFAULT_DOD).cast("date")).alias("dod"),
        F.coalesce("_gender", F.lit(DEFAULT_GENDER)).alias("gender"),
        F.coalesce("_min_kgs", F.lit(DEFAULT_KGS)).alias("min_kgs"),
        F.coalesce("_max_kgs", F.lit(DEFAULT_KGS)).alias("max_kgs"))


def codes_with_sentinel(facts: DataFrame, persons: DataFrame, sentinel: str = NO_ICD,
                        pid="pid", code="code") -> DataFrame:
    """Distinct (pid, code) of all persons; persons without codes get the sentinel
    (UNION of real codes and a sentinel row)."""
    real = facts.select(F.col(pid).alias("pid"), F.col(code).cast("string").alias("code"))
    missing = persons.select("pid").join(real.select("pid").distinct(), "pid", "left_anti").select(
        "pid", F.lit(sentinel).alias("code"))
    return real.unionByName(missing).distinct()
