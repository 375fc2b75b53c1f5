"""Row enrichment steps (export layer): each step is ``DataFrame -> DataFrame``.

A chain is ``functools.reduce`` over steps; every step decides once per frame
(from ``FrameMeta`` and the frame's columns) whether it applies, never per row.
Lookups are plain joins: the planner's statistics and adaptive execution choose how they run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.functions.scalars import (clean_package_name, computed_amount, daily_doses,
                                         empty_if_null, is_classified, java_trim, main_region, pad_zeros, pharmacy_type,
                                         quarter_begin_text, quarter_end_text, sha256_hex,
                                         strict_int)
from claimwise.operators.rowfilters import FrameMeta, targets

# Fixed values that define results: catalogue column labels.
ADMISSION = "MARKTZUGANG"
RETIREMENT = "AHDATUM"
METOO = "METOO"
APPFORM = "APPFORM"
BIOSIMILAR = "BIOSIMILAR"
ORPHAN = "ORPHAN"
GENERIC = "GENERIKENN"
DDD = "DDD"
NAME = "STANAME"
PACK_SIZE = "PACKGRÖE"
ATC = "ATC_AI"
IS_CLASSIFIED = "IS_CLASSIFIED"
AMOUNT = "Menge_berechnet"
PACKAGES = "anzahl_packungen"
PRESCRIPTION_DATE = "verordnungsdatum"
PZN_WIDTH = 8


def run_chain(df: DataFrame, steps, meta: FrameMeta = FrameMeta()) -> DataFrame:
    """Apply steps in order (ENR1)."""
    return reduce(lambda acc, step: step(acc, meta), steps, df)


def _check_new(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"column {name!r} already exists (case-insensitively) in the frame")


@dataclass(frozen=True)
class Noop:
    """Step for an invalid configuration: leaves the frame as it is."""

    reason: str = ""

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        return df


@dataclass(frozen=True)
class StaticColumn:
    """Constant column, first or last; skipped when present, for excluded tables,
    and when a given target does not match."""

    name: str
    value: str
    first: bool = False
    db: str | None = None
    table: str | None = None
    exclude_tables: tuple[str, ...] = ()

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if self.name in df.columns:
            return df
        if any(t.lower() in meta.table.lower() for t in self.exclude_tables):
            return df
        if (self.db or self.table) and not targets(meta, self.db, self.table):
            return df
        c = F.lit(self.value).alias(self.name)
        return df.select(c, "*") if self.first else df.select("*", c)


@dataclass(frozen=True)
class PharmacyType:
    """Pharmacy type from the institution code; no column when the source column is absent."""

    column: str = "apothekenik"
    out: str = "apo_typ"
    db: str | None = None
    table: str | None = None

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, self.db, self.table) or self.column not in df.columns:
            return df
        return df.withColumn(self.out, pharmacy_type(self.column))


@dataclass(frozen=True)
class RegionFromPractice:
    """Main region from the practice number, on tables whose name ends with 'evo';
    "" when the column is missing or shorter than two characters."""

    column: str = "bs_nr"
    out: str = "kv"

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not meta.table.lower().endswith("evo"):
            return df
        if self.column not in df.columns:
            return df.withColumn(self.out, F.lit(""))
        return df.withColumn(self.out, main_region(self.column))


@dataclass(frozen=True)
class StartDate:
    """start = end - days + 1 when days > 0, else end; days that are not an integer
    count as 0; "" when either column is missing (names matched case-insensitively)."""

    end_col: str
    day_col: str
    out: str
    db: str | None = None
    table: str | None = None

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, self.db, self.table):
            return df
        cols = {c.lower(): c for c in df.columns}
        end, days = cols.get(self.end_col.lower()), cols.get(self.day_col.lower())
        if end is None or days is None:
            return df.withColumn(self.out, F.lit(""))
        end_d = F.try_to_date(F.col(end).cast("string"), "yyyy-MM-dd")
        n = F.coalesce(strict_int(days), F.lit(0))
        start = F.when(n > 0, F.date_sub(end_d, n - 1)).otherwise(end_d)
        return df.withColumn(self.out, F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit("")))


@dataclass(frozen=True)
class FixMissingDates:
    """Outpatient cases of contract KV: empty begin / end become the first / last day
    of the treatment quarter (yyyyMMdd); an unknown quarter counts as Q1."""

    db: str = "ADB"
    table: str = "Arzt_Fall"
    contract: str = "vertrags_id"
    quarter: str = "behandl_quartal"
    begin: str = "behandl_beginn"
    end: str = "behandl_ende"
    year: str = "bezugsjahr"

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, self.db, self.table):
            return df
        if not {self.contract, self.quarter, self.begin, self.end, self.year} <= set(df.columns):
            return df
        kv = F.upper(empty_if_null(self.contract)) == "KV"
        y, q = empty_if_null(self.year), empty_if_null(self.quarter)
        b, e = empty_if_null(self.begin), empty_if_null(self.end)
        return (df.withColumn(self.begin, F.when(kv & (b == ""), quarter_begin_text(y, q)).otherwise(F.col(self.begin)))
                .withColumn(self.end, F.when(kv & (e == ""), quarter_end_text(y, q)).otherwise(F.col(self.end))))


@dataclass(frozen=True)
class PseudoHash:
    """``pid_hash`` = SHA-256 hex of the person id, on the master table."""

    pid: str = "pid"
    out: str = "pid_hash"
    table: str = "Vers_Stamm"

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, None, self.table):
            return df
        return df.withColumn(self.out, sha256_hex(empty_if_null(self.pid)))


@dataclass(frozen=True)
class LookupColumns:
    """Append value columns from a mapping keyed by several columns; "" on a miss
    or when a key column is missing from the frame.  Duplicate mapping keys never
    multiply rows: they fail the job that computes the values."""

    mapping: DataFrame
    keys: tuple[str, ...]
    db: str | None = None
    table: str | None = None
    check_unique: bool = True

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if (self.db or self.table) and not targets(meta, self.db, self.table):
            return df
        values = [c for c in self.mapping.columns if c not in self.keys]
        if not set(self.keys) <= set(df.columns):
            return df.select("*", *[F.lit("").alias(v) for v in values])
        m = self.mapping.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(self.keys)],
                                *[F.col(v).alias(f"_v_{v}") for v in values])
        if self.check_unique:
            # one row per key, checked in the plan itself: the mapping is computed once, with the join
            only = m.groupBy(*[f"_k{i}" for i in range(len(self.keys))]).agg(
                F.count("*").alias("_n"), *[F.first(f"_v_{v}").alias(f"_v_{v}") for v in values])
            twice = F.raise_error(F.lit("lookup mapping: duplicate keys"))
            m = only.select(*[f"_k{i}" for i in range(len(self.keys))],
                            *[F.when(F.col("_n") == 1, F.col(f"_v_{v}")).otherwise(twice).alias(f"_v_{v}") for v in values])
        cond = reduce(lambda a, b: a & b,
                      [empty_if_null(k) == F.col(f"_k{i}") for i, k in enumerate(self.keys)])
        joined = df.join(m, cond, "left")
        return joined.select(*[F.col(c) for c in df.columns],
                             *[F.coalesce(F.col(f"_v_{v}"), F.lit("")).alias(v) for v in values])


# --- drug catalogue ----------------------------------------------------------------------

@dataclass(frozen=True)
class CatalogueSource:
    """One catalogue source: ``key`` column plus string columns named by label.

    ``data`` labels are appended to prescriptions; ``meta`` labels are only used
    (validity dates, pack size).  A ``_line`` column, when present, orders the
    file's lines: the last line of a key wins."""

    frame: DataFrame
    data: tuple[str, ...]
    meta: tuple[str, ...] = ()
    key: str = "key"

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.data + self.meta))


def consolidate(sources: list[CatalogueSource]) -> DataFrame:
    """Merge sources per key: for every label, the last source that defines the label
    and contains the key wins, also when its value is empty.

    Result columns: ``_key``, one column per label (NULL = undefined for the key),
    ``_in0`` (key in the main source) and ``_in{i}`` flags.

    The lines of all sources meet in one aggregation by key: a label takes the latest line, by source and place in it, of the
    sources that define it.  Without line numbers the largest row of a source's key counts as its last."""
    labels = list(dict.fromkeys(lbl for s in sources for lbl in s.labels))
    tagged = []
    for i, s in enumerate(sources):
        f = s.frame
        place = F.struct(
            F.lit(i).alias("i"), (F.col("_file") if "_file" in f.columns else F.lit("")).alias("file"),
            (F.col("_line") if "_line" in f.columns else F.lit(0)).cast("long").alias("line"),
            F.array(*[F.col(c).cast("string") for c in s.labels or (s.key,)]).alias("row"))
        tagged.append(f.select(
            pad_zeros(F.col(s.key), PZN_WIDTH).alias("_key"), F.lit(i).alias("_i"), place.alias("_at"),
            *[(F.col(c) if c in s.labels else F.lit(None)).cast("string").alias(c) for c in labels]))
    lines = reduce(DataFrame.unionByName, tagged)

    def latest(label: str):
        defining = F.col("_i").isin([i for i, s in enumerate(sources) if label in s.labels])
        return F.max_by(F.col(label), F.when(defining, F.col("_at"))).alias(label)

    return lines.groupBy("_key").agg(*[F.max(F.col("_i") == i).alias(f"_in{i}") for i in range(len(sources))], *map(latest, labels))


def supplement_only_keys(sources: list[CatalogueSource]) -> DataFrame:
    """Keys defined by a later source but not by the main source (no validity range)."""
    cons = consolidate(sources)
    return cons.filter(~F.col("_in0")).select(F.col("_key").alias("key"))


def _yyyymmdd(c):
    return F.try_to_date(c, "yyyyMMdd")


@dataclass(frozen=True)
class DrugCatalogue:
    """Append catalogue columns to prescriptions and derive doses and amounts.

    * appended: the data labels in source order (first occurrence), "" on a miss;
      ``STANAME`` cleaned (text before ``*NV*``) plus ``IS_CLASSIFIED`` when the name
      is a data label;
    * ``DDD`` becomes ``int(ddd) / 1000 * packages`` (double) and ``Menge_berechnet``
      ``int(pack size) / 10 * packages`` — both only when the frame has a package
      count, both passed through the validity gate;
    * validity gate: keys of the main source carry a range ``[admission, retirement)``;
      supplement-only and unknown keys are always valid; a main key with neither
      date gets 0.0.
    """

    sources: tuple[CatalogueSource, ...]
    key_column: str = "pzn"
    db: str | None = None
    table: str | None = "am_evo"

    def catalogue(self) -> DataFrame:
        cons = consolidate(list(self.sources))
        labels = [c for c in cons.columns if not c.startswith("_")]
        has_adm = F.lit(False)
        has_ret = F.lit(False)
        for i, s in enumerate(self.sources):
            if ADMISSION in s.labels:
                has_adm = has_adm | F.col(f"_in{i}")
            if RETIREMENT in s.labels:
                has_ret = has_ret | F.col(f"_in{i}")
        adm = F.col(ADMISSION) if ADMISSION in labels else F.lit(None).cast("string")
        ret = F.col(RETIREMENT) if RETIREMENT in labels else F.lit(None).cast("string")
        out = cons.select(
            "*",
            F.col("_in0").alias("_range"),
            F.when(has_adm & (empty_if_null(adm) != ""), _yyyymmdd(adm)).alias("_start"),
            F.when(has_ret & (empty_if_null(ret) != ""), _yyyymmdd(ret)).alias("_end"))
        if NAME in self.data_labels():
            name = F.col(NAME)
            out = out.withColumn(IS_CLASSIFIED, is_classified(name)).withColumn(
                NAME, F.when(name.isNull(), F.lit("")).otherwise(clean_package_name(name)))
        return out

    def data_labels(self) -> list[str]:
        return list(dict.fromkeys(lbl for s in self.sources for lbl in s.data))

    def _pack_size_is_meta(self) -> bool:
        return any(PACK_SIZE in s.meta for s in self.sources)

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, self.db, self.table) or self.key_column not in df.columns:
            return df
        appended = self.data_labels() + ([IS_CLASSIFIED] if NAME in self.data_labels() else [])
        for c in appended:
            _check_new(df, c)
        cat = self.catalogue()
        keep = ["_key", "_range", "_start", "_end"] + appended + (
            [PACK_SIZE] if self._pack_size_is_meta() else [])
        cat = cat.select(*[F.col(c).alias(f"_c_{c}") for c in keep])
        joined = df.join(cat,
                         empty_if_null(self.key_column) == F.col("_c__key"), "left")
        out_cols = [F.col(c) for c in df.columns]
        if PACKAGES not in df.columns:
            out_cols += [F.coalesce(F.col(f"_c_{c}"), F.lit("")).alias(c) for c in appended]
            return joined.select(*out_cols)

        pk = java_trim(empty_if_null(PACKAGES)).try_cast("double")
        when_d = F.try_to_date(empty_if_null(PRESCRIPTION_DATE), "yyyy-MM-dd")

        def gate(v):
            start, end, rng = F.col("_c__start"), F.col("_c__end"), F.coalesce(F.col("_c__range"), F.lit(False))
            return (F.when(~rng, v)
                    .when(start.isNotNull() & end.isNull(), F.when(when_d >= start, v).otherwise(F.lit(0.0)))
                    .when(start.isNull() & end.isNotNull(), F.when(when_d < end, v).otherwise(F.lit(0.0)))
                    .when(start.isNotNull() & end.isNotNull(),
                          F.when((when_d >= start) & (when_d < end), v).otherwise(F.lit(0.0)))
                    .otherwise(F.lit(0.0)))

        for c in appended:
            v = F.coalesce(F.col(f"_c_{c}"), F.lit(""))
            if c == DDD:
                v = F.when(v != "", gate(daily_doses(v, pk))).cast("double")
            out_cols.append(v.alias(c))
        if self._pack_size_is_meta():
            ps = F.coalesce(F.col(f"_c_{PACK_SIZE}"), F.lit(""))
            amount = F.when(ps != "", gate(computed_amount(ps, pk))).cast("double")
        else:
            amount = F.lit(None).cast("double")
        out_cols.append(amount.alias(AMOUNT))
        return joined.select(*out_cols)


@dataclass(frozen=True)
class FingerprintColumn:
    """Replace or append ``pid_hash`` on the master table from a (pid, fingerprint)
    frame; "" for persons without a fingerprint."""

    fingerprints: DataFrame
    pid: str = "pid"
    out: str = "pid_hash"
    table: str = "Vers_Stamm"

    def __call__(self, df: DataFrame, meta: FrameMeta) -> DataFrame:
        if not targets(meta, None, self.table):
            return df
        base = df.drop(self.out) if self.out in df.columns else df
        fp = self.fingerprints.select(F.col(self.pid).alias("_fp_pid"), F.col("fingerprint").alias("_fp"))
        joined = base.join(fp, F.col(self.pid) == F.col("_fp_pid"), "left")
        return joined.select(*[F.col(c) for c in base.columns], F.coalesce("_fp", F.lit("")).alias(self.out))


__all__ = [
    "run_chain", "Noop", "StaticColumn", "PharmacyType", "RegionFromPractice", "StartDate",
    "FixMissingDates", "PseudoHash", "LookupColumns", "CatalogueSource", "consolidate",
    "DrugCatalogue", "FingerprintColumn", "supplement_only_keys",
]
