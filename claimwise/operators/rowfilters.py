"""Configured row filters and frame targeting.

A filter names a column, a strategy (regex full match, value set, employee
ids) and a mode (INCLUDE keeps matches, EXCLUDE drops them); a frame passes
the conjunction of all filters.  Targets (db, table) are properties of the
frame, resolved once per frame, not per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwise.functions.scalars import full_match, pad_pid_10


@dataclass(frozen=True)
class FrameMeta:
    """Which warehouse database / table a frame comes from."""

    db: str = ""
    table: str = ""


def targets(meta: FrameMeta, db: str | None = None, table: str | None = None) -> bool:
    """Enrichment target test: case-insensitive *contains* on db and/or table.

    Both given -> both must match; one given -> that one; none -> no target."""
    has_t, has_d = bool(table), bool(db)
    t_ok = has_t and table.lower() in meta.table.lower()
    d_ok = has_d and db.lower() in meta.db.lower()
    if has_t and has_d:
        return t_ok and d_ok
    if has_t:
        return t_ok
    if has_d:
        return d_ok
    return False


@dataclass(frozen=True)
class RegexStrategy:
    pattern: str

    def predicate(self, c: Column) -> Column:
        return full_match(c, self.pattern)


@dataclass(frozen=True)
class SetStrategy:
    values: tuple[str, ...]

    def predicate(self, c: Column) -> Column:
        return c.isin(list(self.values))


@dataclass(frozen=True)
class FrameSetStrategy:
    """Membership in a value frame (e.g. employee ids): a semi / anti join."""

    values: DataFrame


@dataclass(frozen=True)
class RowFilter:
    column: str
    strategy: object
    mode: str = "INCLUDE"  # or EXCLUDE
    db: str | None = None
    table: str | None = None

    def applies(self, df: DataFrame, meta: FrameMeta) -> bool:
        """Applies when the column exists and the db / table, if given, match exactly
        (case-insensitive).  A frame without the column passes unchanged."""
        if self.column not in df.columns:
            return False
        if self.db and self.db.lower() != meta.db.lower():
            return False
        if self.table and self.table.lower() != meta.table.lower():
            return False
        return True


def apply_filter(df: DataFrame, f: RowFilter, meta: FrameMeta = FrameMeta()) -> DataFrame:
    if not f.applies(df, meta):
        return df
    c = F.coalesce(F.col(f.column).cast("string"), F.lit(""))
    if isinstance(f.strategy, FrameSetStrategy):
        vals = f.strategy.values
        vals = vals.select(F.col(vals.columns[0]).cast("string").alias("_member")).distinct()
        how = "left_semi" if f.mode == "INCLUDE" else "left_anti"
        return df.join(vals, c == F.col("_member"), how)
    p = f.strategy.predicate(c)
    return df.filter(p if f.mode == "INCLUDE" else ~p)


def apply_filters(df: DataFrame, filters, meta: FrameMeta = FrameMeta()) -> DataFrame:
    """Conjunction of all configured filters."""
    for f in filters:
        df = apply_filter(df, f, meta)
    return df


def employee_ids(person_ids: DataFrame, pid="pid", card_staff="egk_nr_ma",
                 number_staff="kv_nummer_ma") -> DataFrame:
    """Ids of persons holding a staff card or staff number, zero-padded to 10 (one column)."""
    staff = (F.coalesce(F.col(card_staff), F.lit("")) != "") | \
            (F.coalesce(F.col(number_staff), F.lit("")) != "")
    return (person_ids.filter(staff)
            .select(F.trim(pad_pid_10(F.col(pid).cast("string"))).alias("pid"))
            .filter(F.col("pid").isNotNull()))


def certain_diagnoses(df: DataFrame, certainty="diagnosesicherheit", contract="vertrags_id") -> DataFrame:
    """Confirmed diagnoses ('G') of the collective contract ('KV'), case-insensitive."""
    return df.filter((F.upper(F.col(certainty)) == "G") & (F.upper(F.col(contract)) == "KV"))


def data_family(df: DataFrame, insurers: list[str] | None = None, flag: str | None = None,
                insurer_col: str = "h2ik") -> DataFrame:
    """Rows of one data family: by insurer id (``h2ik IN (...)``) or by a flag
    column (``flag_<name> = 1``)."""
    if (insurers is None) == (flag is None):
        raise ValueError("give exactly one of insurers or flag")
    if insurers is not None:
        return df.filter(F.col(insurer_col).isin(list(insurers)))
    return df.filter(F.col(f"flag_{flag}").cast("int") == 1)
