"""Configuration-driven extract: projection, conditions, year slices, joins.

An ``ExtractSpec`` describes one view: which columns, which conditions
(values of one condition are OR-ed, conditions are AND-ed), an optional year
slice and optional joins.  ``extract`` turns it into one DataFrame; Catalyst
pushes the conditions and the column list into the scans.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwise.operators.lookup import like_matches

OPERATORS = ("=", "<", ">", "like")
KINDS = ("NUMERIC", "STRING", "COLUMN")


@dataclass(frozen=True)
class Where:
    """One condition: ``column <op> value`` for each value, values OR-ed.

    ``values`` are inline values; ``value_frame`` is a one-column frame of
    values (e.g. read from a file with ``sources.readers.read_value_list``)."""

    column: str
    values: tuple = ()
    op: str = "="
    kind: str = "STRING"
    value_frame: DataFrame | None = None

    def __post_init__(self):
        if self.op not in OPERATORS:
            raise ValueError(f"unsupported operator {self.op}")
        if self.kind not in KINDS:
            raise ValueError(f"unsupported operand kind {self.kind}")


@dataclass(frozen=True)
class YearSlice:
    """Inclusive year range on ``column`` (fixed), or the ``as_of`` year and
    ``previous`` years before it (dynamic)."""

    column: str
    start: int | None = None
    end: int | None = None
    previous: int | None = None
    as_of: str | None = None
    date_column: str | None = None  # stored date of the slice year: bounds on it reach the scan

    def bounds(self) -> tuple[int, int]:
        if self.previous is not None:
            year = _dt.date.fromisoformat(self.as_of).year
            return year - self.previous, year
        return int(self.start), int(self.end)


@dataclass(frozen=True)
class JoinSpec:
    frame: DataFrame
    on: tuple[str, ...]
    how: str = "inner"
    columns: tuple[str, ...] | None = None  # None = all columns of the joined frame
    exclude: tuple[str, ...] = ()
    where: tuple[Where, ...] = ()           # conditions on the joined frame; rows without a match fail them

    def __post_init__(self):
        if self.how not in ("inner", "left"):
            raise ValueError("join type must be inner or left")


@dataclass(frozen=True)
class ExtractSpec:
    columns: tuple[str, ...] | None = None   # None / () = all columns
    exclude: tuple[str, ...] = ()
    where: tuple[Where, ...] = ()
    global_where: tuple[Where, ...] = ()
    year_slice: YearSlice | None = None
    joins: tuple[JoinSpec, ...] = field(default_factory=tuple)


def _operand(v, kind: str) -> Column:
    if kind == "COLUMN":
        return F.col(v)
    if kind == "NUMERIC":
        return _number(v)
    return F.lit(str(v))


def _number(v) -> Column:
    """A numeric literal without loss of digits: whole numbers as integers, others as decimals."""
    try:
        d = Decimal(str(v).strip())
    except InvalidOperation:
        return F.lit(None).cast("double")
    if not d.is_finite():
        return F.lit(float(d))
    if d == d.to_integral_value() and abs(d) < 2**63:
        return F.lit(int(d)).cast("long")
    return F.lit(v) if isinstance(v, float) else F.lit(d)


def _compare(c: Column, op: str, operand: Column) -> Column:
    if op == "=":
        return c == operand
    if op == "<":
        return c < operand
    if op == ">":
        return c > operand
    return F.like(c, operand)


def or_group(w: Where) -> Column:
    """Inline values of one condition OR-ed; ``=`` on literals becomes ``isin``.

    An empty list matches no row (``isin([])`` is false)."""
    c = F.col(w.column)
    if w.op == "=" and w.kind != "COLUMN":
        return c.isin([_operand(v, w.kind) for v in w.values])
    preds = [_compare(c, w.op, _operand(v, w.kind)) for v in w.values]
    return reduce(or_, preds) if preds else F.lit(False)


def apply_value_frame(df: DataFrame, w: Where) -> DataFrame:
    """Condition whose values come from a frame (FLT7).

    ``=``   left-semi join on the value
    ``<``   ``c < max(values)`` (one-row aggregate, broadcast)
    ``>``   ``c > min(values)``
    ``like`` left-semi join with the column's distinct values that match a pattern

    Numeric values are compared in the column's own type (integers as decimals of 38 digits)."""
    vals = w.value_frame.select(F.col(w.value_frame.columns[0]).alias("_v"))
    c = F.col(w.column)
    if w.kind == "NUMERIC":
        kind = df.schema[w.column].dataType.simpleString()
        exact = "decimal(38,6)" if kind in ("tinyint", "smallint", "int", "bigint") else kind if kind.startswith("decimal") else "double"
        vals = vals.select(F.col("_v").cast("string").try_cast(exact).alias("_v")).filter("_v IS NOT NULL")
        c = c.cast(exact)
    if w.op == "=":
        return df.join(vals.distinct(), c == F.col("_v"), "left_semi")
    if w.op in ("<", ">"):
        agg = F.max("_v") if w.op == "<" else F.min("_v")
        one = F.broadcast(vals.agg(agg.alias("_b")))
        cond = (c < F.col("_b")) if w.op == "<" else (c > F.col("_b"))
        return df.join(one, cond, "left_semi")
    matched = like_matches(df.select(w.column), vals).select(F.col("value").alias("_m")).distinct()
    return df.join(matched, c == F.col("_m"), "left_semi")


def apply_where(df: DataFrame, conditions) -> DataFrame:
    """AND over conditions (each an OR group or a value-frame condition)."""
    for w in conditions:
        df = apply_value_frame(df, w) if w.value_frame is not None else df.filter(or_group(w))
    return df


def slice_filter(df: DataFrame, ys: YearSlice | None) -> DataFrame:
    """Year slice when the frame has the slice column; otherwise the whole frame (one slice)."""
    if ys is None or ys.column not in df.columns:
        return df
    lo, hi = ys.bounds()
    if ys.date_column and ys.date_column in df.columns:
        d = F.col(ys.date_column)
        df = df.filter((d >= F.lit(_dt.date(lo, 1, 1))) & (d < F.lit(_dt.date(hi + 1, 1, 1))))
    return df.filter(F.col(ys.column).between(lo, hi))


def project(df: DataFrame, columns=None, exclude=()) -> DataFrame:
    """Explicit column list; all columns when empty; minus an exact-name exclude list."""
    if columns:
        df = df.select(*columns)
    if exclude:
        df = df.select(*[c for c in df.columns if c not in set(exclude)])
    return df


def join_views(df: DataFrame, joins) -> DataFrame:
    """Equi joins on shared column names; the join key is kept once.

    A joined view's conditions stand beside those of the base view, after the join: a row of a left join that finds no
    partner fails them, so such a join keeps matched rows only, and the conditions are pushed to the joined scan.  Then follow its column
    list and excludes.  A joined column whose name is taken gets the join's number: ``name_1`` from the first join."""
    for n, j in enumerate(joins, 1):
        right = project(apply_where(j.frame, j.where), None, tuple(c for c in j.exclude if c not in j.on))
        if j.columns:
            right = right.select(*dict.fromkeys(list(j.on) + list(j.columns)))
        taken = set(df.columns) - set(j.on)
        right = right.toDF(*[f"{c}_{n}" if c in taken else c for c in right.columns])
        df = df.join(right, list(j.on), "inner" if j.where else j.how)
    return df


def extract(base: DataFrame, spec: ExtractSpec) -> DataFrame:
    """One view: global + local conditions, year slice, joins, then the projection."""
    df = apply_where(base, spec.global_where)
    df = apply_where(df, spec.where)
    df = slice_filter(df, spec.year_slice)
    df = join_views(df, spec.joins)
    return project(df, spec.columns, spec.exclude)


def lower_columns(df: DataFrame) -> DataFrame:
    """Column names to lower case (PRJ5)."""
    return df.toDF(*[c.lower() for c in df.columns])
