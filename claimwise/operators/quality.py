"""Data-quality helpers: value cleaning rules, dataset separation, id mapping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimwise.operators.enrich import LookupColumns
from claimwise.operators.rowfilters import FrameMeta

# Warehouse type tags -> Spark type names (simpleString prefixes).
TYPE_FAMILIES = {
    "BYTE": ("binary",), "VARBYTE": ("binary",), "BLOB": ("binary",),
    "CHARACTER": ("string",), "VARCHAR": ("string",), "CLOB": ("string",),
    "DECIMAL": ("decimal",), "NUMBER": ("decimal",), "DATE": ("date",), "FLOAT": ("double", "float"),
    "INTEGER": ("int",), "BYTEINT": ("tinyint",), "SMALLINT": ("smallint",), "BIGINT": ("bigint",),
    # export values are text; ANY / UNKNOWN columns are the string columns
    "ANY": ("string",), "UNKNOWN": ("string",),
}


@dataclass(frozen=True)
class CleanRule:
    """Remove (or replace) characters matching ``exclude`` (Java regex) in the columns
    of a type (``rule='TYPE'``) or in one named column (``rule='NAME'``)."""

    rule: str
    exclude: str
    replace: str = ""
    type: str | None = None
    column: str | None = None

    def columns(self, df: DataFrame) -> list[str]:
        if self.rule == "NAME":
            return [c for c in df.columns if c.lower() == (self.column or "").lower()]
        fams = TYPE_FAMILIES.get((self.type or "").upper(), ())
        return [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(fams)]


def apply_clean_rules(df: DataFrame, rules) -> DataFrame:
    """Apply the rules in order; a cleaned column becomes text."""
    for r in rules:
        targets = set(r.columns(df))
        if not targets:
            continue
        df = df.select(*[F.regexp_replace(F.col(c).cast("string"), r.exclude, r.replace).alias(c)
                         if c in targets else F.col(c) for c in df.columns])
    return df


def separate_datasets(df: DataFrame, separation: DataFrame, h2ik: str = "h2ik") -> DataFrame:
    """Add ``dataset`` by insurer (``separation``: dataset, h2ik); rows of other insurers
    are dropped.  Write with ``partitionBy('dataset')`` to get one directory per set."""
    sep = separation.select("dataset", F.col("h2ik").alias("_sep_h2ik"))
    return df.join(sep, F.col(h2ik) == F.col("_sep_h2ik")).drop("_sep_h2ik")


def map_ids(df: DataFrame, mapping: DataFrame, source_key: str, target_key: str) -> DataFrame:
    """Append ``target_key`` looked up by ``source_key`` in a two-column mapping
    (source key, target id); "" when unmapped."""
    m = mapping.select(F.col(mapping.columns[0]).cast("string").alias(source_key),
                       F.col(mapping.columns[1]).cast("string").alias(target_key))
    return LookupColumns(m, (source_key,))(df, FrameMeta())


def _malformed_aggregates(kinds: dict[str, str]) -> list[Column]:
    """For the i-th column: ``v{i}`` (filled values) and ``m{i}`` (those not of its kind)."""
    aggs = []
    for i, (column, kind) in enumerate(kinds.items()):
        c = F.coalesce(F.col(column).cast("string"), F.lit(""))
        if kind == "int":
            good = c.rlike(r"\A[+-]?[0-9]+\z") & c.try_cast("int").isNotNull()
        elif kind == "float":
            good = c.try_cast("double").isNotNull()
        else:
            good = c.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & F.try_to_date(c, "yyyy-MM-dd").isNotNull()
        filled = c != ""
        aggs += [F.count(F.when(filled, 1)).alias(f"v{i}"), F.count(F.when(filled & ~good, 1)).alias(f"m{i}")]
    return aggs


def malformed_counts(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """How many values of each column are neither empty nor of its kind: (column, kind, n_values, n_malformed).

    ``kinds``: column -> ``int`` (digits with a sign, 32 bits, no blanks), ``float`` or ``date`` (yyyy-MM-dd).  One pass over
    the rows, a partial aggregate per column."""
    rows = F.array(*[F.struct(F.lit(column).alias("column"), F.lit(kind).alias("kind"), F.col(f"v{i}").alias("n_values"),
                              F.col(f"m{i}").alias("n_malformed")) for i, (column, kind) in enumerate(kinds.items())])
    return df.agg(*_malformed_aggregates(kinds)).select(F.explode(rows).alias("r")).select("r.*")


class MalformedCount:
    """Counts of malformed values taken while a frame is written, without a pass of their own.

    ``watch`` returns the frame to write; after the write, ``counts`` has (column, kind, n_values, n_malformed).  Columns that
    the frame lacks are not counted.  One count serves one write."""

    def __init__(self, kinds: dict[str, str]):
        self.kinds, self.seen = kinds, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        self.kinds = {c: k for c, k in self.kinds.items() if c in df.columns}
        return df.observe(self.seen, *_malformed_aggregates(self.kinds)) if self.kinds else df

    def counts(self) -> list[tuple[str, str, int, int]]:
        if not self.kinds:
            return []
        got = self.seen.get
        return [(column, kind, got[f"v{i}"], got[f"m{i}"]) for i, (column, kind) in enumerate(self.kinds.items())]
