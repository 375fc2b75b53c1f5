"""The six jobs a user runs, composed from the operators and sinks.

export          one view: conditions, year slice, row filters, enrichment chain -> slice files
merge           slices of one table -> one table (by column name); merge_views: of all configured views of a slice tree
stats           overview (long + report table), reference quarter, regional ratios
makedecode      id rows -> exclusion list -> decoded mapping (+ loss frame) -> decode file
fingerprint     master / region / diagnosis / drug frames -> fingerprints -> master with pid_hash
scores          diagnosis facts + pattern list -> pattern matches -> sliding-window scores -> score files

Inputs are DataFrames (read with ``claimwise.sources.readers`` or ``spark.read``);
outputs go to paths below the shared folder the caller names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.functions.scalars import clean_value
from claimwise.operators import decode as D
from claimwise.operators import fingerprint as FP
from claimwise.operators import score as SC
from claimwise.operators import stats as ST
from claimwise.operators.enrich import FingerprintColumn, run_chain
from claimwise.operators.extract import ExtractSpec, extract, lower_columns
from claimwise.operators.quality import MalformedCount
from claimwise.operators.rowfilters import FrameMeta, apply_filters, certain_diagnoses
from claimwise.session import written
from claimwise.sources import layout as L
from claimwise.sources import sinks as W
from claimwise.sources import versions as V


def clean_frame(df: DataFrame) -> DataFrame:
    """Lower-case column names; every string value cleaned (``clean_value``: no NULL, separator or quote)."""
    df = lower_columns(df)
    return df.select(*[clean_value(f.name).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def export(view: DataFrame, spec: ExtractSpec, meta: FrameMeta, filters=(), steps=(),
           root: str | None = None, dataset: str = "default", slice_col: str | None = None,
           fmt: str = "csv", malformed: MalformedCount | None = None) -> DataFrame:
    """Export one view; when ``root`` is given, write it in the slice layout
    ``<root>/<db short>/<dataset>/<table>/<slice_col>=<year>/``.

    Column names are lowered and string values cleaned before the filters and steps see them.  ``malformed`` counts values that
    the steps cannot read, among the rows that passed the filters, while the slices are written."""
    df = apply_filters(clean_frame(extract(view, spec)), list(filters), meta)
    if malformed is not None:
        df = malformed.watch(df)
    df = run_chain(df, list(steps), meta)
    if root:
        W.write_slices(df, W.slice_path(root, meta.db, dataset, meta.table), slice_col, fmt=fmt)
    return df


def merge(slices: list[DataFrame], out: str | None = None, allow_missing: bool = False) -> DataFrame:
    """Concatenate the slices of one table by column name (optionally written as one table)."""
    merged = W.merge_slices(slices, allow_missing)
    if out:
        W.write_slices(merged, out, fmt="csv")
    return merged


def merge_views(spark: SparkSession, conf: dict, root: str, out: str, allow_missing: bool = False) -> list[L.Merged]:
    """Merge all configured views of the slice layout below ``root`` into one table each below ``out``."""
    return L.merge_configured(spark, conf, root, out, allow_missing)


@dataclass(frozen=True)
class StatsResult:
    overview: DataFrame
    report: DataFrame
    reference: DataFrame
    regional: DataFrame


def stats(slices: dict[str, DataFrame], lower_year: int, upper_year: int, reference_slice: str,
          region_cases: DataFrame, region_lookup: DataFrame, **regional_columns) -> StatsResult:
    """Quarterly statistics: long overview with ratios, report table (one column per slice),
    reference quarter (latest positive quarter of ``reference_slice``) and regional ratios."""
    long = ST.overview(slices, lower_year, upper_year)
    ref = ST.reference_quarter(slices[reference_slice], lower_year, upper_year)
    return StatsResult(long, ST.overview_pivot(long, list(slices)), ref,
                       ST.regional_ratio(region_cases, region_lookup, ref, **regional_columns))


def makedecode(ids: DataFrame, membership: DataFrame, insurers: list[str], order_cols: list[str],
               out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Decoded mapping and its loss frame; the mapping is written as a decode file when ``out``."""
    unwanted = written(D.outdated_card_holders(ids, membership, insurers), "unwanted")  # for the mapping and for its loss
    scoped = ids.filter(ids["h2ik"].isin(insurers))
    mapping = D.clean_ids(scoped, unwanted, order_cols)
    if out:
        W.write_decode_file(mapping, out)
    return mapping, D.loss_ratio(D.decode_input(scoped, unwanted), mapping)


def fingerprint(master: DataFrame, region: DataFrame, diagnoses: DataFrame, drugs: DataFrame,
                meta: FrameMeta = FrameMeta("ADB", "Vers_Stamm"), out: str | None = None,
                slice_col: str = "bezugsjahr") -> DataFrame:
    """Fingerprints of the master persons, appended to the master table as ``pid_hash``.

    With ``out`` the table there gets a new version (``sources.versions``; its first rows are the master's), in which only slices with changed
    persons are written."""
    spark = master.sparkSession
    fps = FP.fingerprints(master, region, certain_diagnoses(diagnoses), drugs)
    if out:
        if V.newest(spark, out) is None:
            V.create(master.drop("pid_hash"), out, slice_col)
        V.update_column(spark, out, fps.withColumnRenamed("fingerprint", "pid_hash"), "pid", "pid_hash")
        return V.read(spark, out)
    return run_chain(master, [FingerprintColumn(fps)], meta)


def scores(facts: DataFrame, patterns: DataFrame, start_year: int, end_year: int, as_of: str,
           insurers: list[str] | None = None, out: str | None = None) -> DataFrame:
    """Comorbidity scores per (source table, person, window start); written partitioned
    by source table and window start when ``out``."""
    result = SC.sliding_scores(SC.pattern_join(facts, patterns), start_year, end_year, as_of,
                               insurers=insurers)
    if out:
        W.write_scores(result, out)
    return result
