"""Writers: slice files, slice merge, decode file, score files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimwise.sources.readers import allow_charset

SLICE_SEP = ";"
# gz files cannot be split on read
FILE_ROWS = 2_000_000

# CSV options so that values are written raw: empty string stays empty, no
# quoting, outer blanks kept.
# The writer quotes a value that holds the separator, a quote or a line break; ``file_values`` leaves none.
RAW_CSV = {
    "sep": SLICE_SEP, "header": "true", "emptyValue": "", "nullValue": "",
    "quote": "\u0000", "escape": "\u0000",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def file_values(df: DataFrame) -> DataFrame:
    """String values as they may stand in a ``;`` file: ``;`` becomes ``_``, quotes and NUL go, line breaks
    become blanks."""
    clean = {f.name: F.translate(F.translate(F.col(f"`{f.name}`"), ';"\u0000', "_"), "\r\n", "  ")
             for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.withColumns(clean) if clean else df


def db_short_name(db: str) -> str:
    """Text after the first '_' of a database name (whole name when there is none)."""
    return db.split("_", 1)[1] if "_" in db else db


def slice_path(root: str, db: str, dataset: str, table: str) -> str:
    """``<root>/<db short>/<dataset>/<table>`` — slices are ``slice=<year>`` below it."""
    return f"{root.rstrip('/')}/{db_short_name(db)}/{dataset}/{table}"


def write_slices(df: DataFrame, path: str, slice_col: str | None = None,
                 fmt: str = "csv", compression: str = "gzip", mode: str = "overwrite",
                 encoding: str = "UTF-8") -> None:
    """One directory per slice value; empty slices produce no files, and an empty result without slices no folder: the
    rows are counted while they are written.

    ``fmt='csv'`` writes raw ``;`` text with a header (gzip); ``'parquet'`` keeps types."""
    if fmt == "csv":
        allow_charset(df.sparkSession, encoding)
        df = file_values(df)
    seen = None
    if not slice_col:
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if slice_col:
        # rows of a slice meet in few tasks (a large slice in several): few files per directory
        df = df.hint("rebalance", slice_col)
    w = df.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS)
    if slice_col:
        w = w.partitionBy(slice_col)
    if fmt == "csv":
        w.options(**RAW_CSV).option("compression", compression).option("encoding", encoding).csv(path)
    else:
        w.option("compression", "zstd" if compression == "gzip" else compression).parquet(path)
    if seen is not None and not seen.get["rows"] and mode == "overwrite" and fmt == "csv":
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that was just written without rows (a header alone)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def merge_slices(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Concatenate year slices of one table by column name.

    Conflicting schemas fail unless ``allow_missing`` (missing columns become NULL)."""
    if not allow_missing:
        names = [tuple(sorted(f.columns)) for f in frames]
        if len(set(names)) > 1:
            raise ValueError(f"slices have different columns: {set(names)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def write_decode_file(df: DataFrame, path: str) -> None:
    """Decode mapping ``h2ik;egk_nr;kv_nummer;pid`` as one ``;`` CSV directory."""
    file_values(df.select("h2ik", "egk_nr", "kv_nummer", "pid")).write.mode("overwrite").options(**RAW_CSV).csv(path)


def write_scores(df: DataFrame, path: str) -> None:
    """Score rows partitioned by source table and window start."""
    (df.hint("rebalance", "source_table", "window_start").write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
     .partitionBy("source_table", "window_start").parquet(path))
