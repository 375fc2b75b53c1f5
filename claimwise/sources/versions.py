"""Sliced tables in versions: a column is updated without touching what readers read.

Below a table's folder::

    data/v=<version>-<unique>/<slice column>=<value>/   rows, written once and never changed
    versions/<version>/                                  one small file: slice -> folder of its rows

A version exists from the moment its one manifest file does, so an update that is interrupted before leaves the
last version readable, and of two updates of one version the second fails.  Slices without a changed row are not written again: the new
manifest names their old folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, slice_column string, slice string, path string"


@dataclass(frozen=True)
class Version:
    number: int
    slice_column: str
    paths: dict[str, str]  # slice -> folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def newest(spark: SparkSession, base: str) -> Version | None:
    """The newest version of a table, from its manifests (a row per slice and version)."""
    if not exists(spark, f"{base}/versions"):
        return None
    every = spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{base}/versions")
    last = every.agg(F.max("version")).first()[0]
    if last is None:
        return None
    rows = every.filter(F.col("version") == last).collect()
    return Version(last, rows[0]["slice_column"], {r["slice"]: r["path"] for r in rows if r["slice"] is not None})


def _publish(spark: SparkSession, base: str, version: Version) -> Version:
    rows = [(version.number, version.slice_column, s, p) for s, p in sorted(version.paths.items())] or [(version.number, version.slice_column, None, None)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{base}/versions/{version.number:09d}")
    return version


def _write(df: DataFrame, base: str, number: int, slice_column: str) -> dict[str, str]:
    """Write rows by slice; the folders by slice."""
    path = f"{base}/data/v={number}-{uuid.uuid4().hex[:12]}"
    df.hint("rebalance", slice_column).write.partitionBy(slice_column).parquet(path)
    if not exists(df.sparkSession, f"{path}/_SUCCESS"):
        raise RuntimeError(f"{path} was not written whole")
    written = df.sparkSession.read.schema(f"`{slice_column}` string").parquet(path).select(slice_column).distinct()
    return {r[0]: f"{path}/{slice_column}={r[0]}" for r in written.collect()}  # slices are few


def create(df: DataFrame, base: str, slice_column: str) -> Version:
    """The first version of a table.  Slice values are short texts or numbers without special characters, and not null."""
    return _publish(df.sparkSession, base, Version(1, slice_column, _write(df, base, 1, slice_column)))


def read(spark: SparkSession, base: str, version: Version | None = None, slices: list[str] | None = None) -> DataFrame:
    """The rows of a version (the newest, if none is given), of all slices or some."""
    version = version or newest(spark, base)
    if version is None:
        raise FileNotFoundError(f"no version of {base}")
    paths = [p for s, p in version.paths.items() if slices is None or s in slices]
    if not paths:
        raise ValueError(f"{base}: version {version.number} has none of these slices")
    return spark.read.option("basePath", f"{base}/data").parquet(*paths).drop("v")


def update_column(spark: SparkSession, base: str, values: DataFrame, key: str, column: str, default: str = "") -> Version:
    """A version in which ``column`` is that of ``values`` (``key``, ``column``; one row a key), ``default`` for other keys.

    Only slices in which a row's value changes are written; if there is none, the version stays."""
    now = newest(spark, base)
    if now is None:
        raise FileNotFoundError(f"no version of {base}")
    rows = read(spark, base, now)
    new = values.select(F.col(key).alias("_key"), F.col(column).cast("string").alias("_new"))
    joined = rows.join(new, F.col(key) == F.col("_key"), "left").withColumn("_new", F.coalesce("_new", F.lit(default)))
    known = column in rows.columns
    changed = joined.filter(~F.col(column).cast("string").eqNullSafe(F.col("_new"))) if known else joined
    slices = [str(r[0]) for r in changed.select(now.slice_column).distinct().collect()]  # slices are few
    if not slices:
        return now
    touched = read(spark, base, now, slices).join(new, F.col(key) == F.col("_key"), "left")
    columns = rows.columns if known else [*rows.columns, column]
    touched = touched.select(*[F.coalesce("_new", F.lit(default)).alias(c) if c == column else F.col(c) for c in columns])
    number = now.number + 1
    return _publish(spark, base, Version(number, now.slice_column, now.paths | _write(touched, base, number, now.slice_column)))
