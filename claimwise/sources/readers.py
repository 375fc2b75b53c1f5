"""Readers for the delimited files the pipeline consumes.

All readers return string columns (export-layer values); typing happens in
the operators with ``try_*`` casts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimwise.functions.scalars import pad_zeros

SLICE_SEP = ";"
#: A separator that no line has: such a file has one column.
NO_SEP = "\u0001\u0002\u0003"
# charsets that Spark's text sources know without further ado
PLAIN_CHARSETS = {"utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"}


def allow_charset(spark: SparkSession, encoding: str) -> None:
    """Let the session read and write a code page of the JVM (windows-1252) beside the plain charsets."""
    if encoding.lower() not in PLAIN_CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def read_slices(spark: SparkSession, path: str | list[str], sep: str = SLICE_SEP,
                encoding: str = "UTF-8", base: str | None = None) -> DataFrame:
    """Headered ``;`` CSV slices (gz decompressed by file extension), all columns strings.

    Empty fields are empty strings (the export layer has no NULL), blanks are kept.
    All files must have the columns of the first one in the same order: another header is
    refused (``layout.read_table`` reads such slices by name).
    Partition columns of a sliced layout (``slice=<year>``) are discovered by Spark; ``base`` is the folder above them when
    single slices are given."""
    allow_charset(spark, encoding)
    reader = spark.read.option("basePath", base) if base else spark.read
    df = (reader.option("header", True).option("sep", sep).option("encoding", encoding)
          .option("inferSchema", False).option("enforceSchema", False)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .option("quote", "\u0000")
          .csv(path))
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def read_delimited_checked(spark: SparkSession, path: str, columns: list[str],
                           sep: str = SLICE_SEP, header: bool = True) -> DataFrame:
    """Every line of a delimited file with a fixed field count, good or not, in one scan.

    Columns: those of the file (NULL on a line with another field count), then ``_file``, ``_text`` (the line) and ``_reason`` (NULL on
    a good line).  Blank lines are skipped.

    The first line of each file is its header, by its place in the file and not by its text, so a data line that equals the header is
    data; another header than ``columns`` is refused.  Lines are read whole (as values of one column, between separators
    that no text has) and split afterwards, so the field count holds under column pruning (the CSV reader's DROPMALFORMED does not)."""
    line = sep.join(columns) if header else "value"
    lines = (spark.read.schema(StructType([StructField(line, StringType())])).option("header", header).option("enforceSchema", not header)
             .option("sep", NO_SEP).option("quote", "\u0000").option("escape", "\u0000")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    # the file's name while the column of lines is still a file column
    lines = lines.select(F.col(f"`{line}`").alias("_text"), F.col("_metadata.file_path").alias("_file"))
    parts = F.split(F.col("_text"), _regex_quote(sep), -1)
    n = F.size("_p")
    good = n == len(columns)
    return lines.withColumn("_p", parts).select(
        *[F.when(good, F.col("_p").getItem(i)).alias(c) for i, c in enumerate(columns)], "_file", "_text",
        F.when(~good, F.format_string(f"%d fields instead of {len(columns)}", n)).alias("_reason"))


def read_delimited_strict(spark: SparkSession, path: str, columns: list[str],
                          sep: str = SLICE_SEP, header: bool = True) -> DataFrame:
    """The good lines of ``read_delimited_checked`` (the reference logs the others and returns an empty row)."""
    return read_delimited_checked(spark, path, columns, sep, header).filter("_reason IS NULL").select(*[F.col(f"`{c}`") for c in columns])


@dataclass(frozen=True)
class StrictRead:
    """What one scan of a delimited file gave: its rows, its rejects (_file, _text, _reason) and the numbers of both."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def read_delimited_once(spark: SparkSession, path: str, columns: list[str], into: str,
                        sep: str = SLICE_SEP, header: bool = True) -> StrictRead:
    """Scan a delimited file once: rows and rejects are written below ``into``, and counted as they pass."""
    seen = Observation()
    checked = read_delimited_checked(spark, path, columns, sep, header).withColumn("_kind", F.when(F.col("_reason").isNull(), "row").otherwise("reject"))
    counted = checked.observe(seen, F.count(F.when(F.col("_kind") == "row", 1)).alias("rows"), F.count("_reason").alias("rejects"))
    # the text of a good line is its fields
    counted.withColumn("_text", F.when(F.col("_kind") == "reject", F.col("_text"))).write.partitionBy("_kind").parquet(into)
    both = spark.read.schema(checked.schema).parquet(into)
    return StrictRead(both.filter("_kind = 'row'").select(*[F.col(f"`{c}`") for c in columns]),
                      both.filter("_kind = 'reject'").select("_file", "_text", "_reason"), seen.get["rows"], seen.get["rejects"])


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def year_predicates(column: str, first_year: int, last_year: int, conditions: tuple[str, ...] = ()) -> list[str]:
    """One condition for each year of a closed range, so that every year of a warehouse table is read by a task of its own; none
    overlap and no year is left out.  ``conditions`` are added to each."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*", column):
        raise ValueError(f"not a column name: {column}")
    if first_year > last_year:
        raise ValueError(f"no years from {first_year} to {last_year}")
    return [" AND ".join([f"{column} = {year}", *(f"({c})" for c in conditions)]) for year in range(first_year, last_year + 1)]


def read_relational(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str | None = None,
                    first_year: int | None = None, last_year: int | None = None, conditions: tuple[str, ...] = ()) -> DataFrame:
    """A warehouse view over JDBC: one query per year of ``column``, or one query without it."""
    if column is None:
        return spark.read.jdbc(url, table, predicates=[" AND ".join(f"({c})" for c in conditions) or "1 = 1"], properties=properties)
    return spark.read.jdbc(url, table, predicates=year_predicates(column, first_year, last_year, conditions), properties=properties)


def read_by_index(spark: SparkSession, path: str, columns: dict[str, int], key_index: int,
                  key_name: str = "key", key_width: int | None = None,
                  sep: str = SLICE_SEP) -> DataFrame:
    """Headerless reference file, columns taken by position; blank lines skipped.

    Adds ``_file`` and ``_line``, by which the last line of a key wins (``operators.enrich.consolidate``): the order of lines
    is that of file names and, inside a file, of its rows."""
    raw = spark.read.text(path).filter(F.col("value") != "")
    raw = raw.withColumn("_file", F.input_file_name()).withColumn(
        "_line", F.monotonically_increasing_id())
    parts = F.split(F.col("value"), _regex_quote(sep), -1)
    key = parts.getItem(key_index)
    if key_width:
        key = pad_zeros(key, key_width)
    return raw.select(key.alias(key_name),
                      *[parts.getItem(i).alias(name) for name, i in columns.items()],
                      "_file", "_line")


def read_mapping(spark: SparkSession, path: str, sep: str = SLICE_SEP) -> DataFrame:
    """Headered mapping file (first k columns are the key, rest are values)."""
    return read_slices(spark, path, sep)


def read_value_list(spark: SparkSession, path: str) -> DataFrame:
    """Condition values, one per line (column ``value``); blank lines ignored.

    A missing file is an error (fail fast) rather than an empty list."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.trim("value").alias("value"))


def read_score_patterns(spark: SparkSession, path: str, sep: str = SLICE_SEP) -> DataFrame:
    """Pattern file ``icd_code;disease_class;cci_weight`` with header, blank lines skipped."""
    return (spark.read.option("header", True).option("sep", sep)
            .schema("icd_code string, disease_class string, cci_weight int").csv(path)
            .filter(F.col("icd_code").isNotNull() & (F.col("icd_code") != "")))


def read_morbidity_report(spark: SparkSession, path: str, sep: str = SLICE_SEP) -> DataFrame:
    """Morbidity report file; the (insurance, setup) pair is a key column, not a nested map."""
    return read_slices(spark, path, sep)
