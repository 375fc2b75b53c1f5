"""Walk of a slice layout and merge of the configured views in it.

Two forms are known below a root folder, both by (database, data set)::

    <db short>/<dataset>/<table>/[<column>=<slice>/]part-*.csv.gz     what ``sinks.write_slices`` writes
    <db short>/<dataset>/<db>_<table>.<slice>.csv.gz                  one file per slice

A table is merged if its view is configured.  Slices of one header are read by one scan, scans of different headers are put together by
column name.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.sources.readers import SLICE_SEP, read_slices
from claimwise.sources.sinks import merge_slices, write_slices

LOG = logging.getLogger(__name__)
#: Text in a view's name -> prefix of its slice files.
FILE_PREFIXES = {"EVA": "SB_HRI_", "ADB": "ACC_ADB_", "FDB": "ACC_FDB_"}
#: Headers that the driver asks for at once.
ASKED = 8


@dataclass(frozen=True)
class Table:
    """A table of the layout: its database and data set folders, its name and, of each slice that has bytes, the path (a folder or a file)."""

    db: str
    dataset: str
    name: str
    slices: tuple[str, ...]
    base: str | None  # folder whose ``<column>=<slice>`` names become a column


@dataclass(frozen=True)
class Merged:
    table: Table
    frame: DataFrame
    path: str | None


def configured_views(conf: dict) -> list[str]:
    """Names of all views of a configuration: of its ``sources``, or its own."""
    return [view["name"] for source in conf.get("sources", [conf]) for view in source.get("views", ())]


def file_name(view: str) -> str:
    """Name of a view's slice files before the first point."""
    return next((prefix + view for mark, prefix in FILE_PREFIXES.items() if mark in view), view)


def walk(spark: SparkSession, root: str, views: list[str]) -> list[Table]:
    """Tables of the configured views below ``root``.  Only names of files are listed.

    Files without bytes are left out (the listing does not have them); views without any other are reported."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv*").load(root)
              .select("path").collect())
    wanted, files = set(views), {file_name(v): v for v in views}
    top = _plain(root)
    slices_of: dict[tuple, set[str]] = defaultdict(set)
    for row in listed:
        path = row["path"]
        parts = _plain(path)[len(top):].strip("/").split("/")
        if len(parts) > 3 and parts[2] in wanted:
            base = path.rsplit("/", len(parts) - 3)[0]
            slices_of[(*parts[:3], base)].add(path.rsplit("/", 1)[0])
        elif len(parts) == 3 and parts[2].split(".")[0] in files:
            slices_of[(*parts[:2], files[parts[2].split(".")[0]], None)].add(path)
    out = [Table(db, dataset, name, tuple(sorted(slices)), base) for (db, dataset, name, base), slices in sorted(slices_of.items(), key=lambda x: x[0][:3])]
    for view in sorted(wanted.difference(t.name for t in out)):
        LOG.warning("view %s has no slices, or empty ones only, and is not merged", view)
    return out


def _plain(path: str) -> str:
    """A path without its scheme and authority."""
    if "://" in path:
        path = "/" + path.split("://", 1)[1].partition("/")[2]
    elif path.startswith("file:"):
        path = path[len("file:"):]
    return path.rstrip("/")


def read_table(spark: SparkSession, table: Table, allow_missing: bool = False, encoding: str = "UTF-8", sep: str = SLICE_SEP) -> DataFrame:
    """All slices of a table by column name: one scan for the slices of each header.

    Slices with other columns are refused, unless ``allow_missing``: then what a slice lacks is the empty text."""

    def header(path: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("quote", "\u0000").csv(path).columns)

    with ThreadPoolExecutor(ASKED) as pool:
        headers = list(pool.map(header, table.slices))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, names in zip(table.slices, headers, strict=True):
        if names:
            groups[names].append(path)
    frames = [read_slices(spark, paths, sep, encoding, base=table.base) for paths in groups.values()]
    merged = merge_slices(frames, allow_missing)
    first = list(dict.fromkeys(c for f in frames for c in f.columns))
    texts = {f.name for f in merged.schema.fields if f.dataType.simpleString() == "string"}
    return merged.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in texts else F.col(f"`{c}`") for c in first])


def merge_configured(spark: SparkSession, conf: dict, root: str, out: str | None = None, allow_missing: bool = False,
                     encoding: str = "UTF-8") -> list[Merged]:
    """Merge every configured view found below ``root``; written to ``<out>/<db short>/<dataset>/<table>`` if ``out`` is given."""
    result = []
    for table in walk(spark, root, configured_views(conf)):
        frame = read_table(spark, table, allow_missing, encoding)
        path = f"{out.rstrip('/')}/{table.db}/{table.dataset}/{table.name}" if out else None
        if path:
            write_slices(frame, path, encoding=encoding)
        result.append(Merged(table, frame, path))
    return result
