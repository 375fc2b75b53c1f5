"""From a configuration (JSON or a dict) to extracts, filters and steps.

An export configuration names a database, a year slice, conditions for all views and the views::

    {"db": "ACC_ADB", "datasetName": "d1", "yearSlice": {"column": "bezugsjahr", "startYear": 2016, "endYear": 2018},
     "where": [{"column": "h2ik", "operator": "EQUAL", "columnType": "STRING", "values": ["1"]}],
     "views": [{"name": "AVK_X", "columns": [...], "excludeColumns": [...], "where": [...],
                "joins": [{"name": "AVK_Y", "joinType": "LEFT", "onColumns": [...], "columns": [...], "excludeColumns": [...], "where": [...]}]}],
     "filters": [{"name": "staff", "column": "pid", "database": "ACC_ADB", "table": "AVK_X", "filterStrategy": {"type": "EMPLOYEE_PIDS"}, "mode": "EXCLUDE"}],
     "transformers": [{"mode": "STATIC", ...}, ...]}

Several such sources may stand under ``sources``; filters and transformers stand beside it and hold for all.  A filter's strategy is
built by its type from ``STRATEGIES``, to which ``register_strategy`` adds a user's own.  Unknown keys, strategies and filter modes are errors.

Without a year slice, or with ``{"previousYears": n}``, the slice is the ``as_of`` year and the n (3) before it.
A transformer of an unknown mode or without its mandatory fields becomes a step that does nothing and says why.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.operators import fingerprint as FP
from claimwise.operators import rowfilters as RF
from claimwise.operators import score as SC
from claimwise.operators.decode import Decoding
from claimwise.operators.extract import ExtractSpec, JoinSpec, Where, YearSlice
from claimwise.operators.rowfilters import FrameMeta
from claimwise.operators.stats import DataSet
from claimwise.plans.commands import export
from claimwise.sources import versions as V
from claimwise.sources.readers import read_by_index, read_mapping, read_score_patterns, read_value_list
from claimwise.sources.sinks import write_scores

LOG = logging.getLogger(__name__)
OPERATORS = {"EQUAL": "=", "LESSER": "<", "LESS": "<", "GREATER": ">", "LARGER": ">", "LIKE": "like", "=": "=", "<": "<", ">": ">"}
DEFAULT_SLICE = ("bezugsjahr", 3)


def load(source: str | dict) -> dict:
    """A configuration from a JSON text, or as it is."""
    return json.loads(source) if isinstance(source, str) else source


def where_of(spark: SparkSession, conf: dict) -> Where:
    """One condition: values in place, or one per line of ``conditionFile``."""
    op = OPERATORS.get(str(conf.get("operator", "EQUAL")).upper())
    if op is None:
        raise ValueError(f"unknown operator {conf['operator']}")
    kind = conf.get("columnType", "STRING").upper()
    if conf.get("conditionFile"):
        return Where(conf["column"], op=op, kind=kind, value_frame=read_value_list(spark, conf["conditionFile"]))
    return Where(conf["column"], tuple(conf.get("values", ())), op, kind)


def slice_of(conf: dict | None, as_of: str | None) -> YearSlice | None:
    conf = conf or {}
    column = conf.get("column", DEFAULT_SLICE[0])
    if "startYear" in conf:
        return YearSlice(column, int(conf["startYear"]), int(conf["endYear"]), date_column=conf.get("dateColumn"))
    if as_of is None:
        return None
    return YearSlice(column, previous=int(conf.get("previousYears", DEFAULT_SLICE[1])), as_of=as_of, date_column=conf.get("dateColumn"))


def spec_of(spark: SparkSession, view: dict, frames: dict[str, DataFrame], where: list[dict] = (), slice_: YearSlice | None = None) -> ExtractSpec:
    """The extract of one view; ``frames`` holds the views by name."""
    joins = tuple(JoinSpec(
        frames[j["name"]], tuple(j["onColumns"]), j.get("joinType", "INNER").lower(), tuple(j["columns"]) if j.get("columns") else None,
        tuple(j.get("excludeColumns", ())), tuple(where_of(spark, w) for w in j.get("where", ()))) for j in view.get("joins", ()))
    return ExtractSpec(tuple(view.get("columns") or ()) or None, tuple(view.get("excludeColumns") or ()), tuple(where_of(spark, w) for w in view.get("where", ())),
                       tuple(where_of(spark, w) for w in where), slice_, joins)


def _static(spark: SparkSession, c: dict):
    return E.StaticColumn(c["valueName"], c["value"], c.get("order", "LAST").upper() == "FIRST", c.get("targetDb"), c.get("targetTable"), tuple(c.get("excludeTables") or ()))


def _catalogue(spark: SparkSession, c: dict):
    if not c.get("sources") or not c.get("keyColumn"):
        return E.Noop("sources or key column missing")
    if not c.get("targetDb") and not c.get("targetTable"):
        return E.Noop("target database and table missing")
    sources = []
    for s in c["sources"]:
        frame = read_by_index(spark, s["file"], {x["column"]: x["index"] for x in s["columns"]}, s["keyColumnIndex"], key_width=E.PZN_WIDTH)
        sources.append(E.CatalogueSource(frame, tuple(x["column"] for x in s["columns"] if not x.get("meta")), tuple(x["column"] for x in s["columns"] if x.get("meta"))))
    return E.DrugCatalogue(tuple(sources), c["keyColumn"], c.get("targetDb"), c.get("targetTable"))


def _lookup(spark: SparkSession, c: dict):
    return E.LookupColumns(read_mapping(spark, c["file"]), tuple(c["keyColumns"]), c.get("targetDb"), c.get("targetTable"))


#: mode -> (mandatory fields, builder)
MODES: dict[str, tuple[tuple[str, ...], Callable]] = {
    "STATIC": (("valueName", "value"), _static),
    "DDD": ((), _catalogue),
    "BS_TO_KV": ((), lambda spark, c: E.RegionFromPractice()),
    "APO_TYPE": ((), lambda spark, c: E.PharmacyType(db=c.get("targetDb"), table=c.get("targetTable"))),
    "DYNAMIC": (("file", "keyColumns"), _lookup),
    "START_DATE": (("endDateColumn", "dayColumn", "valueName"), lambda spark, c: E.StartDate(
        c["endDateColumn"], c["dayColumn"], c["valueName"], c.get("targetDb"), c.get("targetTable"))),
    "FIX_DATES": ((), lambda spark, c: E.FixMissingDates()),
    "PSEUDO_HASH": ((), lambda spark, c: E.PseudoHash()),
}


def step_of(spark: SparkSession, conf: dict):
    """The step of one transformer configuration."""
    fields, build = MODES.get(str(conf.get("mode", "")).upper(), (None, None))
    if build is None:
        step = E.Noop(f"unknown mode {conf.get('mode')}")
    elif missing := [f for f in fields if not conf.get(f)]:
        step = E.Noop(f"{conf['mode']}: missing {', '.join(missing)}")
    else:
        step = build(spark, conf)
    if isinstance(step, E.Noop):
        LOG.warning("transformer without effect: %s", step.reason)
    return step


#: View of the persons with their staff cards and numbers, unless a strategy names another.
STAFF_VIEW = "AVK_ADB_PID_AKTUELL"


def _pattern(spark: SparkSession, c: dict, frames: dict[str, DataFrame]):
    return RF.RegexStrategy(c["regexPattern"])


def _values(spark: SparkSession, c: dict, frames: dict[str, DataFrame]):
    if c.get("valueFile"):
        return RF.FrameSetStrategy(read_value_list(spark, c["valueFile"]))
    return RF.SetStrategy(tuple(str(v) for v in c.get("values", ())))


def _employees(spark: SparkSession, c: dict, frames: dict[str, DataFrame]):
    return RF.FrameSetStrategy(RF.employee_ids(frames[c.get("view", STAFF_VIEW)]))


#: type -> builder(spark, strategy configuration, views by name).  A strategy has ``predicate(column)`` or is a ``FrameSetStrategy``.
STRATEGIES: dict[str, Callable] = {"PATTERN": _pattern, "UNIQUE_SET": _values, "EMPLOYEE_PIDS": _employees}


def register_strategy(kind: str, build: Callable) -> None:
    """Make a user's filter strategy known under a type; a known type is not replaced."""
    if kind in STRATEGIES:
        raise ValueError(f"filter strategy {kind} is known already")
    STRATEGIES[kind] = build


def filter_of(spark: SparkSession, conf: dict, frames: dict[str, DataFrame]) -> RF.RowFilter:
    """The row filter of one configuration."""
    _known(conf, ("name", "database", "table", "column", "filterStrategy", "mode"), "filter")
    strategy = conf.get("filterStrategy") or {}
    if strategy.get("type") not in STRATEGIES:
        raise ValueError(f"unknown filter strategy {strategy.get('type')}")
    if conf.get("mode") not in ("INCLUDE", "EXCLUDE"):
        raise ValueError(f"unknown filter mode {conf.get('mode')}")
    if not conf.get("column"):
        raise ValueError("a filter needs a column")
    return RF.RowFilter(conf["column"], STRATEGIES[strategy["type"]](spark, strategy, frames), conf["mode"], conf.get("database"), conf.get("table"))


def datasets_of(conf: str | dict) -> list[DataSet]:
    """The data sets of the statistics section: ``{"statistics": {"datasets": [{"db", "dataset", "views", "h2iks" or "flag", "startYear", "endYear"}]}}``."""
    out = []
    for c in load(conf)["statistics"]["datasets"]:
        _known(c, ("db", "dataset", "views", "h2iks", "flag", "startYear", "endYear"), "data set")
        out.append(DataSet(c["dataset"], int(c["startYear"]), int(c["endYear"]), tuple(c["views"]),
                           tuple(str(x) for x in c["h2iks"]) if c.get("h2iks") is not None else None, c.get("flag")))
    if len({s.name for s in out}) < len(out):
        raise ValueError("a data set is configured twice")
    return out


def decodings_of(conf: str | dict) -> list[Decoding]:
    """The decode section: ``{"decode": [{"name", "h2iks"}]}``."""
    out = []
    for c in load(conf)["decode"]:
        _known(c, ("name", "h2iks"), "decoding")
        out.append(Decoding(c["name"], tuple(str(x) for x in c["h2iks"])))
    if len({x.name for x in out}) < len(out):
        raise ValueError("a decoding is configured twice")
    return out


def scores_from_config(spark: SparkSession, conf: str | dict, facts: DataFrame, as_of: str, out: str | None = None) -> DataFrame:
    """Scores of all sources of the score section, by ``dataset``: ``{"cci": {"cciFile", "startYear", "endYear", "sources": [{"db", "dataset", "iks" or "flag"}]}}``.

    The facts meet the patterns once; then each counts in every source that has its insurer or flag, in one run of the windows.  The insurer of a
    row is the smallest of its facts."""
    c = load(conf)["cci"]
    _known(c, ("cciFile", "startYear", "endYear", "sources", "tempDb"), "score section")
    members = []
    for source in c["sources"]:
        _known(source, ("db", "dataset", "iks", "flag"), "score source")
        if (source.get("iks") is None) == (source.get("flag") is None):
            raise ValueError(f"score source {source['dataset']}: give exactly one of iks or flag")
        held = F.col("h2ik").isin([str(x) for x in source["iks"]]) if source.get("iks") is not None else F.col(f"flag_{source['flag']}").cast("int") == 1
        members.append(F.when(held, F.lit(source["dataset"])))
    matched = SC.pattern_join(facts, read_score_patterns(spark, c["cciFile"]))
    sets = F.array_compact(F.array(*members)) if members else F.array().cast("array<string>")
    scores = SC.sliding_scores(matched.withColumn("dataset", F.explode(sets)), int(c["startYear"]), int(c["endYear"]), as_of, by=("dataset",))
    if out:
        write_scores(scores, out)
    return scores


def fingerprints_from_config(conf: str | dict, base: DataFrame, region: DataFrame, diagnoses: DataFrame, drugs: DataFrame,
                             states: str | None = None) -> DataFrame:
    """Fingerprints over the years of the hashing section (``{"hashing": {"minYear", "maxYear"}}``), of which ``fileDescriptors`` is not needed.

    With ``states`` (a folder) the years' states are stored there; years it has already are not computed again."""
    c = load(conf)["hashing"]
    _known(c, ("minYear", "maxYear", "fileDescriptors"), "hashing section")
    first, last = int(c["minYear"]), int(c["maxYear"])
    frames = (base, region, RF.certain_diagnoses(diagnoses), drugs)
    wanted = range(first, last + 1)
    if states is None:
        bounded = [df.filter(F.col("bezugsjahr").between(first, last)) for df in frames]
        return FP.merged_fingerprints(FP.year_states(*bounded), first, last)
    spark = base.sparkSession
    known = {r[0] for r in spark.read.parquet(states).select("year").distinct().collect()} if V.exists(spark, states) else set()  # years are few
    if new := [y for y in wanted if y not in known]:
        FP.add_years(*frames, new, states)
    return FP.merged_fingerprints(spark.read.parquet(states), first, last)


SOURCE_KEYS = ("db", "datasetName", "yearSlice", "where", "views")
#: Sections of a configuration that other commands read.
OTHER_COMMANDS = ("statistics", "decode", "hashing", "cci")


def _known(conf: dict, keys, what: str) -> None:
    if odd := set(conf) - set(keys):
        raise ValueError(f"unknown keys of a {what}: {', '.join(sorted(odd))}")


def sources_of(conf: dict) -> list[dict]:
    """The sources of a configuration; a configuration of one source may be that source itself."""
    if "sources" in conf:
        _known(conf, ("sources", "filters", "transformers", *OTHER_COMMANDS), "configuration")
        for source in conf["sources"]:
            _known(source, SOURCE_KEYS, "source")
        return conf["sources"]
    _known(conf, (*SOURCE_KEYS, "filters", "transformers", *OTHER_COMMANDS), "configuration")
    return [conf]


def export_from_config(spark: SparkSession, conf: str | dict, frames: dict[str, DataFrame], as_of: str | None = None,
                       root: str | None = None, filters=()) -> dict[str, DataFrame]:
    """Export every configured view; returns the exported frames by view name.

    The configured filters come after those given as ``filters``, in their order."""
    conf = load(conf)
    sources = sources_of(conf)
    filters = [*filters, *(filter_of(spark, c, frames) for c in conf.get("filters", ()))]
    steps = [step_of(spark, c) for c in conf.get("transformers", ())]
    out = {}
    for source in sources:
        slice_ = slice_of(source.get("yearSlice"), as_of)
        for view in source.get("views", ()):
            base = frames[view["name"]]
            spec = spec_of(spark, view, frames, source.get("where", ()), slice_)
            sliced = slice_ is not None and slice_.column in (view.get("columns") or base.columns)
            out[view["name"]] = export(base, spec, FrameMeta(source["db"], view["name"]), filters, steps, root,
                                       source.get("datasetName", "default"), slice_.column if sliced else None)
    return out
