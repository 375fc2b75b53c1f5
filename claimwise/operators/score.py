"""Comorbidity score: LIKE-pattern join and four-quarter sliding windows.

Pattern join (``code LIKE pattern || '%'``)
    The distinct codes are joined to the patterns on the literal text before the first wildcard, with LIKE
    as the residual.  The matches are a stored table, so Spark knows its size: the facts join it on the code without
    being moved where it is small (codes are few, so parts by code would grow with the facts).  One path for any number
    of patterns.  A code may match several patterns; all matches are kept.

Sliding windows
    Window starts are every quarter of the configured years; a window covers the
    start quarter and the three following ones, clamped to Q4 of the ``as_of`` year.
    Facts are first reduced to (source, pid, quarter, class) -> max weight, then each
    reduced fact is copied into the <= 4 windows that contain it; score = sum over
    classes of the max weight in the window.  Persons without facts in a window get
    no row.  All steps are aggregations (no window functions over persons).  The facts
    are counted and dealt to parts of about ``PART_ROWS`` rows, so a task's memory does
    not grow with them: first by all they are reduced on, so that a person with a huge
    number of facts is spread over many parts and the equal ones take one place of a hash
    table; then, reduced, by person, after which windows and scores need no further shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.functions.scalars import (quarter_begin_text, quarter_end_text, quarter_index,
                                         quarter_of_index, year_of_index)
from claimwise.operators.lookup import like_matches
from claimwise.session import written

#: Facts that one task reduces, about.
PART_ROWS = 250_000


def pattern_join(facts: DataFrame, patterns: DataFrame, code: str = "icd_code",
                 pattern: str = "icd_code") -> DataFrame:
    """All (fact, pattern) pairs with ``fact.code LIKE pattern || '%'``.

    Output: fact columns + ``pattern``, ``disease_class``, ``cci_weight``.

    The patterns are matched against the distinct codes (a vocabulary) by an equi join on the
    patterns' literal heads (``lookup.like_matches``); the facts then join the result on the code."""
    pats = patterns.select(F.col(pattern).alias("pattern"), "disease_class", "cci_weight")
    like = F.concat(F.col("pattern"), F.lit("%"))
    matched = like_matches(facts.select(code), pats.select(like.alias("pattern")))
    matched = (matched.select(F.col("value").alias("_code"), F.col("pattern").alias("_like"))
               .join(pats, F.col("_like") == like).drop("_like"))
    return facts.join(written(matched, "pattern-matches"), F.col(code) == F.col("_code")).drop("_code")


def sliding_scores(facts: DataFrame, start_year: int, end_year: int, as_of: str,
                   pid: str = "pid", source: str = "source_table", year: str = "year",
                   quarter: str = "quarter", cls: str = "disease_class", weight: str = "cci_weight",
                   insurer: str = "h2ik", insurers: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Score per (source, pid, window start) — see the module doc; with ``by`` (columns of the facts) per value of those too.

    ``insurers`` is the configured insurer list of the score sources: facts of other
    insurers are dropped, and the insurer is carried as its position in the sorted
    list, so every aggregation works on integers (hash aggregation; ``min`` over text
    would force sort-based aggregation).  Without the list the text is carried."""
    now_year = _dt.date.fromisoformat(as_of).year
    first_start = start_year * 4
    last_start = end_year * 4 + 3
    cap = now_year * 4 + 3
    q = quarter_index(year, quarter)
    ins = F.col(insurer)
    if insurers is not None:
        codes = F.array(*[F.lit(v) for v in sorted(set(insurers))])
        facts = facts.filter(ins.isin(list(insurers)))
        ins = F.array_position(codes, ins).cast("int")
    facts = (facts.select(*by, F.col(source).alias("source_table"), F.col(pid).alias("pid"), q.alias("_q"),
                          F.col(cls).alias("_cls"), F.col(weight).cast("int").alias("_w"),
                          ins.alias("_ins"))
             .filter((F.col("_q") >= first_start) & (F.col("_q") <= F.least(F.lit(last_start + 3), F.lit(cap)))))
    parts = max(1, -(-facts.count() // PART_ROWS))
    person = (*by, "source_table", "pid")
    every = (*person, "_q", "_cls", "_ins")  # the insurer too: max of a number alone is aggregated by hash, min of a text by sorting
    reduced = (facts.repartition(parts, *every).groupBy(*every).agg(F.max("_w").alias("_w"))
               .repartition(parts, *person))
    lo = F.greatest(F.col("_q") - 3, F.lit(first_start))
    hi = F.least(F.col("_q"), F.lit(last_start))
    windows = (reduced.filter(lo <= hi)
               .withColumn("_start", F.explode(F.sequence(lo, hi))))
    per_class = (windows.groupBy(*person, "_start", "_cls")
                 .agg(F.max("_w").alias("_w"), F.min("_ins").alias("_ins")))
    scores = per_class.groupBy(*person, "_start").agg(
        F.sum("_w").cast("int").alias("weight"), F.min("_ins").alias("h2ik"))
    end = F.least(F.col("_start") + 3, F.lit(cap))
    if insurers is not None:
        scores = scores.withColumn("h2ik", F.element_at(codes, F.col("h2ik")))
    return scores.select(
        *by, "source_table", "pid",
        quarter_begin_text(year_of_index(F.col("_start")), quarter_of_index(F.col("_start"))).alias("window_start"),
        quarter_end_text(year_of_index(end), quarter_of_index(end)).alias("window_end"),
        "weight", "h2ik")


def window_score(facts: DataFrame, cls: str = "disease_class", weight: str = "cci_weight",
                 keys: tuple[str, ...] = ("pid",)) -> DataFrame:
    """Score of one window: max weight per class, summed over classes."""
    per = facts.groupBy(*keys, cls).agg(F.max(weight).alias("_w"))
    return per.groupBy(*keys).agg(F.sum("_w").cast("int").alias("weight"))
