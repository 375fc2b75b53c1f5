"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every rule is a Column that says whether a text fails.  On a sample the operator measures how often each
rule rejects and how long it takes, sorts the rules by rejection per cost and joins them into one CASE:
a text is judged by the next rule only if all earlier ones let it pass.  The verdict does not depend
on the order.  Only built-in functions run on the rows.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import BLANK_RUN, BLANKS, stored

SYMBOLS = "#*$%&|<>"
#: Rows of the sample that costs and rejections are measured on, and how often it is repeated for timing.
SAMPLE_ROWS = 400
SAMPLE_REPEATS = 8


@dataclass(frozen=True)
class Rule:
    """``fails``: a Boolean Column over the working columns ``text``, ``words`` and the base counts."""

    name: str
    fails: Column


#: Scripts written without blanks between words.
UNSPACED = "".join(rf"\p{{Is{x}}}" for x in "Han Hiragana Katakana Thai Lao Khmer Myanmar Tibetan".split())


def _letters(*kinds: str) -> Column:
    return F.char_length(F.regexp_replace(F.col("text"), "[^" + "".join(rf"\p{{{k}}}" for k in kinds) + "]+", ""))


def default_rules() -> list[Rule]:
    """Limits in percent; each is far from what running text shows."""
    chars, words = F.col("word_chars"), F.col("n_words")
    signs = F.char_length("text") - F.char_length(F.translate("text", "!?", ""))
    # words of scripts without case, and numbers, equal their upper and their lower form
    average = F.aggregate(F.transform("words", lambda w: ((w == F.upper(w)) & (w != F.lower(w))).cast("int")), F.lit(0), lambda a, x: a + x)
    unspaced = F.char_length(F.regexp_replace(F.col("text"), f"[^{UNSPACED}]+", ""))
    long = (chars > 25 * words) & (chars - unspaced > 25 * words) & (2 * unspaced < chars)  # counted only if the first holds
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 5 * chars),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 50 * F.size(F.split("text", "\n"))),
        Rule("word_length", long | (chars < 2 * words)),
        Rule("exclamations", 100 * signs > 8 * chars),
        Rule("capitals", 100 * _letters("Lu") > 50 * _letters("L")),
        Rule("capital_words", 100 * average > 60 * words),
        Rule("letters", 100 * _letters("L", "M") < 50 * chars),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 40 * words),
    ]


def measured(docs: DataFrame, text_col: str) -> DataFrame:
    """The input with the working columns ``text``, ``words`` and the base counts in ``q``.

    ``n_repeat_words`` counts the words that stand in a three-word window found twice or more: the windows'
    hashes are sorted with their positions, equal neighbours give the positions, their windows the words."""
    trimmed = F.btrim(F.col("text"), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    df = df.withColumn("words", words)
    df = df.withColumn("hashes", F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(F.expr(
        "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))")))
    # most short texts repeat no window: they need no sort
    df = df.withColumn("windows", F.when(
        F.size(F.array_distinct("hashes")) == F.size("hashes"), F.array().cast("array<struct<h:bigint,p:int>>")
    ).otherwise(F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    df = df.withColumn("found", F.expr(
        "transform(filter(windows, (x, i) -> (i > 0 and windows[i - 1].h = x.h)"
        " or (i + 1 < size(windows) and windows[i + 1].h = x.h)), x -> array(x.p, x.p + 1, x.p + 2))"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("lines", lines)
    return df.select(
        "row", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten("found"))).cast("long").alias("n_repeat_words"),
    )


def ordered(docs: DataFrame, text_col: str, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """Rules with their rejection rate and seconds on a sample, best rejection per cost first.

    The sample only decides the order, never a verdict; it is bounded by ``SAMPLE_ROWS``."""
    texts = docs.select(F.col(f"`{text_col}`").alias("sample_text")).filter(F.col("sample_text").isNotNull())
    rows = stored(texts.sample(0.05, 1).limit(SAMPLE_ROWS), "rule-texts")  # texts of any length: they stay where they are
    if rows.count() < 50:
        rows = stored(texts.limit(SAMPLE_ROWS), "rule-texts")
    if rows.isEmpty():
        return [(r, 0.0, 0.0) for r in rules]
    base = measured(rows, "sample_text").drop("row")
    base = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_REPEATS)))).drop("copy")
    sample = stored(base.repartition(2), "rule-sample")

    def seconds(fails: Column) -> tuple[float, float]:
        took, share = [], 0.0
        for _ in range(3):
            began = time.perf_counter()
            share = sample.agg(F.avg(F.coalesce(fails, F.lit(False)).cast("double"))).first()[0]
            took.append(time.perf_counter() - began)
        return statistics.median(took), share

    idle, _ = seconds(F.char_length("text") < 0)
    found = []
    for rule in rules:
        took, share = seconds(rule.fails)
        found.append((rule, share, max(took - idle, 1e-4)))
    return sorted(found, key=lambda x: -x[1] / x[2])


def judge(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with one added struct column ``quality``.

    Its fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (long),
    ``base_failed`` (under 50 words, or over half of them in repeated windows), ``kept`` (neither base nor any
    rule fails).  A null text counts as empty: it has no words, fails the base and is not kept; so does a
    blank one.  Whole texts are read.  Rows are judged one by one, so repeated rows and ties need no rule; an empty table
    gives an empty result.  Input columns stay as they are (one called ``quality`` is replaced).
    """
    rules = default_rules() if rules is None else rules
    cascade = F.lit(True)
    for rule, _, _ in reversed(ordered(docs, text_col, rules)):
        cascade = F.when(F.coalesce(rule.fails, F.lit(False)), F.lit(False)).otherwise(cascade)
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    base = (words < 50) | (100 * repeats > 50 * words)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    df = measured(docs, text_col).withColumn("base_failed", base)
    df = df.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade))
    # the generator keeps filters on the verdict above it: pushed down, they would repeat the whole measurement in every term
    verdict = F.explode(F.array(F.struct(*counts, "base_failed", "kept")))
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "quality"], verdict.alias("quality"))
