"""Join helper: LIKE as equi joins.

It forces no broadcast: statistics and adaptive execution pick the strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# characters with a meaning in a LIKE pattern
HEAD = r"^[^_%\\]*"
TAIL = r"[^_%\\]*$"
# what stands between the literal texts of a pattern: wildcards and escaped characters
BETWEEN = r"\\.|[_%]"
#: Characters of the grams that index patterns without a literal end (fewer where their literals are shorter).
GRAM = 3
#: Parts into which the values of one gram, and of patterns without any literal, are dealt.
SALTS = 32


def _grams(text: str, n: str) -> str:
    """SQL: all substrings of ``n`` characters of ``text``."""
    return f"transform(sequence(1, length({text}) - {n} + 1), i -> substr({text}, i, {n}))"


def like_matches(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """All pairs (value, pattern) of two one-column frames with ``value LIKE pattern``, each once.

    LIKE itself is always the residual condition; what brings pairs together is, by pattern,

    * its literal text before the first wildcard or, if that is empty, after the last one: the distinct values are joined on
      their prefixes and suffixes of those lengths (a few integers, at most twice the longest pattern);
    * without such an end (``%x%``), its rarest inner gram: the literal runs between the wildcards have grams of up to three
      characters, counted over the distinct values; a pattern probes the index of the values' grams by the one that fewest values hold;
    * without any literal (``%``, ``_%_``), nothing: each meets all values, which it mostly matches.

    The values of a gram, and those met by patterns without literals, are dealt to ``SALTS`` parts, to which the
    patterns are copied, so no key holds all values.  Nulls match nothing."""
    p = patterns.select(F.col(patterns.columns[0]).cast("string").alias("pattern")).filter("pattern IS NOT NULL").distinct()
    head = F.regexp_extract("pattern", HEAD, 0)
    tail = F.when(F.instr("pattern", "\\") > 0, F.lit("")).otherwise(F.regexp_extract("pattern", TAIL, 0))
    inner = F.array_max(F.transform(F.split("pattern", BETWEEN, -1), F.length))
    p = p.withColumns({"head": head, "tail": tail, "inner": inner})
    p = p.selectExpr("pattern", "CASE WHEN head <> '' THEN 'head' WHEN tail <> '' THEN 'tail' WHEN inner > 0 THEN 'gram' ELSE 'any' END AS side",
                     "CASE WHEN head <> '' THEN head ELSE tail END AS anchor", f"least(inner, {GRAM}) AS n")
    kinds = p.select("side", F.when(F.col("side") == "gram", F.col("n")).otherwise(F.length("anchor")).alias("n")).distinct().collect()
    v = values.select(F.col(values.columns[0]).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    like = F.like(F.col("value"), F.col("pattern"))

    def of(side: str) -> list[int]:
        return sorted(k["n"] for k in kinds if k["side"] == side)

    anchored = [F.when(F.length("value") >= n, F.struct(F.lit(side).alias("side"), end.alias("anchor")))
                for side, at in (("head", lambda n: F.substring(F.col("value"), 1, n)), ("tail", lambda n: F.right(F.col("value"), F.lit(n))))
                for n in of(side) for end in [at(n)]]
    anchored = F.array(*anchored) if anchored else F.array().cast("array<struct<side:string,anchor:string>>")
    ends = v.select("value", F.explode(F.array_compact(anchored)).alias("end")).select("value", "end.side", "end.anchor")
    out = ends.join(p, ["side", "anchor"]).filter(like).select("value", "pattern")

    salt = F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    if of("gram"):
        sizes = ", ".join(f"IF(length(value) >= {n}, {_grams('value', str(n))}, array())" for n in of("gram"))
        index = v.select("value", salt, F.explode(F.expr(f"array_distinct(concat({sizes}))")).alias("gram"))
        runs = f"filter(split(pattern, r'{BETWEEN}', -1), x -> length(x) >= n)"
        wanted = p.filter("side = 'gram'").select("pattern", F.explode(F.expr(f"array_distinct(flatten(transform({runs}, x -> {_grams('x', 'n')})))")).alias("gram"))
        held = index.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("held"))
        # a gram that no value holds: the pattern matches nothing
        probes = (wanted.join(held, "gram", "left").groupBy("pattern")
                  .agg(F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "gram")).alias("best")).filter("best.held > 0"))
        probes = probes.select("pattern", F.col("best.gram").alias("gram"), salts)
        out = out.unionAll(index.join(probes, ["gram", "salt"]).filter(like).select("value", "pattern"))
    if of("any"):
        met = p.filter("side = 'any'").select("pattern", salts)
        out = out.unionAll(v.select("value", salt).join(met, "salt").filter(like).select("value", "pattern"))
    return out
