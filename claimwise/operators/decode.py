"""Insurance-number -> person-id decode: exclusion list, cleaning, loss ratio.

Order-dependent "first wins" cleaning is done with aggregations, not windows:
the first row of a key is ``min_by(row, order)``, which Spark computes with a
partial (map-side) aggregation.  A key that holds a third of all rows is
therefore reduced on every mapper before the shuffle, instead of landing
whole in one window partition.

Semantics of the sequential original (three "seen" sets) are reproduced by
three passes: pass 1 keeps the first row per pid; pass 2 keeps, among the
survivors, rows with an empty card plus the first row per card; pass 3 does
the same for the insurance number.  A row rejected in a later pass has still
claimed its pid (and card) in the earlier passes, which is exactly what
running the passes on the survivors of the previous pass means.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwise.functions.scalars import card_wins, empty_if_null, pad_pid_5_to_9, pad_zeros

PID_WIDTH = 10
LOSS_WARN = 0.05


@dataclass(frozen=True)
class Decoding:
    """A configured decode file: its name and the insurers whose id rows it decodes."""

    name: str
    insurers: tuple[str, ...]


def by_decoding(ids: DataFrame, decodings: list[Decoding], h2ik: str = "h2ik") -> DataFrame:
    """``ids`` with ``dataset``: a row for each decoding whose insurers hold its own (a configured number)."""
    names = F.array_compact(F.array(*[F.when(F.col(h2ik).isin(list(d.insurers)), F.lit(d.name)) for d in decodings])) if decodings else F.array().cast("array<string>")
    return ids.withColumn("dataset", F.explode(names))


def duplicate_cards(ids: DataFrame, insurers: list[str] | None = None,
                    card: str = "egk_nr", h2ik: str = "h2ik", by: tuple[str, ...] = ()) -> DataFrame:
    """Cards used by more than one id row of the given insurers (columns ``by``, ``card``)."""
    f = ids.filter(empty_if_null(card) != "")
    if insurers is not None:
        f = f.filter(F.col(h2ik).isin(insurers))
    return f.groupBy(*by, F.col(card).alias("card")).count().filter(F.col("count") > 1).select(*by, "card")


def first_ranked(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Rows with rank 1 of ``order`` within ``key`` (ties kept; NULL sorts first).

    Spark limits the window's groups on the mappers, before the exchange, so a hot key sends
    only its candidates for the first rank."""
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn("_rank", F.rank().over(w)).filter("_rank = 1").drop("_rank")


def outdated_card_holders(ids: DataFrame, membership: DataFrame, insurers: list[str] | None = None,
                          card: str = "egk_nr", h2ik: str = "h2ik", pid: str = "pid",
                          valid_to: str = "max_gueltig_bis", by: tuple[str, ...] = ()) -> DataFrame:
    """Person ids to exclude from the decode: for every card used more than once, the
    holders whose membership ends first (rank 1, ties kept), padded to 10 when the
    id has 5..9 characters (other lengths give NULL and are dropped).

    With ``by`` (columns of ``ids``) each of its values is a list of its own."""
    dup = duplicate_cards(ids, insurers, card, h2ik, by).withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = reduce(and_, [F.col(c) == F.col(f"_by_{c}") for c in by], F.col(card) == F.col("card"))
    d = ids.join(dup, same, "left_semi")
    if insurers is not None:
        d = d.filter(F.col(h2ik).isin(insurers))
    d = d.select(*by, h2ik, card, pid)
    m = membership.select(F.col(h2ik).alias("_mh"), F.col(card).alias("_mc"),
                          F.col("k_mensch_id").alias("_mp"), F.col(valid_to).alias(valid_to))
    ds = d.join(m, (F.col(h2ik) == F.col("_mh")) & (F.col(card) == F.col("_mc")) &
                (F.col(pid) == F.col("_mp")), "left").select(*by, h2ik, card, pid, valid_to)
    # equal rows are the normal case: distinct before the rank, so that ties do not carry them all
    ranked = first_ranked(ds.select(*by, card, pid, valid_to).distinct(), [*by, card], valid_to)
    return (ranked.select(*by, pad_pid_5_to_9(F.col(pid)).alias("pid"))
            .filter(F.col("pid").isNotNull()).distinct())


def _first_per(df: DataFrame, key: str, order: Column, unique: str, by: tuple[str, ...] = ()) -> DataFrame:
    """First row (by ``order``) per non-empty ``key``; rows with an empty key all pass.

    One aggregation: a row with an empty key is grouped under its own ``unique``
    value (a column that is already unique), so it forms a group of one; the
    flag in the grouping key keeps the two kinds of group values apart."""
    empty = empty_if_null(key) == ""
    group = F.when(empty, F.col(unique).cast("string")).otherwise(F.col(key).cast("string"))
    firsts = (df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by], group.alias("_g"), empty.alias("_ge"))
              .agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_r")))
    return firsts.select("_r.*")


def clean_ids(ids: DataFrame, unwanted: DataFrame | None, order_cols: list[str],
              h2ik: str = "h2ik", card: str = "egk_nr", number: str = "kv_nummer",
              pid: str = "pid", by: tuple[str, ...] = ()) -> DataFrame:
    """Decoded id mapping (h2ik, egk_nr, kv_nummer, pid): one row per pid, card and
    insurance number unique among non-empty values; the number is blanked when a card
    exists.  ``order_cols`` define which row comes first (the source has no order).

    With ``by`` each of its values is decoded by itself, in the same passes."""
    order = F.struct(*[F.col(c) for c in order_cols])
    base = (ids.filter((empty_if_null(h2ik) != "") & (empty_if_null(pid) != ""))
            .select(*by, F.col(h2ik).alias("h2ik"), empty_if_null(card).alias("egk_nr"),
                    empty_if_null(number).alias("kv_nummer"),
                    pad_zeros(F.col(pid), PID_WIDTH).alias("pid"),
                    order.alias("_order")))
    base = _without(base, unwanted, by)
    p1 = _first_per(base, "pid", F.col("_order"), "pid", by)        # pid is never empty here
    p2 = _first_per(p1, "egk_nr", F.col("_order"), "pid", by)       # pid is unique from here on
    p3 = _first_per(p2, "kv_nummer", F.col("_order"), "pid", by)
    return p3.select(*by, "h2ik", "egk_nr", card_wins("egk_nr", "kv_nummer").alias("kv_nummer"), "pid")


def _without(base: DataFrame, unwanted: DataFrame | None, by: tuple[str, ...]) -> DataFrame:
    if unwanted is None:
        return base
    return base.join(unwanted.select(*by, F.col(unwanted.columns[-1]).alias("pid")), [*by, "pid"], "left_anti").select(*base.columns)


def decode_all(ids: DataFrame, membership: DataFrame, decodings: list[Decoding], order_cols: list[str]) -> DataFrame:
    """The mappings of all decodings (dataset, h2ik, egk_nr, kv_nummer, pid) in one run of the passes, grouped by data set and key.

    An insurer may belong to several decodings; each has its own exclusion list."""
    rows = by_decoding(ids, decodings)
    return clean_ids(rows, outdated_card_holders(rows, membership, by=("dataset",)), order_cols, by=("dataset",))


def decode_input(ids: DataFrame, unwanted: DataFrame | None, h2ik: str = "h2ik",
                 pid: str = "pid") -> DataFrame:
    """Rows that reach the duplicate tests (non-empty insurer and pid, not excluded)."""
    base = (ids.filter((empty_if_null(h2ik) != "") & (empty_if_null(pid) != ""))
            .select(pad_zeros(F.col(pid), PID_WIDTH).alias("pid")))
    return _without(base, unwanted, ())


def loss_ratio(n_input: DataFrame, mapping: DataFrame) -> DataFrame:
    """One-row quality frame: rows tested, valid mappings, duplicates, loss, warn (> 5 %)."""
    marks = (n_input.select(F.lit(1).alias("_i"), F.lit(0).alias("_v"))
             .unionByName(mapping.select(F.lit(0).alias("_i"), F.lit(1).alias("_v"))))
    j = marks.agg(F.sum("_i").cast("long").alias("n_input"), F.sum("_v").cast("long").alias("n_valid"))
    dup = F.col("n_input") - F.col("n_valid")
    loss = F.when(F.col("n_valid") > 0, dup / F.col("n_valid").cast("double"))
    return j.select("n_input", "n_valid", dup.alias("n_duplicates"), loss.alias("loss"),
                    (loss > LOSS_WARN).alias("warn"))
