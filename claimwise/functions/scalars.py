"""Scalar helpers (Column -> Column).

All helpers are compositions of built-in ``pyspark.sql.functions``; none of
them is a Python UDF, so they stay inside whole-stage code generation.

Export-layer convention: values are strings and "missing" is the empty
string ``""``.  Analytics convert to typed columns (dates, ints) with the
``try_*`` family so malformed values become NULL instead of failing a job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "java_trim", "clean_value", "pad_zeros", "pad_pid_10", "pad_pid_5_to_9",
    "strict_int", "quarter_index", "quarter_of_index", "year_of_index",
    "quarter_first_day", "quarter_last_day", "quarter_begin_text", "quarter_end_text",
    "main_region", "pharmacy_type", "coarse_quarter_date", "daily_doses",
    "computed_amount", "clean_package_name", "is_classified", "sha256_hex",
    "iso_date", "out_of_tolerance", "year_list", "card_wins", "full_match",
    "is_contract", "empty_if_null", "concat_key",
]

# Fixed values that define results (must stay exactly as below).
# Sub-region (first two digits of a practice number) -> main region.
MAIN_REGION_GROUPS = [
    ("01", [1]),
    ("02", [2]),
    ("03", [3]),
    ("17", list(range(6, 18))),
    ("20", [18, 19, 20]),
    ("38", [21, 24, 25, 27, 28, 31, 37, 38]),
    ("46", list(range(39, 47))),
    ("51", list(range(47, 52))),
    ("52", list(range(52, 63))),
    ("71", list(range(63, 72))),
    ("72", [72]),
    ("73", [73]),
    ("78", [78]),
    ("83", [79, 80, 81, 83]),
    ("88", [85, 86, 87, 88]),
    ("93", [89, 90, 91, 93]),
    ("98", [94, 95, 96, 98]),
]
# Pharmacy institution code prefixes.
PHARMACY_HOSPITAL = "26"
PHARMACY_PUBLIC = "30"
PHARMACY_OTHER = "00"
# Tolerance band of the year-on-year ratio.
RATIO_HIGH = 1.5
RATIO_LOW = 0.5
# Characters a Java String.trim() removes: U+0000 .. U+0020.
_JAVA_WS = "".join(map(chr, range(0x21)))


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_if_null(c) -> Column:
    """NULL -> "" (export-layer missing value)."""
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def java_trim(c) -> Column:
    """Strip all characters <= U+0020 from both ends (Spark ``trim`` strips blanks only)."""
    return F.btrim(as_col(c), F.lit(_JAVA_WS))


def clean_value(c) -> Column:
    """Export cleaning of one value: NULL -> "", ';' -> '_', '"' removed, Java trim."""
    return java_trim(F.translate(empty_if_null(c), ';"', "_"))


def pad_zeros(c, n: int) -> Column:
    """Left-pad with '0' to ``n`` characters, never truncating longer values."""
    c = as_col(c).cast("string")
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def pad_pid_10(c) -> Column:
    """Employee-list key: lengths 1..10 padded to 10 characters, anything else NULL."""
    c = as_col(c).cast("string")
    return F.when(F.length(c).between(1, 10), F.lpad(c, 10, "0"))


def pad_pid_5_to_9(c) -> Column:
    """Decode-exclusion key: lengths 5..9 padded to 10, anything else NULL."""
    c = as_col(c).cast("string")
    return F.when(F.length(c).between(5, 9), F.lpad(c, 10, "0"))


def strict_int(c) -> Column:
    """Integer parse that accepts what ``Integer.parseInt`` accepts: optional sign,
    digits only, no blanks, within int range.  Anything else is NULL."""
    c = as_col(c).cast("string")
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def quarter_index(year, quarter) -> Column:
    """Calendar quarter as one integer: year * 4 + quarter - 1 (distance = difference)."""
    return as_col(year).cast("int") * 4 + as_col(quarter).cast("int") - 1


def year_of_index(idx) -> Column:
    return F.floor(as_col(idx) / 4).cast("int")


def quarter_of_index(idx) -> Column:
    return (F.pmod(as_col(idx), F.lit(4)) + 1).cast("int")


def quarter_first_day(year, quarter) -> Column:
    return F.make_date(as_col(year).cast("int"), as_col(quarter).cast("int") * 3 - 2, F.lit(1))


def quarter_last_day(year, quarter) -> Column:
    return F.last_day(F.make_date(as_col(year).cast("int"), as_col(quarter).cast("int") * 3, F.lit(1)))


def quarter_begin_text(year, quarter) -> Column:
    """yyyyMMdd of the first day of the quarter; unknown quarter text -> Q1."""
    q = as_col(quarter).cast("string")
    mmdd = (F.when(q == "2", "0401").when(q == "3", "0701").when(q == "4", "1001")
            .otherwise("0101"))
    return F.concat(as_col(year).cast("string"), mmdd)


def quarter_end_text(year, quarter) -> Column:
    """yyyyMMdd of the last day of the quarter; unknown quarter text -> Q1."""
    q = as_col(quarter).cast("string")
    mmdd = (F.when(q == "2", "0630").when(q == "3", "0930").when(q == "4", "1231")
            .otherwise("0331"))
    return F.concat(as_col(year).cast("string"), mmdd)


def main_region(practice_no) -> Column:
    """First two digits of a practice number -> main region code, otherwise ""."""
    s = empty_if_null(practice_no)
    two = F.substring(s, 1, 2)
    sub = F.when(two.rlike(r"^[+-]?[0-9]+$"), two.cast("int"))
    mapped = reduce(
        lambda acc, grp: acc.when(sub.isin(grp[1]), F.lit(grp[0])),
        MAIN_REGION_GROUPS[1:],
        F.when(sub.isin(MAIN_REGION_GROUPS[0][1]), F.lit(MAIN_REGION_GROUPS[0][0])),
    ).otherwise(F.lit(""))
    return F.when(F.length(s) < 2, F.lit("")).otherwise(mapped)


def pharmacy_type(institution_code) -> Column:
    """26.. -> hospital pharmacy, 30.. -> public pharmacy, other -> 00, empty/NULL -> ""."""
    s = empty_if_null(institution_code)
    two = F.substring(s, 1, 2)
    return (F.when(s == "", F.lit(""))
            .when(two == PHARMACY_HOSPITAL, F.lit(PHARMACY_HOSPITAL))
            .when(two == PHARMACY_PUBLIC, F.lit(PHARMACY_PUBLIC))
            .otherwise(F.lit(PHARMACY_OTHER)))


def coarse_quarter_date(d) -> Column:
    """Date coarsened to the first day of its quarter, as text yyyy-0q-01."""
    d = as_col(d)
    return F.concat(F.year(d).cast("string"), F.lit("-0"), F.quarter(d).cast("string"), F.lit("-01"))


def daily_doses(ddd_text, packages) -> Column:
    """int(ddd) / 1000 * packages (double); NULL when ddd is empty."""
    return F.when(empty_if_null(ddd_text) != "",
                  strict_int(ddd_text) / F.lit(1000.0) * as_col(packages).cast("double"))


def computed_amount(pack_size_text, packages) -> Column:
    """int(pack size) / 10 * packages (double); NULL when pack size is empty."""
    return F.when(empty_if_null(pack_size_text) != "",
                  strict_int(pack_size_text) / F.lit(10.0) * as_col(packages).cast("double"))


def clean_package_name(name) -> Column:
    """Text before the first '*NV*', Java-trimmed."""
    return java_trim(F.split(empty_if_null(name), r"\*NV\*").getItem(0))


def is_classified(name) -> Column:
    """"0" when the name contains 'NV' anywhere, else "1"; NULL name -> ""."""
    return F.when(as_col(name).isNull(), F.lit("")).when(
        as_col(name).contains("NV"), F.lit("0")).otherwise(F.lit("1"))


def sha256_hex(c) -> Column:
    return F.sha2(as_col(c).cast("string"), 256)


def iso_date(c) -> Column:
    """yyyy-MM-dd text -> DATE, anything else NULL."""
    c = as_col(c).cast("string")
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def out_of_tolerance(ratio) -> Column:
    r = as_col(ratio)
    return (r > RATIO_HIGH) | (r < RATIO_LOW)


def year_list(start, end) -> Column:
    return F.sequence(as_col(start).cast("int"), as_col(end).cast("int"))


def card_wins(card, insurance_no) -> Column:
    """Insurance number is blanked when a card number exists."""
    return F.when(empty_if_null(card) == "", empty_if_null(insurance_no)).otherwise(F.lit(""))


def full_match(c, pattern: str) -> Column:
    """Regex must match the whole value (Java ``Matcher.matches``)."""
    return as_col(c).rlike(r"\A(?:" + pattern + r")\z")


def is_contract(c, contract: str = "KV") -> Column:
    """Case-insensitive contract comparison, ignoring outer blanks."""
    return F.upper(F.trim(as_col(c))) == contract.upper()


def concat_key(*cols) -> Column:
    """Plain text concatenation of several columns (the warehouse's ``a || b``)."""
    return F.concat(*[as_col(c).cast("string") for c in cols])
