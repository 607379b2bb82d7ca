"""String, code and date rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATASET_PREFIX = "EPD_"
MIN_YEAR = 2014


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c) -> Column:
    """Drop every whitespace character."""
    return F.regexp_replace(_c(c), r"\s+", "")


def strip_blanks(c) -> Column:
    """Drop blanks only."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def normalise_postcode(c) -> Column:
    """One normaliser for both join sides: no whitespace, upper case."""
    return F.upper(strip_whitespace(c))


def year_part(ym) -> Column:
    """First four chars of YYYYMM as smallint (ANSI cast: bad text raises)."""
    return F.substring(_c(ym), 1, 4).cast("smallint")


def month_part(ym) -> Column:
    """Chars five and six of YYYYMM as tinyint."""
    return F.substring(_c(ym), 5, 2).cast("tinyint")


def year_text(ym) -> Column:
    """P5: year as text."""
    return F.substring(_c(ym), 1, 4)


def month_text(ym) -> Column:
    """P5: everything after char four."""
    return F.expr(f"substring({_sql(ym)}, 5)")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def dataset_name(year, month) -> Column:
    """EPD_YYYYMM."""
    return F.format_string(DATASET_PREFIX + "%04d%02d", _c(year), _c(month))


def date_suffix(name) -> Column:
    """V1: last six characters."""
    return F.right(_c(name), F.lit(6))


def name_year_text(name) -> Column:
    return F.substring(date_suffix(name), 1, 4)


def name_month_text(name) -> Column:
    return F.substring(date_suffix(name), 5, 2)


def name_date(name) -> Column:
    """V3: first day of the named month (null when not a valid yyyyMM)."""
    return F.try_to_date(date_suffix(name), "yyyyMM")


def name_rejection(name) -> Column:
    """V2: reason a dataset name is invalid, null when valid.

    Checks, in order: length 10, prefix, year >= 2014, month 1..12.
    """
    n = _c(name)
    suffix = F.right(n, F.lit(6))
    y = suffix.substr(1, 4).try_cast("int")
    m = suffix.substr(5, 2).try_cast("int")
    return (F.when(n.isNull(), F.lit("missing"))
            .when(F.length(n) != 10, F.lit("length"))
            .when(F.substring(n, 1, 4) != F.lit(DATASET_PREFIX), F.lit("prefix"))
            .when(y.isNull() | (y < MIN_YEAR), F.lit("year"))
            .when(m.isNull() | (m < 1) | (m > 12), F.lit("month")))


def title_case(c) -> Column:
    """V4: title case. Equal to Python's str.title for blank-separated words."""
    return F.initcap(_c(c))


def as_of_date(text) -> Column:
    """V7: lookup as-of date from 'AUG_2025' style text or an ISO date."""
    t = _c(text)
    return F.coalesce(F.try_to_date(F.initcap(t), "MMM_yyyy"), F.try_to_date(t, "yyyy-MM-dd"))


def is_stale(as_of, run_date, months: int = 6) -> Column:
    """V8 (intent, D3): stale once more than `months` have passed since as-of."""
    return F.add_months(_c(as_of), months) < _c(run_date)
