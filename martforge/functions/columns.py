"""Column expressions shared by the marts. All are built-in Spark expressions (codegen'd, no UDFs)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = "^[0-9]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_leading_zeros(col, keep_zero: bool = False) -> Column:
    """Drop leading zeros from an all-digit key; other values pass unchanged.

    ``'0000123' -> '123'``; ``'0000' -> ''`` (or ``'0'`` with ``keep_zero``); ``'00A1'``, ``''``
    and NULL are unchanged.
    """
    c = _c(col)
    stripped = F.regexp_replace(c, "^0+", "")
    if keep_zero:
        stripped = F.when(stripped == "", F.lit("0")).otherwise(stripped)
    return F.when(c.rlike(_DIGITS), stripped).otherwise(c)


def sap_date(col) -> Column:
    """ERP date (``yyyyMMdd`` string, ``yyyy-MM-dd`` string or DATE) -> DATE; blanks, ``00000000`` -> NULL."""
    c = _c(col).cast("string")
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"), F.try_to_date(c, "yyyy-MM-dd"))


def yyyymmdd(col) -> Column:
    """DATE -> ``yyyyMMdd`` string (the output convention of the marts)."""
    return F.date_format(_c(col), "yyyyMMdd")


def is_unset(col) -> Column:
    """ERP blank: NULL or empty string."""
    c = _c(col)
    return c.isNull() | (c == "")


def is_set(col) -> Column:
    c = _c(col)
    return c.isNotNull() & (c != "")


def not_flagged(col, flag: str = "X") -> Column:
    """True unless the indicator equals ``flag`` (NULL counts as not flagged)."""
    return F.coalesce(_c(col), F.lit("")) != flag


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero or NULL divisor instead of raising under ANSI mode."""
    d = _c(den)
    return _c(num) / F.when(d == 0, F.lit(None)).otherwise(d)


def fallback_text(key, free_text, master_text) -> Column:
    """Free text when the key is blank (non-stock item), else the master-data text."""
    return F.when(is_unset(key), _c(free_text)).otherwise(_c(master_text))


def any_nonzero(*cols) -> Column:
    return reduce(or_, [_c(c) != 0 for c in cols])


def name_matches_any(col, patterns) -> Column:
    """Case-insensitive substring match against any of ``patterns``; no pattern matches nothing."""
    up = F.upper(_c(col))
    pats = list(patterns)
    if not pats:
        return F.lit(False)
    return reduce(or_, [up.contains(p.upper()) for p in pats])


def zero_if_null(col) -> Column:
    return F.coalesce(_c(col), F.lit(0))
