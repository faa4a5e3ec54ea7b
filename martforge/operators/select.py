"""Row selection operators: deterministic latest-per-key, keep-minimum, validity filters."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.columns import sap_date


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order`` (+ ``tiebreak``).

    ``order + tiebreak`` must be a total order within a group (append the row's own key
    columns), otherwise the kept row depends on the shuffle. The ``row_number() == 1``
    filter lets Catalyst insert a partial ``WindowGroupLimit`` before the exchange, so each
    map task ships at most one row per key: a hot key does not flood one reducer.
    """
    w = Window.partitionBy(*keys).orderBy(*order, *_cols(tiebreak))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_min(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Keep every row whose ``col`` equals the minimum of its ``keys`` group (ties all kept; NULL keys are a group)."""
    least = F.min(col).over(Window.partitionBy(*keys))
    return df.withColumn("__min", least).filter(F.col(col) == F.col("__min")).drop("__min")


def _stored_as_date(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.DateType)


def valid_as_of(df: DataFrame, date_col: str, as_of: Column | _dt.date | None = None) -> DataFrame:
    """Rows already valid at ``as_of`` (``valid-from <= as_of``); unparseable dates drop out.

    A comparison of the stored column goes with the normalised one, so that it reaches the scan:
    a DATE compares as it is, and a string in either form is at most ``as_of`` as ``yyyyMMdd``
    (``-`` sorts before the digits).
    """
    ref = F.current_date() if as_of is None else (F.lit(as_of) if isinstance(as_of, _dt.date) else as_of)
    if _stored_as_date(df, date_col):
        return df.filter(F.col(date_col) <= ref)
    return df.filter((F.col(date_col) <= F.date_format(ref, "yyyyMMdd")) & (sap_date(F.col(date_col)) <= ref))


OPEN_END = _dt.date(9999, 12, 31)


def active_only(df: DataFrame, valid_to_col: str = "DATBI") -> DataFrame:
    """Rows whose validity has no end (valid-to 9999-12-31 as DATE, ``yyyyMMdd`` or ``yyyy-MM-dd``), filtered in the scan."""
    if _stored_as_date(df, valid_to_col):
        return df.filter(F.col(valid_to_col) == F.lit(OPEN_END))
    return df.filter(F.col(valid_to_col).isin(f"{OPEN_END:%Y%m%d}", OPEN_END.isoformat()))
