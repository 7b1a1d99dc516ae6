"""Row filters (FLT1-FLT8).

Each is a narrow transformation with a built-in predicate, so Catalyst pushes
it to the Parquet scan where the column comes from the table, and below
windows where the predicate is on the partition key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = str | dt.date


def _date(value: DateLike) -> Column:
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def not_error() -> Column:
    return F.col("status") != "error"


def drop_errors(df: DataFrame) -> DataFrame:
    """Keep ``status != 'error'``; a NULL status is dropped too (FLT1, T1)."""
    return df.filter(not_error())


def anomalies(df: DataFrame) -> DataFrame:
    """Rows whose ``anomaly_flag`` is true (FLT2)."""
    return df.filter(F.col("anomaly_flag"))


def since(df: DataFrame, as_of: DateLike, days: int, column: str = "reading_date") -> DataFrame:
    """``column >= as_of - days``, no upper bound (FLT3; T6)."""
    return df.filter(F.col(column) >= F.date_sub(_date(as_of), days))


def between_dates(df: DataFrame, start: DateLike, end: DateLike, column: str = "reading_date") -> DataFrame:
    """Inclusive ``start <= column <= end`` (FLT4)."""
    return df.filter(F.col(column).between(_date(start), _date(end)))


def default_range(as_of: DateLike, days: int = 14) -> tuple[dt.date, dt.date]:
    """The viewer's default [as_of - 14, as_of]: 15 dates (T6)."""
    end = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    return end - dt.timedelta(days=days), end


def of_types(df: DataFrame, types: Iterable[str] | None, column: str = "site_type") -> DataFrame:
    """``site_type IN (...)``; an empty or missing list means no filter (FLT5)."""
    values = list(types or [])
    return df.filter(F.col(column).isin(values)) if values else df


def triage_window(as_of: DateLike, kind: str | None = None, days: int | None = None) -> tuple[dt.date, dt.date]:
    """Named day windows of the triage workflow (FLT6, D10).

    ``"yesterday"`` is the single date as_of - 1; ``"last_days"`` with ``days``
    = n covers [as_of - n, as_of]; nothing given means the last 7 days.
    """
    end = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    if kind == "yesterday":
        day = end - dt.timedelta(days=1)
        return day, day
    n = days if days is not None else 7
    return end - dt.timedelta(days=n), end


def in_window(df: DataFrame, window: tuple[dt.date, dt.date], column: str = "reading_date") -> DataFrame:
    return between_dates(df, window[0], window[1], column)


def reading_dates(readings: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Raw readings of the UTC dates from ``start`` on (to ``end``, included).

    The range is put on the bare timestamp, so the Parquet reader sees it, and on
    the partition column of a table written by date.
    """
    day = 86_400_000_000
    epoch = dt.date(1970, 1, 1)
    out = readings.filter(F.col("reading_timestamp") >= F.timestamp_micros(F.lit((start - epoch).days * day)))
    if end is not None:
        out = out.filter(F.col("reading_timestamp") < F.timestamp_micros(F.lit(((end - epoch).days + 1) * day)))
    if "reading_date" in readings.columns:
        out = out.filter(F.col("reading_date") >= F.lit(start))
        out = out.filter(F.col("reading_date") <= F.lit(end)) if end is not None else out
    return out


def in_month(df: DataFrame, month: DateLike, column: str = "reading_date") -> DataFrame:
    """Rows of one calendar month: ``>= first AND < first + 1 month`` (FLT7)."""
    first = month if isinstance(month, dt.date) else dt.date.fromisoformat(
        month if len(month) > 7 else f"{month}-01"
    )
    first = first.replace(day=1)
    start = F.lit(first)
    return df.filter((F.col(column) >= start) & (F.col(column) < F.add_months(start, 1)))


def for_site(df: DataFrame, site_id: str, column: str = "site_id") -> DataFrame:
    """One site's rows (FLT8)."""
    return df.filter(F.col(column) == F.lit(site_id))
