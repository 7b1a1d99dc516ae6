"""Column expressions shared by the operators (SCL1-SCL11).

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen. Time helpers work on the instant itself, so results do
not depend on ``spark.sql.session.timeZone`` (trap T2: a reading at 02:00Z
belongs to the UTC date whatever zone the session is in).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_date(ts: str | Column) -> Column:
    """Calendar date of an instant in UTC (SCL1 / PRJ4, pinned to UTC)."""
    if isinstance(ts, str):  # one JVM call for the whole expression
        return F.expr(f"date_from_unix_date(CAST(floor(unix_micros(`{ts}`) / {MICROS_PER_DAY}D) AS INT))")
    micros = F.unix_micros(ts)
    return F.date_from_unix_date(F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int"))


def utc_hour(ts: str | Column) -> Column:
    """Hour of day (0-23) of an instant in UTC (SCL7)."""
    micros = F.unix_micros(col(ts))
    return F.floor(F.pmod(micros, F.lit(MICROS_PER_DAY)) / F.lit(MICROS_PER_HOUR)).cast("int")


def local_hour(ts: str | Column, tz: str | Column) -> Column:
    """Hour of day in an IANA zone (SCL9).

    ``tz`` is a column (name or Column) holding the zone, e.g. the region's
    ``timezone``; pass ``F.lit("America/Phoenix")`` for a fixed zone.
    """
    return utc_hour(F.from_utc_timestamp(col(ts), col(tz)))


def whole_days_between(later: str | Column, earlier: str | Column) -> Column:
    """Age in whole 24-hour days between two instants (SCL7)."""
    diff = F.unix_micros(col(later)) - F.unix_micros(col(earlier))
    return F.floor(diff / F.lit(MICROS_PER_DAY))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL on a zero divisor instead of failing (SCL10, T3)."""
    return F.try_divide(col(num), col(den))


def pct_text(c: str | Column) -> Column:
    """Whole-percent text such as ``412%``; a dash for NULL (SCL11).

    Rounds half to even, as formatting a float with ``.0f`` does.
    """
    return F.coalesce(F.concat(F.bround(col(c), 0).cast("long").cast("string"), F.lit("%")), F.lit("—"))


def reading_id(n: str | Column) -> Column:
    """Zero-padded reading id ``R-00000001`` (SCL8).

    Padding is made of string built-ins; a formatter is set up only for null and negative numbers.
    """
    number = col(n)
    digits = number.cast("string")
    padded = F.when(number < 100_000_000, F.lpad(digits, 8, "0")).otherwise(digits)
    return F.when(number >= 0, F.concat(F.lit("R-"), padded)).otherwise(F.format_string("R-%08d", number))


