"""Local hours without joining readings (SCL9): zones as pieces of constant offset.

The instants at which any of the zones in use changes its offset cut time into
segments. Within a segment every zone has one offset, so readings can be summed by
(site, segment, UTC quarter of the day) first, and the local hour follows from the
site's zone afterwards: offsets have been multiples of 15 minutes everywhere since
1973. Readings outside ``FIRST`` to ``LAST`` are their own segment, with their exact time
of day, so old local mean times come out right as well.

The instants are found in a plan of its own (days on which a zone's offset differs from the next
day's, then the hour, then the minute) and enter the main plan as one scalar subquery:
a list of bins of 28 days, each with the last change before it and the changes in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY, HOUR, MINUTE = 86_400_000_000, 3_600_000_000, 60_000_000
QUARTER = 15 * MINUTE
FIRST, LAST = (int(dt.datetime(y, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 for y in (1973, 2100))
_BIN = 28 * DAY
_BINS = -(-(LAST - FIRST) // _BIN)


def offset_sql(us: str, zone: str) -> str:
    """Microseconds that a zone is ahead of UTC at an instant given in microseconds."""
    return f"(unix_micros(from_utc_timestamp(timestamp_micros({us}), {zone})) - ({us}))"


def changes(zones: DataFrame) -> DataFrame:
    """Distinct instants (``us``) from FIRST to LAST at which a zone in ``zones`` (timezone) changes its offset.

    Changes are taken to come at whole UTC minutes, at most one in a UTC day of one zone.
    """
    days = zones.where("timezone IS NOT NULL").select("timezone").distinct().selectExpr(
        "timezone", f"explode(sequence(0, {(LAST - FIRST) // DAY - 1})) AS day"
    ).selectExpr("timezone", f"{FIRST} + day * {DAY}L AS at")
    off = lambda us: offset_sql(us, "timezone")
    changed = days.selectExpr("*", f"{off('at')} AS before").where(f"before <> {off(f'at + {DAY}')}")
    hour = changed.selectExpr("*", f"filter(sequence(1, 24), h -> {off(f'at + h * {HOUR}L')} <> before)[0] - 1 AS hour")
    hour = hour.selectExpr("timezone", "before", f"at + hour * {HOUR}L AS at")
    minute = hour.selectExpr("at", f"filter(sequence(1, 60), m -> {off(f'at + m * {MINUTE}L')} <> before)[0] AS minute")
    return minute.selectExpr(f"at + minute * {MINUTE}L AS us").distinct()


def _bins(zones: DataFrame) -> Column:
    """The bins as a scalar subquery: array of (since, changes)."""
    start = f"({FIRST} + k * {_BIN}L)"
    one = changes(zones).agg(F.sort_array(F.collect_list("us")).alias("all"))
    bins = (
        f"transform(sequence(0, {_BINS - 1}), k -> struct("
        f"coalesce(array_max(filter(all, x -> x <= {start})), {FIRST}) AS since, "
        f"filter(all, x -> x > {start} AND x < {start} + {_BIN}) AS changes))"
    )
    return one.select(F.expr(bins).alias("bins")).scalar()


def with_segment(readings: DataFrame, zones: DataFrame) -> DataFrame:
    """Add ``_segment`` (where the reading's segment begins) and ``_time`` (of day), both in microseconds."""
    rows = readings.withColumn("_us", F.expr("unix_micros(reading_timestamp)")).withColumn("_bins", _bins(zones))
    rows = rows.selectExpr("*", f"get(_bins, CAST(floor((_us - {FIRST}) / {_BIN}D) AS INT)) AS _bin")
    inside = f"_us >= {FIRST} AND _us < {LAST}"
    segment = "CASE WHEN size(_bin.changes) = 0 THEN _bin.since ELSE coalesce(array_max(filter(_bin.changes, x -> x <= _us)), _bin.since) END"
    time = f"pmod(_us, {DAY})"
    return rows.selectExpr(
        "*",
        f"CASE WHEN {inside} THEN {segment} ELSE _us END AS _segment",
        f"CASE WHEN {inside} THEN {time} - {time} % {QUARTER} ELSE {time} END AS _time",
    ).drop("_us", "_bins", "_bin")


def hour_sql(zone: str | None = None) -> str:
    """Hour of day of rows that have ``_segment`` and ``_time``, in UTC or a zone (column or SQL)."""
    time = "_time" if zone is None else f"pmod(_time + {offset_sql('_segment', zone)}, {DAY})"
    return f"CAST(floor({time} / {HOUR}D) AS INT)"
