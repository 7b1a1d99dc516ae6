"""Gold kept up to date day by day (CMP2 with mergeable WIN1/WIN2 state).

A site's baseline needs only three numbers that add up: n, S and Q of its daily totals in
cents (see ``plans.pipeline``). They are kept per site in a state table, beside
the daily rows:

    <path>/daily/version=V/reading_date=D/   the daily rows of the days that version V replaced
    <path>/state/version=V/                  n, S, Q of every site after version V
    <path>/commits/version=V/                the days of version V; a version without it doesn't count

``replace_days`` takes the readings of some days (new, late or corrected ones), rolls them
up, subtracts what these days had added to the state, adds what they add
now, and commits. It reads the readings of these days, their old daily rows and the
state; no other day. ``gold`` joins daily rows with the state, so the baseline of every
row covers the whole history (T10) and equals a full rebuild, bit for bit: all sums are
whole numbers. A site with a total that isn't counted in cents (NaN, infinite or from
1e12 kWh on) is marked in the state and gets its baseline from its own daily rows.

Writes that failed half-way leave no trace: the next run overwrites their version.
One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.operators import filters, joins
from sitewatts.plans import pipeline

#: Days without cents are counted by days - n.
_SUMS = {
    "days": "count(1)",
    "n": "count(total_cents)",
    "s": "coalesce(sum(total_cents), 0)",
    "q": "coalesce(sum(CAST(total_cents AS DECIMAL(38,0)) * CAST(total_cents AS DECIMAL(38,0))), 0)",
}
_STATE = "site_id string, days bigint, n bigint, s bigint, q decimal(38,0)"
_DAILY = "site_id string, peak_kw double, avg_voltage double, warning_count bigint, total_kwh double, total_cents bigint"


def state_of(daily: DataFrame) -> DataFrame:
    """Per site: days, n, s, q of its daily rows (``pipeline.daily_by_site``)."""
    sums = daily.groupBy("site_id").agg(*[F.expr(e).alias(c) for c, e in _SUMS.items()])
    return sums.withColumn("q", F.col("q").cast("decimal(38,0)"))


def merged(plus: Iterable[DataFrame], minus: Iterable[DataFrame] = ()) -> DataFrame:
    """States added up; those in ``minus`` are subtracted. Sites without a day left are dropped."""
    signed = [d.withColumn("_sign", F.lit(1)) for d in plus] + [d.withColumn("_sign", F.lit(-1)) for d in minus]
    rows = signed[0]
    for d in signed[1:]:
        rows = rows.unionByName(d)
    sums = [F.sum(F.expr(f"_sign * {c}")).alias(c) for c in ("days", "n", "s", "q")]
    total = rows.groupBy("site_id").agg(*sums).where("days > 0")
    return total.withColumn("q", F.col("q").cast("decimal(38,0)"))


def with_state_baseline(daily: DataFrame, state: DataFrame, history: DataFrame) -> DataFrame:
    """WIN1-WIN4 of ``daily`` rows from their sites' state; ``history`` has all daily rows, for marked sites only."""
    known = state.where("days = n").select("site_id", F.col("n").alias("_n"), F.col("s").alias("_s"), F.col("q").alias("_q"))
    joined = daily.join(known.withColumnRenamed("site_id", "_id"), F.expr("site_id <=> _id"), "inner").drop("_id")
    counted = joined.selectExpr("*", "CAST(NULL AS DOUBLE) AS _unit", "0D AS _odd", "total_cents AS _t")
    plain = pipeline.with_measures(counted).drop("_odd")
    marked = state.where("days > n").select(F.col("site_id").alias("_id"))
    whole = history.join(marked, F.expr("site_id <=> _id"), "left_semi")
    odd = pipeline.with_baseline(whole).join(daily.select("reading_date").distinct(), "reading_date", "left_semi")
    return plain.unionByName(odd.select(*plain.columns))


def merge_gold(parts: list[DataFrame], sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """Gold from daily rows that come in parts (distinct days): states per part, added up, joined back."""
    state = merged([state_of(p) for p in parts])
    daily = parts[0]
    for p in parts[1:]:
        daily = daily.unionByName(p)
    return _projected(with_state_baseline(daily, state, daily), sites, regions, business_units)


def _projected(rows: DataFrame, sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    dim = joins.site_dim(sites, regions, business_units).select("site_id", *schemas.GOLD_ATTRIBUTES)
    return rows.join(dim, on="site_id", how="left").select(*schemas.GOLD_COLUMNS)


# -- tables -------------------------------------------------------------------


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commits(spark: SparkSession, path: str) -> DataFrame:
    found = _table(spark, f"{path}/commits", "reading_date date, version int")
    return spark.createDataFrame([], "reading_date date, version int") if found is None else found


def version(spark: SparkSession, path: str) -> int:
    """The last committed version, 0 before the first."""
    return _commits(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def state(spark: SparkSession, path: str) -> DataFrame:
    """n, S, Q per site after the last commit."""
    last = version(spark, path)
    return spark.read.schema(_STATE).parquet(f"{path}/state/version={last}") if last else spark.createDataFrame([], _STATE)


def daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily rows that count: of each day those of its last committed version."""
    rows = _table(spark, f"{path}/daily", f"{_DAILY}, version int, reading_date date")
    if rows is None:
        return spark.createDataFrame([], f"{_DAILY}, reading_date date")
    last = _commits(spark, path).groupBy("reading_date").agg(F.max("version").alias("version"))
    return rows.join(last, ["reading_date", "version"], "left_semi").drop("version")


def replace_days(spark: SparkSession, path: str, readings: DataFrame, days: Iterable[dt.date]) -> int:
    """Make ``readings`` all that is known of ``days``; returns the committed version.

    Readings of other days are ignored, so a whole table may be passed: the dates are pushed to
    its scan. A day without readings is emptied.
    """
    days = sorted(set(days))
    if not days:
        return version(spark, path)
    path = path.rstrip("/")
    next_ = version(spark, path) + 1
    wanted = filters.reading_dates(readings, days[0], days[-1])
    new = pipeline.daily_by_site(wanted).where(F.col("reading_date").isin(days))
    new = new.select(*[c.split()[0] for c in _DAILY.split(", ")], "reading_date")
    target = f"{path}/daily/version={next_}"
    new.write.mode("overwrite").partitionBy("reading_date").parquet(target)
    # an empty folder has no partitions to find the column in
    added = spark.read.schema(f"{_DAILY}, reading_date date").parquet(target)
    replaced = daily(spark, path).where(F.col("reading_date").isin(days))
    # version next_ has no commit yet, so ``replaced`` holds the rows of the versions before
    after = merged([state(spark, path), state_of(added)], [state_of(replaced)])
    after.write.mode("overwrite").parquet(f"{path}/state/version={next_}")
    marks = spark.createDataFrame([(d,) for d in days], "reading_date date")
    marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={next_}")
    return next_


def gold(
    spark: SparkSession,
    path: str,
    sites: DataFrame,
    regions: DataFrame,
    business_units: DataFrame,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """Gold rows (of the given days only), with baselines over the whole history."""
    history = daily(spark, path)
    rows = history
    if since is not None:
        rows = rows.where(F.col("reading_date") >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col("reading_date") <= F.lit(until))
    return _projected(with_state_baseline(rows, state(spark, path), history), sites, regions, business_units)
