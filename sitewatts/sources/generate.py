"""Seeded dimensions (SRC3) and a distributed reading generator (SRC4).

The generator is itself a Spark plan: each site row explodes into its
quarter-hour steps, and every random draw is a uniform taken from
``xxhash64(seed, site_id, step, draw)``. No driver loop, no ``rand()``: the
output is identical for any partition count and scales with executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.functions.columns import reading_id

# ---------------------------------------------------------------------------
# The lab's seeded dimension rows (regions, business units and
# sites), kept exactly as published so that seeded tables equal the lab's.
# ---------------------------------------------------------------------------
REGION_ROWS = [
    ("R-NE", "Northeast", "America/New_York"),
    ("R-SE", "Southeast", "America/New_York"),
    ("R-MW", "Midwest", "America/Chicago"),
    ("R-W", "West", "America/Los_Angeles"),
    ("R-SW", "Southwest", "America/Phoenix"),
]

BUSINESS_UNIT_ROWS = [
    ("BU-MFG", "Manufacturing", "Production facilities — factories and assembly plants."),
    ("BU-LOG", "Logistics & Distribution", "Warehouses and distribution centers."),
    ("BU-COR", "Corporate & Office", "Corporate headquarters and office buildings."),
    ("BU-RND", "R&D / Data Centers", "Research labs, engineering campuses, and on-prem data centers."),
    ("BU-RTL", "Retail Operations", "Customer-facing retail flagship locations."),
]

# site_id, site_name, site_type, business_unit_id, region_id, city, state,
# square_footage, voltage_nominal
SITE_ROWS = [
    ("SITE-0001", "Boston Manufacturing Plant", "factory", "BU-MFG", "R-NE", "Boston", "MA", 220000, 480),
    ("SITE-0002", "Atlanta Distribution Center", "warehouse", "BU-LOG", "R-SE", "Atlanta", "GA", 180000, 480),
    ("SITE-0003", "Chicago Headquarters", "office", "BU-COR", "R-MW", "Chicago", "IL", 90000, 480),
    ("SITE-0004", "Seattle R&D Campus", "data_center", "BU-RND", "R-W", "Seattle", "WA", 110000, 480),
    ("SITE-0005", "Phoenix Solar Operations Hub", "factory", "BU-MFG", "R-SW", "Phoenix", "AZ", 250000, 480),
    ("SITE-0006", "Dallas Distribution Center", "warehouse", "BU-LOG", "R-SW", "Dallas", "TX", 160000, 480),
    ("SITE-0007", "Portland Retail Flagship", "retail", "BU-RTL", "R-W", "Portland", "OR", 18000, 480),
    ("SITE-0008", "Charlotte Office Complex", "office", "BU-COR", "R-SE", "Charlotte", "NC", 60000, 480),
    ("SITE-0009", "Indianapolis Assembly Plant", "factory", "BU-MFG", "R-MW", "Indianapolis", "IN", 300000, 480),
    ("SITE-0010", "New Jersey Data Center", "data_center", "BU-RND", "R-NE", "Newark", "NJ", 80000, 480),
]

# Base kWh range per 15 minutes by site type.
BASE_KWH = {
    "office": (8, 25),
    "retail": (6, 18),
    "warehouse": (12, 40),
    "factory": (25, 80),
    "data_center": (40, 120),
}
# Hour-of-day load factor (UTC): business hours, night, other.
BUSINESS_HOURS = (9, 18)
NIGHT_START, NIGHT_END = 22, 6
BUSINESS_FACTOR, NIGHT_FACTOR, OTHER_FACTOR = 1.5, 0.5, 1.0
# Spike multiplier range, demand factor range, voltage band,
# temperature (22 + U(-7, 12)), status thresholds (error < 1%, warning < 5%).
SPIKE_RANGE = (3.0, 6.0)
DEMAND_RANGE = (3.0, 5.0)
VOLTAGE_BAND = (0.98, 1.02)
TEMP_BASE, TEMP_RANGE = 22.0, (-7.0, 12.0)
ERROR_BELOW, WARNING_BELOW = 0.01, 0.05
# The lab marks its 5th and 10th site as the anomalous ones.
LAB_ANOMALOUS_SITES = ("SITE-0005", "SITE-0010")

STEPS_PER_DAY = 96


def seed_dimensions(spark: SparkSession, as_of: dt.date, seed: int = 43) -> dict[str, DataFrame]:
    """The lab's three literal dimensions (SRC3).

    ``installation_date`` = as_of - d with d in [180, 1800] drawn from
    hash(seed, site_id), so it is reproducible for a given as_of.
    """
    regions = spark.createDataFrame(REGION_ROWS, schemas.REGIONS)
    bus = spark.createDataFrame(BUSINESS_UNIT_ROWS, schemas.BUSINESS_UNITS)
    rows = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], None, r[8]) for r in SITE_ROWS]
    sites = spark.createDataFrame(rows, schemas.SITES)
    days = F.lit(180) + F.pmod(F.xxhash64(F.lit(seed), F.col("site_id")), F.lit(1621)).cast("int")
    sites = sites.withColumn("installation_date", F.date_sub(F.lit(as_of), days)).select(*schemas.SITES.fieldNames())
    return {"regions": regions, "business_units": bus, "sites": sites}


def uniform(seed: int, *parts: Column) -> Column:
    """U[0, 1) from a 64-bit hash of (seed, parts...)."""
    h = F.xxhash64(F.lit(seed), *parts)
    return F.pmod(h, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _round(c: Column, dp: int) -> Column:
    """Half-up rounding to ``dp`` decimals in double arithmetic (stays in codegen)."""
    scale = float(10**dp)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def _between(u: Column, lo: float | Column, hi: float | Column) -> Column:
    """Map U[0, 1) onto [lo, hi)."""
    lo = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi = hi if isinstance(hi, Column) else F.lit(float(hi))
    return lo + u * (hi - lo)


def spike_window(seed: int, anomalous: list[str] | None, fraction: int = 5) -> tuple[Column, Column]:
    """(spike_start, spike_end) in days before end_ts; NULL for normal sites.

    ``anomalous`` lists site ids; when None, a site is anomalous when
    hash(seed, site_id) mod ``fraction`` == 0 (about 1 in 5, as in the lab).
    Start is 2-14 days ago, duration 1-3 days.
    """
    sid = F.col("site_id")
    chosen = sid.isin(list(anomalous)) if anomalous is not None else (
        F.pmod(F.xxhash64(F.lit(seed), F.lit("spike"), sid), F.lit(fraction)) == 0
    )
    start = F.lit(2) + F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), sid), F.lit(13))
    duration = F.lit(1) + F.pmod(F.xxhash64(F.lit(seed), F.lit("duration"), sid), F.lit(3))
    return F.when(chosen, start), F.when(chosen, start - duration)


#: Keys that cut a table into ranges for ``with_rank``.
RANK_CUTS = 255


def with_rank(df: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out``: each row's place (from 0) in the order of ``key``, without bringing all rows to one task.

    The ``RANK_CUTS`` keys of the smallest hashes, a random sample that is the same whenever it is drawn, cut the
    keys into ranges. Rows are numbered within their range, and the number of rows in the ranges before
    is added. Both the cuts and these numbers (at most 256) enter the plan as scalar subqueries.
    Rows of one key are numbered in any order; null keys come first.
    """
    sample = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(RANK_CUTS)
    cuts = sample.agg(F.sort_array(F.collect_list(key)).alias("cuts")).scalar()
    ranged = df.withColumn("_cuts", cuts).withColumn("_range", F.expr(f"size(filter(_cuts, c -> c <= `{key}`))")).drop("_cuts")
    ranged = ranged.withColumn("_range", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.col("_range")))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.agg(F.collect_list(F.struct("_range", "n")).alias("sizes")).scalar()
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)).cast("long") - 1
    numbered = ranged.withColumns({"_place": place, "_sizes": before})
    offset = "aggregate(_sizes, 0L, (n, s) -> n + IF(s._range < _range, s.n, 0L))"
    return numbered.withColumn(out, F.expr(f"_place + {offset}")).drop("_place", "_sizes", "_range")


def base_range(site_type: Column) -> tuple[Column, Column]:
    """(least, largest) base kWh of a site type per 15 minutes; NULL for other types."""
    lo = F.coalesce(*[F.when(site_type == t, F.lit(float(a))) for t, (a, _b) in BASE_KWH.items()])
    hi = F.coalesce(*[F.when(site_type == t, F.lit(float(b))) for t, (_a, b) in BASE_KWH.items()])
    return lo, hi


def generate_readings(
    spark: SparkSession,
    sites: DataFrame,
    end_ts: dt.datetime,
    days: int = 30,
    seed: int = 44,
    anomalous: list[str] | None = None,
    partitions: int | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Synthetic 15-minute readings for every site (SRC4).

    ``days * 96`` steps per site ending at ``end_ts`` (UTC, inclusive), so a
    window ending at hour H touches days + 1 dates (T8). Formula: kWh =
    U(lo, hi) by type x hour factor x spike, 3 dp; kW = kWh x U(3, 5), 3 dp;
    voltage = nominal x U(0.98, 1.02), 2 dp; temperature 22 + U(-7, 12), 2 dp;
    status error / warning / normal by one roll. ``reading_id`` is
    ``R-%08d`` (``columns.reading_id``) of site_seq * steps + step + 1, site_seq being the site's place
    (from 0) in the order of site ids, so ids are distinct and gapless whatever the
    site ids look like. Sites are spread over ``partitions`` tasks (default: the
    session's shuffle partitions). Columns of ``sites`` named in ``carry`` follow the
    reading's own. Building the DataFrame starts no job.
    """
    n_steps = days * STEPS_PER_DAY
    if end_ts.tzinfo is None:
        end_ts = end_ts.replace(tzinfo=dt.timezone.utc)
    end_us = int(end_ts.timestamp()) * 1_000_000
    lo, hi = base_range(F.col("site_type"))
    spike_start, spike_end = spike_window(seed, anomalous)
    base = with_rank(sites, "site_id", "site_seq").select(
        "site_id",
        "site_type",
        "voltage_nominal",
        "site_seq",
        F.struct(F.lit(0).alias("_"), *carry).alias("carry"),
        lo.alias("lo"),
        hi.alias("hi"),
        spike_start.alias("spike_start"),
        spike_end.alias("spike_end"),
    )
    # a number given here isn't coalesced by AQE, which would see only the few bytes of the sites
    base = base.repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), "site_id")
    steps = base.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n_steps - 1))))
    # step 0 is the oldest interval; the last step is end_ts itself.
    ts_us = F.lit(end_us) - (F.lit(n_steps - 1) - F.col("step")).cast("long") * F.lit(15 * 60 * 1_000_000)
    sid, step = F.col("site_id"), F.col("step")
    u = {k: uniform(seed, sid, step, F.lit(k)) for k in ("base", "spike", "demand", "volt", "temp", "status")}
    hour = F.floor(F.pmod(ts_us, F.lit(86_400_000_000)) / F.lit(3_600_000_000))
    factor = (
        F.when((hour >= BUSINESS_HOURS[0]) & (hour < BUSINESS_HOURS[1]), F.lit(BUSINESS_FACTOR))
        .when((hour >= NIGHT_START) | (hour < NIGHT_END), F.lit(NIGHT_FACTOR))
        .otherwise(F.lit(OTHER_FACTOR))
    )
    days_ago = F.floor((F.lit(end_us) - ts_us) / F.lit(86_400_000_000))
    in_spike = F.coalesce((days_ago >= F.col("spike_end")) & (days_ago <= F.col("spike_start")), F.lit(False))
    spike = F.when(in_spike, _between(u["spike"], *SPIKE_RANGE)).otherwise(F.lit(1.0))
    kwh = _round(_between(u["base"], F.col("lo"), F.col("hi")) * factor * spike, 3)
    out = steps.select(
        reading_id(F.col("site_seq") * n_steps + step + 1).alias("reading_id"),
        sid.alias("site_id"),
        F.timestamp_micros(ts_us).alias("reading_timestamp"),
        kwh.alias("kwh_consumed"),
        u["demand"].alias("_ud"),
        F.col("voltage_nominal"),
        u["volt"].alias("_uv"),
        u["temp"].alias("_ut"),
        u["status"].alias("_us"),
        "carry",
    )
    return out.select(
        "reading_id",
        "site_id",
        "reading_timestamp",
        "kwh_consumed",
        _round(F.col("kwh_consumed") * _between(F.col("_ud"), *DEMAND_RANGE), 3).alias("kw_demand"),
        _round(F.col("voltage_nominal") * _between(F.col("_uv"), *VOLTAGE_BAND), 2).alias("voltage"),
        _round(F.lit(TEMP_BASE) + _between(F.col("_ut"), *TEMP_RANGE), 2).alias("temperature_c"),
        F.when(F.col("_us") < ERROR_BELOW, "error").when(F.col("_us") < WARNING_BELOW, "warning").otherwise("normal").alias("status"),
        *[F.col(f"carry.`{c}`") for c in carry],
    )


def in_range(lo: Column, hi: Column, voltage_nominal: Column) -> Column:
    """Whether a generated reading lies within the formula's bounds (rounding allowed for).

    ``lo`` and ``hi`` are the site's ``base_range``; they cost least where they come along with the site.
    """
    kwh, kw, half = F.col("kwh_consumed"), F.col("kw_demand"), 0.0005
    low_volt, high_volt = (voltage_nominal * f for f in VOLTAGE_BAND)
    return (
        kwh.between(lo * NIGHT_FACTOR - half, hi * BUSINESS_FACTOR * SPIKE_RANGE[1] + half)
        & kw.between(kwh * DEMAND_RANGE[0] - 2 * half, kwh * DEMAND_RANGE[1] + 2 * half)
        & F.col("voltage").between(low_volt - 0.01, high_volt + 0.01)
        & F.col("temperature_c").between(TEMP_BASE + TEMP_RANGE[0] - 0.01, TEMP_BASE + TEMP_RANGE[1] + 0.01)
        & F.col("status").isin("normal", "warning", "error")
    )


def scaled_sites(spark: SparkSession, n_sites: int, as_of: dt.date, seed: int = 43) -> DataFrame:
    """``n_sites`` sites cycling through the lab's types, units and regions (for scale runs)."""
    spec = spark.createDataFrame(
        [(i, r[2], r[3], r[4], r[7]) for i, r in enumerate(SITE_ROWS)],
        "k int, site_type string, business_unit_id string, region_id string, square_footage int",
    )
    ids = spark.range(1, n_sites + 1).withColumn("k", (F.col("id") % len(SITE_ROWS)).cast("int"))
    return ids.join(F.broadcast(spec), on="k").select(
        F.format_string("SITE-%04d", F.col("id")).alias("site_id"),
        F.format_string("Site %d", F.col("id")).alias("site_name"),
        "site_type",
        "business_unit_id",
        "region_id",
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("state"),
        "square_footage",
        F.date_sub(F.lit(as_of), (F.lit(180) + F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1621))).cast("int")).alias("installation_date"),
        F.lit(480).alias("voltage_nominal"),
    )
