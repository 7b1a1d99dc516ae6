"""Shared measures of the semantic layer (MSR1-MSR5).

MSR2 is evaluated over the whole site partition before any date filter
(D4): the "site's 30-day mean" is the gold baseline, not the mean of a
filtered slice. ``deviation_over_filtered`` gives the literal post-filter
form for callers who want it (T11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatts.functions.columns import safe_div
from sitewatts.functions.exact import cents_sql, far_sql
from sitewatts.operators.joins import with_site_details


def kwh_per_sqft() -> Column:
    """Daily kWh per square foot; NULL for zero area (MSR1, T3)."""
    return safe_div("total_kwh", "square_footage")


def is_anomaly() -> Column:
    """``anomaly_flag = true`` (MSR3)."""
    return F.col("anomaly_flag") == F.lit(True)


def with_site_stats(gold: DataFrame) -> DataFrame:
    """Add _n / _s: the site's day count and cents total over the whole partition; _f: its NaN, infinite and
    huge totals (kWh) added up, null without any."""
    w = "OVER (PARTITION BY site_id)"
    return gold.selectExpr(
        "*", f"count(total_kwh) {w} AS _n", f"sum({cents_sql('total_kwh')}) {w} AS _s", f"sum({far_sql('total_kwh')}) {w} AS _f"
    )


#: The site's mean (kWh) where _f isn't null.
ROUGH_MEAN = "((_f + coalesce(_s, 0) / 100D) / _n)"


def deviation_from_baseline_pct_expr() -> Column:
    """(total - site mean) / site mean * 100, unrounded, from _n/_s/_f (MSR2).

    (n*t - S) * 100 / S in exact integers, then one division; in doubles where a total isn't near.
    """
    exact = f"CASE WHEN _s <> 0 THEN CAST((_n * {cents_sql('total_kwh')} - _s) * 100 AS DOUBLE) / CAST(_s AS DOUBLE) END"
    rough = f"try_divide(total_kwh - {ROUGH_MEAN}, {ROUGH_MEAN}) * 100D"
    return F.expr(f"CASE WHEN _f IS NULL THEN {exact} ELSE {rough} END")


def with_deviation_from_baseline(gold: DataFrame) -> DataFrame:
    """Add ``deviation_from_baseline_pct`` computed on the full table (MSR2, D4)."""
    return (
        with_site_stats(gold)
        .withColumn("deviation_from_baseline_pct", deviation_from_baseline_pct_expr())
        .drop("_n", "_s", "_f")
    )


def deviation_over_filtered(gold: DataFrame) -> DataFrame:
    """The literal form of MSR2 on whatever rows ``gold`` holds (T11)."""
    return with_deviation_from_baseline(gold)


def measured(gold: DataFrame, sites: DataFrame) -> DataFrame:
    """gold ⋈ sites with kwh_per_sqft, deviation_from_baseline_pct, is_anomaly (MSR4)."""
    base = with_deviation_from_baseline(gold)
    joined = with_site_details(base, sites, ["site_name", "square_footage"])
    return joined.withColumns({"kwh_per_sqft": kwh_per_sqft(), "is_anomaly": is_anomaly()}).drop(
        "square_footage"
    )


def ensure_deviation(df: DataFrame) -> DataFrame:
    """Use ``deviation_pct``; if the column is missing, recompute it (MSR5).

    Recomputed as round((total_kwh - site_mean_kwh) / site_mean_kwh * 100, 1)
    from the row's own columns, so it also works on filtered rows.
    """
    if "deviation_pct" in df.columns:
        return df
    t, m = F.col("total_kwh"), F.col("site_mean_kwh")
    # Rounding to 10 dp first absorbs float noise, so a value that is exactly
    # on a .x5 boundary rounds half up as the exact arithmetic would.
    dev = F.round(F.round(F.try_divide(t - m, m) * F.lit(100), 10), 1) + F.lit(0.0)
    return df.withColumn("deviation_pct", dev)
