"""Window operators beyond the gold baseline (WIN5, WIN6; UDF2).

WIN1-WIN4 live in ``plans.pipeline.with_baseline``. Top-n per group uses
``row_number() <= n``, which Spark plans as a WindowGroupLimit before the
shuffle, so a huge business unit sends only its local top n per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatts.operators import aggregates, filters, measures

DateLike = str | dt.date


def top_consumers(gold: DataFrame, month: DateLike, n: int = 3) -> DataFrame:
    """Top ``n`` sites by kWh in ``month`` within each business unit (WIN5, D6, D7)."""
    per_site = aggregates.site_month_kwh(gold, month)
    w = Window.partitionBy("business_unit_name").orderBy(F.desc("month_kwh"), F.asc("site_id"))
    return per_site.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_consumers_fn(month: DateLike, n: int = 3) -> Callable[[DataFrame], DataFrame]:
    """WIN5 as a reusable function for ``DataFrame.transform`` (UDF2)."""
    return lambda gold: top_consumers(gold, month, n)


def site_trend(gold: DataFrame, site_id: str) -> DataFrame:
    """One site's daily kWh by date with its mean and deviation (WIN6).

    The site filter is on the window's partition key, so Catalyst pushes it
    below the window and only that site's rows are read past the scan.
    """
    one = filters.for_site(gold, site_id)
    return (
        measures.with_deviation_from_baseline(one)
        .select(
            "site_id",
            "reading_date",
            "total_kwh",
            "site_mean_kwh",
            "deviation_pct",
            "deviation_from_baseline_pct",
            "anomaly_flag",
        )
        .orderBy("reading_date")
    )
