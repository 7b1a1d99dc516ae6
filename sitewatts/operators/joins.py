"""Joins of the star schema (JOIN1-JOIN8).

No join carries a hint: the planner's size statistics and AQE's byte thresholds
choose between a broadcast and a sort-merge join, and AQE splits the hot
partitions of a sort-merge join. Building a join starts no Spark job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatts import schemas

def site_dim(sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """sites ⟕ regions ⟕ business_units, 8 columns (JOIN1, JOIN2, PRJ1)."""
    return (
        sites.join(regions, on="region_id", how="left")
        .join(business_units, on="business_unit_id", how="left")
        .select(*schemas.SITE_DIM_COLUMNS)
    )


def enrich(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """readings ⟕ site_dim USING(site_id): orphan readings keep NULL attributes (JOIN3, T5)."""
    return readings.join(dim, on="site_id", how="left")


def with_site_details(df: DataFrame, sites: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """df ⋈ sites USING(site_id), inner: orphans drop out here (JOIN4, T5).

    ``columns`` picks the site attributes to bring (default: all not already in df).
    """
    present = set(df.columns)
    wanted = columns or [c for c in sites.columns if c not in present]
    right = sites.select("site_id", *[c for c in wanted if c != "site_id"])
    return df.join(right, on="site_id", how="inner")


# Declared join relationships usable by any question (JOIN5). Fixed values:
# (left table, right table, key).
RELATIONSHIPS = [
    ("sites", "regions", "region_id"),
    ("sites", "business_units", "business_unit_id"),
    ("daily_site_consumption", "sites", "site_id"),
    ("daily_site_consumption", "regions", "region_id"),
    ("daily_site_consumption", "business_units", "business_unit_id"),
]


def join_related(df: DataFrame, left: str, right: str, right_df: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``right_df`` onto ``df`` through the declared relationship left -> right (JOIN5)."""
    keys = [k for (l_name, r_name, k) in RELATIONSHIPS if l_name == left and r_name == right]
    if not keys:
        raise ValueError(f"no declared relationship {left} -> {right}")
    key = keys[0]
    extra = [c for c in right_df.columns if c == key or c not in df.columns]
    return df.join(right_df.select(*extra), on=key, how=how)


def meter_health(anoms: DataFrame, counts: DataFrame) -> DataFrame:
    """Anomalous (site, day) ⟕ raw status counts of the same day (JOIN6).

    ``counts`` is AGG12 output keyed by (site_id, reading_date); missing days
    count as zero.
    """
    return anoms.join(counts, on=["site_id", "reading_date"], how="left").withColumns(
        {
            "warning_readings": F.coalesce(F.col("warning_readings"), F.lit(0)).cast("long"),
            "error_readings": F.coalesce(F.col("error_readings"), F.lit(0)).cast("long"),
        }
    )


def warnings_for(ranked: DataFrame, readings: DataFrame) -> DataFrame:
    """Raw readings of previously ranked sites only (JOIN7): ``readings ⋉ ranked``."""
    return readings.join(ranked.select("site_id").distinct(), on="site_id", how="left_semi")


def explore_view(readings: DataFrame, sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """Readings with all three dimensions, keeping site_name and timezone (JOIN8)."""
    dim = (
        sites.join(regions, on="region_id", how="left")
        .join(business_units, on="business_unit_id", how="left")
        .select(
            "site_id",
            "site_name",
            "site_type",
            "square_footage",
            "business_unit_id",
            "business_unit_name",
            "region_id",
            "region_name",
            "timezone",
        )
    )
    return readings.join(dim, on="site_id", how="left")
