"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers the raw tables (region, nation, customer, events, ...)
as views. ``BASE`` rebuilds the meter star schema, silver and gold from them
with the same rules as the Spark code, independently written in SQL; each
query appends its SELECT. The daily total is ``round(sum(kwh), 2)``; from there
integer arithmetic mirrors the exact gold rules, so values agree bit for bit.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"

BASE = r"""
WITH regions AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS region_id,
         r_name AS region_name,
         CASE r_regionkey % 4 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
              WHEN 2 THEN 'America/Los_Angeles' WHEN 3 THEN 'America/Phoenix' END AS timezone
  FROM region
),
business_units AS (
  SELECT DISTINCT c_mktsegment AS business_unit_id, c_mktsegment AS business_unit_name,
         CAST(NULL AS VARCHAR) AS description
  FROM customer
),
sites AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS site_id,
         c.c_name AS site_name,
         CASE c.c_custkey % 5 WHEN 0 THEN 'factory' WHEN 1 THEN 'warehouse' WHEN 2 THEN 'office'
              WHEN 3 THEN 'data_center' WHEN 4 THEN 'retail' END AS site_type,
         c.c_mktsegment AS business_unit_id,
         CAST(n.n_regionkey AS VARCHAR) AS region_id,
         n.n_name AS city,
         CAST(n.n_nationkey AS VARCHAR) AS state,
         CAST(1000 + (c.c_custkey % 97) * 100 AS INTEGER) AS square_footage,
         CAST(DATE '2020-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS DATE) AS installation_date,
         480 AS voltage_nominal
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
meter_readings AS (
  SELECT CAST(event_id AS VARCHAR) AS reading_id,
         CAST(user_id AS VARCHAR) AS site_id,
         ts AS reading_timestamp,
         value AS kwh_consumed,
         value * 4 AS kw_demand,
         50.0::DOUBLE + 6.0::DOUBLE * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS voltage,
         CAST(15 + event_id % 20 AS DOUBLE) AS temperature_c,
         CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warning'
              ELSE 'normal' END AS status
  FROM events
),
site_dim AS (
  SELECT s.site_id, s.site_type, s.business_unit_id, b.business_unit_name, s.region_id,
         r.region_name, s.voltage_nominal, s.square_footage
  FROM sites s
  LEFT JOIN regions r ON s.region_id = r.region_id
  LEFT JOIN business_units b ON s.business_unit_id = b.business_unit_id
),
silver_unchecked AS (
  SELECT m.site_id, m.reading_id, m.reading_timestamp, m.kwh_consumed, m.kw_demand, m.voltage,
         m.temperature_c, m.status, d.site_type, d.business_unit_id, d.business_unit_name,
         d.region_id, d.region_name, d.voltage_nominal, d.square_footage,
         CAST(m.reading_timestamp AS DATE) AS reading_date
  FROM meter_readings m LEFT JOIN site_dim d ON m.site_id = d.site_id
  WHERE m.status <> 'error'
),
silver AS (
  SELECT * FROM silver_unchecked WHERE COALESCE(kwh_consumed >= 0, FALSE)
),
daily_raw AS (
  SELECT site_id, site_type, business_unit_id, business_unit_name, region_id, region_name,
         reading_date,
         ROUND(SUM(kwh_consumed), 2) AS rounded_kwh,
         ROUND(MAX(kw_demand), 2) AS peak_kw,
         ROUND(AVG(voltage), 2) AS avg_voltage,
         CAST(SUM(CASE WHEN status = 'warning' THEN 1 ELSE 0 END) AS BIGINT) AS warning_count
  FROM silver
  GROUP BY ALL
),
daily AS (
  SELECT *,
         CAST(ROUND(rounded_kwh * 100) AS BIGINT) AS total_cents
  FROM daily_raw
),
site_stats AS (
  SELECT site_id,
         COUNT(total_cents) AS n,
         CAST(SUM(total_cents) AS HUGEINT) AS s,
         SUM(CAST(total_cents AS HUGEINT) * CAST(total_cents AS HUGEINT)) AS q
  FROM daily GROUP BY site_id
),
gold_calc AS (
  SELECT d.*, st.n, st.s, st.q,
         CAST(st.n AS HUGEINT) * st.q - st.s * st.s AS var_num,
         CAST(st.n AS HUGEINT) * d.total_cents - st.s AS spread
  FROM daily d JOIN site_stats st ON d.site_id IS NOT DISTINCT FROM st.site_id
),
gold_full AS (
  SELECT site_id, site_type, business_unit_id, business_unit_name, region_id, region_name,
         reading_date,
         CAST(total_cents AS DOUBLE) / 100.0::DOUBLE AS total_kwh,
         peak_kw, avg_voltage, warning_count,
         CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / CAST(n * 100 AS DOUBLE) END AS site_mean_kwh,
         CASE WHEN n > 0 THEN sqrt(CAST(CAST(var_num AS VARCHAR) AS DOUBLE)) / CAST(n * 100 AS DOUBLE) END
           AS site_stddev_kwh,
         CASE WHEN s <> 0 THEN
           CAST(CASE WHEN spread * 1000 * sign(s) >= 0
                     THEN (2 * spread * 1000 * sign(s) + abs(s)) // (2 * abs(s))
                     ELSE -((-2 * spread * 1000 * sign(s) + abs(s)) // (2 * abs(s))) END AS DOUBLE)
           / 10.0::DOUBLE END AS deviation_pct,
         COALESCE(spread > 0 AND spread * spread > 4 * var_num, FALSE) AS anomaly_flag,
         total_cents
  FROM gold_calc
),
gold AS (
  SELECT site_id, site_type, business_unit_id, business_unit_name, region_id, region_name,
         reading_date, total_kwh, peak_kw, avg_voltage, warning_count, site_mean_kwh,
         site_stddev_kwh, deviation_pct, anomaly_flag
  FROM gold_full
)
"""


def q(select: str) -> str:
    return BASE + select
