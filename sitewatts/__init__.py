"""sitewatts: energy-meter analytics on Spark DataFrames.

Raw 15-minute meter readings plus site, region and business-unit dimensions
are cleaned into a silver table, rolled up into a daily per-site gold table
with a per-site baseline and a 2-sigma anomaly flag, and queried by a set of
plain DataFrame operators (filters, joins, aggregations, windows, top-k,
measures, triage, forecast).

Layout:
  sources/    table reads, the driver-table adapter, generators, sinks
  functions/  Column expressions and the SQL table function
  operators/  filters, joins, aggregates, windows, measures, quality, top-k
  plans/      composite results: silver, gold, anomaly details, triage, ...
  streaming/  the silver step as a Structured Streaming query
"""

from sitewatts.session import get_session

__all__ = ["get_session"]
