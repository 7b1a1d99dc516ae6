"""The silver step (CMP1) as a Structured Streaming query.

Silver is row-wise (filter, expectation, stream-static join with the site
dimension, derived date), so the very same ``pipeline.silver`` function runs
on a streaming DataFrame: new reading files are cleaned and enriched as they
land, and each micro-batch appends to the silver table. The 2-sigma gold
step stays batch, because its baseline spans each site's whole history.

Exactly-once comes from the checkpoint folder plus the file sink's commit
log; a restarted query resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sitewatts import schemas
from sitewatts.plans import pipeline


def read_readings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet reading files under ``path`` as an unbounded stream (fixed schema)."""
    reader = spark.readStream.schema(schemas.METER_READINGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def silver_stream(readings: DataFrame, sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """Streaming silver: same operator as batch, dimensions joined as static tables."""
    return pipeline.silver(readings, sites, regions, business_units)


def start_silver_sink(
    silver: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append micro-batches of silver to Parquet files at ``sink_path``.

    ``available_now`` processes everything present and stops (a scheduled
    incremental run); otherwise the query keeps running every 10 seconds.
    """
    writer = (
        silver.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
