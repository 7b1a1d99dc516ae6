"""Scans, sinks and catalog helpers (SRC1, SRC2, SRC5-SRC7, SNK1-SNK3, SET1).

Tables are Parquet (no Delta jar here); overwrite replaces data and schema.
Names are always passed as bound identifiers, never spliced into SQL text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts import schemas


def scan(spark: SparkSession, name: str) -> DataFrame:
    """Whole-table batch read by (qualified) name (SRC1)."""
    return spark.table(name)


def table_or_files(spark: SparkSession, name: str) -> DataFrame:
    """A table by name; if this session's catalog does not know it, register
    the Parquet folder a previous session wrote under the warehouse
    (``<warehouse>/<namespace>.db/<table>``) and read that."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    namespace, _, table = name.rpartition(".")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{warehouse}/{namespace}.db/{table}" if namespace else f"{warehouse}/{table}"
    if namespace:
        ensure_namespace(spark, namespace)
    spark.catalog.createTable(name, path=folder, source="parquet")
    return spark.table(name)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Idempotent schema creation (SRC5)."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:ns)", args={"ns": name})


def qualified(namespace: str | None, table: str) -> str:
    """Parameterised table name (SRC6)."""
    return f"{namespace}.{table}" if namespace else table


def preview(df: DataFrame, n: int = 5) -> tuple[list, int]:
    """First ``n`` rows (unordered, as the seeder prints them) and the count (SRC7)."""
    return df.limit(n).collect(), df.count()


def save_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    bucket_by: tuple[str, int] | None = None,
    rebalance: bool = True,
) -> None:
    """Overwrite a table, data and schema (SNK1).

    ``rebalance=False``: the rows come from a table of the same partitioning, so
    each task holds few partition values already and nothing is shuffled.

    ``bucket_by=(column, n)`` writes n buckets sorted by the column, so later
    joins and windows on that column read co-located data without a shuffle.
    Use it only on a column without hot keys (e.g. site_id on gold, at most
    one row per site and day), never on raw readings.
    """
    if partition_by and rebalance:
        # AQE regroups rows by partition value into advisory-sized tasks (and
        # splits large ones), so each task writes few, well-sized files
        # instead of one small file per partition value per input task.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        column, n = bucket_by
        writer = writer.bucketBy(n, column).sortBy(column)
    writer.saveAsTable(name)


def annotate(spark: SparkSession, table: str, comment: str | None, columns: dict[str, str] | None = None) -> None:
    """Attach a table comment and column comments (SNK2)."""
    if comment is not None:
        spark.sql("COMMENT ON TABLE IDENTIFIER(:t) IS :c", args={"t": table, "c": comment})
    for column, text in (columns or {}).items():
        spark.sql(
            "ALTER TABLE IDENTIFIER(:t) ALTER COLUMN IDENTIFIER(:col) COMMENT :c",
            args={"t": table, "col": column, "c": text},
        )


def materialize(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    columns: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    bucket_by: tuple[str, int] | None = None,
    rebalance: bool = True,
) -> DataFrame:
    """Write a derived dataset as a named table with its description (SNK3).

    Returns the table read back, which cuts the lineage: later questions start
    from the written files, and a lost executor only recomputes from there.
    """
    spark = df.sparkSession
    save_table(df, name, partition_by, bucket_by, rebalance)
    annotate(spark, name, comment, columns)
    return spark.table(name)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    The folder is the shared one the cluster names; a local folder is set only
    when the session has none (tests, single machine). Never a local
    checkpoint: a lost executor must not lose the data.
    """
    from sitewatts.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of (table_name, row_count) per table (SET1, DQ5)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def base_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: tables[name] for name in schemas.BASE_TABLES}
