"""Data-quality expectations (DQ1-DQ5) and dimension guards (T5).

A rule is a named boolean Column. NULL counts as a failure (D2): for
expect-or-drop the row goes, for expect it stays and is counted.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def silver_rules() -> dict[str, tuple[Column, str]]:
    """name -> (condition, action); action is "drop" or "warn"."""
    return {
        "non_negative_kwh": (F.col("kwh_consumed") >= 0, "drop"),
        "voltage_in_range": (F.col("voltage").between(100, 600), "warn"),
    }


def passes(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def expect_or_drop(df: DataFrame, name: str, cond: Column) -> DataFrame:
    """Drop rows failing ``cond`` (DQ1).

    A filter keeps only rows where ``cond`` is TRUE, so NULL is dropped as a
    failure; the bare predicate (no coalesce) stays pushable to the scan.
    """
    return df.filter(cond)


def expect(df: DataFrame, name: str, cond: Column) -> DataFrame:
    """Keep every row; failures are only counted (DQ2)."""
    return df


def apply_rules(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    for name, (cond, action) in rules.items():
        df = expect_or_drop(df, name, cond) if action == "drop" else expect(df, name, cond)
    return df


def expectation_metrics(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """Passed / failed counts per rule, in one pass over ``df`` (DQ3).

    ``df`` is the dataset the rules wrap (before any drop), so every rule is
    measured on the same rows. Rules on reading columns only can be measured on
    the readings themselves: a left join on a unique key changes no row count.
    """
    one = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(passes(cond)).alias(f"__{k}") for k, (cond, _action) in enumerate(rules.values())],
    )
    rows = ", ".join(f"'{name}', '{action}', `__{k}`, `__total` - `__{k}`" for k, (name, (_c, action)) in enumerate(rules.items()))
    return one.select(F.expr(f"stack({len(rules)}, {rows}) AS (rule, action, passed, failed)"))


def observe_rules(df: DataFrame, rules: dict[str, tuple[Column, str]], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach the DQ3 counters to a job that runs anyway (no extra pass).

    Returns the observed DataFrame (rules not yet applied) and the
    Observation whose ``.get`` holds ``<rule>__failed`` and ``rows`` once an
    action on a descendant has run.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~passes(cond)).alias(f"{rule}__failed") for rule, (cond, _a) in rules.items()]
    return df.observe(obs, *metrics), obs


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (T5 guard: a duplicate dimension key fans out joins)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (T5)."""
    return fact.join(dim.select(key).distinct(), on=key, how="left_anti")


def dimension_guard(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, key) that breaks uniqueness, plus the orphan-reading count.

    Columns: guard, table_name, key_value, n_rows.
    """
    checks = [
        ("regions", "region_id"),
        ("business_units", "business_unit_id"),
        ("sites", "site_id"),
    ]
    parts = [
        duplicate_keys(tables[t], k).select(
            F.lit("duplicate_key").alias("guard"),
            F.lit(t).alias("table_name"),
            F.col(k).cast("string").alias("key_value"),
            "n_rows",
        )
        for t, k in checks
    ]
    # Aggregate first: readings per site (partial aggregation), then the anti
    # join runs on one row per site instead of on every reading.
    per_site = tables["meter_readings"].groupBy("site_id").agg(F.count(F.lit(1)).alias("_n"))
    orphan_count = orphans(per_site, tables["sites"], "site_id").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows")
    )
    parts.append(
        orphan_count.select(
            F.lit("orphan_readings").alias("guard"),
            F.lit("meter_readings").alias("table_name"),
            F.lit(None).cast("string").alias("key_value"),
            "n_rows",
        )
    )
    return reduce(DataFrame.unionByName, parts)


@dataclasses.dataclass(frozen=True)
class Problem:
    """What a dry run finds about a dataset."""

    dataset: str
    kind: str  # missing, ring, twice, analysis, columns or type
    text: str

    def __str__(self) -> str:
        return f"{self.dataset}: {self.text}"


def schema_problems(name: str, have: StructType, declared: StructType) -> list[Problem]:
    """Differences in columns (one problem) and in the types of those that are in both (one each)."""
    missing = [f.name for f in declared if f.name not in have.fieldNames()]
    extra = [c for c in have.fieldNames() if c not in declared.fieldNames()]
    found = []
    if missing or extra:
        found.append(Problem(name, "columns", f"columns missing: {missing}, not declared: {extra}"))
    elif have.fieldNames() != declared.fieldNames():
        found.append(Problem(name, "columns", f"columns in another order: {have.fieldNames()}"))
    for f in declared:
        if f.name in have.fieldNames() and have[f.name].dataType != f.dataType:
            got = have[f.name].dataType.simpleString()
            found.append(Problem(name, "type", f"{f.name} is {got}, declared as {f.dataType.simpleString()}"))
    return found


def validate(datasets: dict[str, DataFrame], expected: dict[str, list[str] | StructType]) -> list[str]:
    """Dry run of separate datasets against their column names, or names and types, without moving data (DQ4).

    ``plans.graph`` does it for datasets that are built from one another.
    """
    problems: list[str] = []
    for name, declared in expected.items():
        if name not in datasets:
            problems.append(f"{name}: missing")
            continue
        try:
            have = datasets[name].schema
        except Exception as exc:  # analysis error surfaces here, before any job
            problems.append(f"{name}: {type(exc).__name__}: {exc}")
            continue
        if isinstance(declared, StructType):
            problems += map(str, schema_problems(name, have, declared))
        elif have.fieldNames() != declared:
            problems.append(f"{name}: columns {have.fieldNames()} != {declared}")
    return problems


def verify_seed(audit: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Compare SET1 row counts with expected counts (DQ5)."""
    spark = audit.sparkSession
    exp = spark.createDataFrame(list(expected.items()), "table_name string, expected_rows long")
    return audit.join(exp, on="table_name", how="full").withColumn(
        "ok", F.coalesce(F.col("row_count") == F.col("expected_rows"), F.lit(False))
    )
