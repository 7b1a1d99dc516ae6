"""Dry run of a pipeline of datasets (DQ4): names, columns and types are resolved, no data is read.

A dataset is declared with its inputs, its columns and their types, and a function that
builds it from its inputs. ``problems`` analyses every dataset on empty inputs
that have the *declared* columns, so a mistake shows once, where it is made, and not again in
everything downstream. ``build`` puts the same functions together on real sources,
lazily: only what a dataset needs is built, and once.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sitewatts import schemas
from sitewatts.operators import aggregates, joins
from sitewatts.operators.quality import Problem, schema_problems
from sitewatts.plans import pipeline


@dataclasses.dataclass(frozen=True)
class Dataset:
    """``build`` gets the inputs in order; without it the dataset is a source."""

    name: str
    schema: StructType
    inputs: tuple[str, ...] = ()
    build: Callable[..., DataFrame] | None = None


class Graph:
    """Named datasets; those without a ``build`` are sources."""

    def __init__(self, datasets: list[Dataset]):
        self.datasets = datasets
        self.by_name = {d.name: d for d in datasets}

    def _order_problems(self, sources: Mapping[str, DataFrame]) -> list[Problem]:
        names = [d.name for d in self.datasets]
        found = [Problem(n, "twice", "declared more than once") for n in sorted({n for n in names if names.count(n) > 1})]
        for d in self.datasets:
            if d.build is None and d.name not in sources:
                found.append(Problem(d.name, "missing", "no such source"))
            found += [Problem(d.name, "missing", f"input {i} isn't declared") for i in d.inputs if i not in self.by_name]
        done: set[str] = set()
        left = list(self.datasets)
        while left:
            ready = [d for d in left if all(i in done or i not in self.by_name for i in d.inputs)]
            if not ready:
                # those that only depend on a ring aren't part of it
                ring = [d for d in left if any(d.name in other.inputs for other in left)]
                found.append(Problem(ring[0].name, "ring", f"needs itself: {sorted(d.name for d in ring)}"))
                break
            done |= {d.name for d in ready}
            left = [d for d in left if d.name not in done]
        return found

    def problems(self, spark: SparkSession, sources: Mapping[str, DataFrame]) -> list[Problem]:
        """Everything that would stop a run, or change what it is declared to give; no job is started."""
        found = self._order_problems(sources)
        empty = {d.name: spark.createDataFrame([], d.schema) for d in self.datasets}
        for d in self.datasets:
            try:
                if d.build is None:
                    if d.name in sources:
                        found += schema_problems(d.name, sources[d.name].schema, d.schema)
                elif all(i in empty for i in d.inputs):
                    found += schema_problems(d.name, d.build(*[empty[i] for i in d.inputs]).schema, d.schema)
            except PySparkException as error:
                found.append(Problem(d.name, "analysis", str(error).splitlines()[0]))
        return found

    def build(self, spark: SparkSession, sources: Mapping[str, DataFrame], name: str) -> DataFrame:
        """A dataset on real sources; raises ``ValueError`` with the problems if there are any."""
        found = self.problems(spark, sources)
        if found:
            raise ValueError("; ".join(map(str, found)))
        built: dict[str, DataFrame] = {}

        def get(n: str) -> DataFrame:
            if n not in built:
                d = self.by_name[n]
                built[n] = sources[n] if d.build is None else d.build(*map(get, d.inputs))
            return built[n]

        return get(name)


#: The lab's datasets. Inputs of silver and gold: the base tables in the order of schemas.BASE_TABLES.
_BASE = ("meter_readings", "sites", "regions", "business_units")
LAB = Graph(
    [
        Dataset("regions", schemas.REGIONS),
        Dataset("business_units", schemas.BUSINESS_UNITS),
        Dataset("sites", schemas.SITES),
        Dataset("meter_readings", schemas.METER_READINGS),
        Dataset("site_dim", schemas.SITE_DIM, ("sites", "regions", "business_units"), joins.site_dim),
        Dataset("silver_readings", schemas.SILVER, _BASE, pipeline.silver),
        Dataset("daily_site_consumption", schemas.GOLD, ("silver_readings",), pipeline.gold),
        Dataset("gold_audit", schemas.GOLD_AUDIT, ("daily_site_consumption",), aggregates.gold_audit),
    ]
)
