import pytest


@pytest.fixture
def extra(spark):
    """Adds columns whose names clash with those that the operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        for c in ("id", "n", "score", "start", "length", "kind", "pivot", "words", "bucket", "part", "a.b"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit("x"))
        return df

    return add
