"""Plan inspection helpers used by tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    """Formatted physical plan text (the AQE initial plan, before running)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df: DataFrame) -> str:
    """The physical plan text after running the query, as AQE left it (reused
    exchanges, coalesced and skewed partitions)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
