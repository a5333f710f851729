"""Read a DataFrame's physical plan: what scans read, what shuffles, what runs in Python."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas", "MapInPandas",
                "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow", "MapInArrow", "AggregateInPandas", "WindowInPandas",
                "PythonUDF", "PythonUDTF")


def physical_plan(df: DataFrame) -> str:
    """The planned physical plan (before AQE re-planning)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df: DataFrame) -> str:
    """The text `df.explain("formatted")` prints."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)[^\n]*",
                      plan)


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)


def pushed_filters(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan)


def python_nodes(plan: str) -> list[str]:
    return [n for n in PYTHON_NODES if n in plan]
