"""What a plan does, from its text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical(df: DataFrame) -> str:
    """The physical plan before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df: DataFrame) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Round|Single)", physical(df)))


def uses_python(df: DataFrame) -> bool:
    """Whether rows leave the JVM."""
    return bool(re.search("Python|Pandas|Arrow", physical(df)))


def read_columns(df: DataFrame) -> list[str]:
    """Read schemas of the plan's scans, as far as the plan prints them."""
    return re.findall(r"ReadSchema: struct<([^>\n]*)", physical(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)(?:\]|\.\.\.)", physical(df))
