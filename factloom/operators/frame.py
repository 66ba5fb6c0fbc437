"""Shaping of frames: alignment to a schema, de-duplication, stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns by name, in its order and types; one that is missing is NULL, others go."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form a group."""
    rank = unused(df, "_rank")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) == 1).drop(rank)


def dedupe(df: DataFrame, keys: list[str], latest_by: list[str] | None = None) -> DataFrame:
    """One row for each key: the one that is last in `latest_by`; all other columns break ties, so the choice is total.

    NULL keys form a group.  Maps cannot be ordered and are compared as JSON.
    """
    if not keys:
        raise ValueError("de-duplication needs at least one key column")
    latest_by = latest_by or []
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    text = {n for n, kind in df.dtypes if "map<" in kind}
    order = [F.col(c).desc_nulls_last() for c in latest_by] + [(F.to_json(c) if c in text else F.col(c)).asc_nulls_last() for c in rest]
    return first_of(df, keys, order or [F.lit(1)])


def stamp(df: DataFrame, run_id: str, source_version: int | None, generated_at: str | None = None) -> DataFrame:
    """Provenance of a rebuilt table."""
    at = F.current_timestamp() if generated_at is None else F.to_timestamp(F.lit(generated_at))
    return df.withColumns({"_generated_at": at, "_run_id": F.lit(run_id), "_source_version": F.lit(source_version).cast("bigint")})
