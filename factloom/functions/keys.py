"""Deterministic keys and change hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

#: Stands for NULL inside a hashed text; no business value holds it.
NULL_MARK = "␀"
#: Between the parts of a change hash.
UNIT = "\x01"


def surrogate_key(*parts: Column | str, null_mark: str = "\0null\0", separator: str = "|") -> Column:
    """SHA-256 over the parts as text, in order; a NULL part differs from every text."""
    if not parts:
        raise ValueError("a surrogate key needs at least one part")
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit(null_mark)) for c in cols]), 256)


def _as_text(df: DataFrame, name: str, within: str = "") -> Column:
    kind = df.schema[name].dataType
    value = F.col(within + name)
    if isinstance(kind, ArrayType):
        # JSON keeps ['a,b'] apart from ['a', 'b'] and an empty array apart from NULL.
        value = F.to_json(F.array_sort(value))
    elif isinstance(kind, MapType):
        value = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))
    return F.coalesce(value.cast("string"), F.lit(NULL_MARK))


def hash_diff(df: DataFrame, columns: list[str], within: str = "") -> Column:
    """SHA-256 over the tracked columns; the order within arrays and maps does not matter, NULL differs from empty.

    `within` is put before names, where the columns have become fields of a struct.
    """
    if not columns:
        raise ValueError("a change hash needs at least one column")
    return F.sha2(F.concat_ws(UNIT, *[_as_text(df, c, within) for c in columns]), 256)
