"""Joins by time: the nearest earlier row, and intervals that overlap.  Neither compares all rows of a key with each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frame import unused


def _seconds(c: Column | str) -> Column:
    """A date or timestamp as whole seconds, so that bins and tolerances are alike for both."""
    return F.unix_seconds((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str | None = None, tolerance: int | None = None, width: int | None = None, prefix: str = "") -> DataFrame:
    """Each left row with the last right row of its key at the same time or before, NULLs where there is none.

    Both sides are laid together and the right row seen last is carried along one sort of a key, so a key costs its number of rows and
    not the product of both sides.  With `width`, in seconds, a key's rows are dealt to bins of time, and each bin begins
    with what the bins before it carried: then no key, however hot, has to be sorted by one task.

    Of right rows at one time the last by all their other columns counts.  A match is at most `tolerance` seconds old.  Keys
    are compared null-safe; a left row without a time has no match and a right row without one is none.  Columns of right
    but the keys are added, under `prefix` where given; a name that left has already is an error.
    """
    right_at = right_at or at
    added = {c: f"{prefix}{c}" for c in right.columns if c not in keys}
    if clash := [n for n in added.values() if n in left.columns]:
        raise ValueError(f"left has columns {', '.join(clash)} already; give a prefix")
    side, time, bin_, own, found = (unused(left, n) for n in ("_side", "_time", "_bin", "_left", "_right"))
    order = [c for c in right.columns if c not in keys and c != right_at]
    value = F.struct(F.col(right_at), *[F.col(c) for c in order])
    timed = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).cast("timestamp").alias(time), value.alias(found))
    rows = left.select(*keys, F.col(at).cast("timestamp").alias(time), F.struct(*left.columns).alias(own))
    # A left row without a time sorts before all others and so finds nothing.
    both = rows.select(*keys, time, F.lit(1).alias(side), own, F.lit(None).cast(timed.schema[found].dataType).alias(found)).unionByName(timed.select(*keys, time, F.lit(0).alias(side), F.lit(None).cast(rows.schema[own].dataType).alias(own), found))
    by = list(keys)
    if width is not None:
        if width <= 0:
            raise ValueError("a bin is at least one second wide")
        by.append(bin_)
        both = both.withColumn(bin_, F.floor(_seconds(time) / width))
        last = both.groupBy(*by).agg(F.max_by(found, F.when(F.col(side) == 0, F.struct(time, found))).alias(found))
        before = Window.partitionBy(*keys).orderBy(F.col(bin_).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        carried = last.select(*by, F.last(found, ignorenulls=True).over(before).alias(found)).where(F.col(found).isNotNull() & F.col(bin_).isNotNull())
        both = both.unionByName(carried.select(*keys, F.col(f"{found}.{right_at}").cast("timestamp").alias(time), F.lit(0).alias(side), F.lit(None).cast(rows.schema[own].dataType).alias(own), found, bin_))
    seen = Window.partitionBy(*by).orderBy(F.col(time).asc_nulls_first(), side, F.col(found).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn(found, F.last(found, ignorenulls=True).over(seen)).where(F.col(side) == 1)
    hit = F.col(found)
    if tolerance is not None:
        hit = F.when(_seconds(time) - _seconds(F.col(f"{found}.{right_at}")) <= tolerance, hit)
    return out.withColumn(found, hit).select(f"{own}.*", *[F.col(f"{found}.{c}").alias(n) for c, n in added.items()])


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], span: tuple[str, str], right_span: tuple[str, str] | None = None, width: int = 30 * 86_400, prefix: str = "right_") -> DataFrame:
    """All pairs of a left and a right row of one key whose closed intervals share a moment; right columns bear `prefix`.

    An interval stands in every bin of `width` seconds that it touches, and a pair is made in the first bin that both touch
    alone, so nothing is made twice and only neighbours in time are compared.  An interval without an end lasts to the end of all that is
    known; one without a beginning, or that ends before it begins, overlaps nothing.  Keys are compared null-safe.
    """
    right_span = right_span or span
    start, end, first, bin_ = "_start", "_end", "_first", "_bin"

    def timed(df: DataFrame, own: tuple[str, str]) -> DataFrame:
        packed = df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], _seconds(own[0]).alias(start), _seconds(own[1]).alias(end), F.struct(*df.columns).alias("_row"))
        return packed.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))

    a, b = timed(left, span), timed(right, right_span)
    # One number: no interval has to be followed beyond the last moment at which another begins or ends.
    last = a.select(start, end).unionByName(b.select(start, end)).agg(F.max(F.greatest(start, end))).first()[0] or 0

    def binned(df: DataFrame, name: str) -> DataFrame:
        one = F.floor(F.col(start) / width)
        many = F.sequence(one, F.floor(F.coalesce(F.col(end), F.lit(last)) / width))
        return df.withColumn(first, one).withColumn(bin_, F.explode(many)).alias(name)

    same = reduce(Column.__and__, [F.col(f"a._key{i}").eqNullSafe(F.col(f"b._key{i}")) for i in range(len(keys))], F.col("a._bin") == F.col("b._bin"))
    meet = (F.col("a._start") <= F.coalesce("b._end", F.lit(last))) & (F.col("b._start") <= F.coalesce("a._end", F.lit(last)))
    pairs = binned(a, "a").join(binned(b, "b"), same & meet & (F.col("a._bin") == F.greatest("a._first", "b._first")))
    return pairs.select("a._row.*", *[F.col(f"b._row.{c}").alias(f"{prefix}{c}") for c in right.columns])
