"""Merges without a merge statement: SCD-1, SCD-2, assertion order, invariants, point-in-time lookup.

Each merge brings old and new rows of a key together, NULL keys too, and yields the new state; tables publish it as their next version.  A table's
rows lie in buckets by a hash of their key, and a merge reads and writes the buckets that its source touches.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..functions.keys import hash_diff
from .joins import asof
from .quality import SCD2_CHECKS, SCD2_STEP_CHECKS, require
from .tables import BUCKET, TAG, SnapshotTable, bucket_of

FIRST_SEEN, LAST_SEEN, HASH = "_first_seen_ts", "_last_seen_ts", "_hash_diff"
VERSION_COLUMNS = ["version_number", "valid_from", "valid_to", "is_current", HASH]
#: What a merge did to a row; only while it runs.
OP = "_op"


def counters() -> dict[str, Column]:
    """Aggregates over _op, for the write of a merge."""
    return {op: F.count_if(F.col(OP) == op) for op in ("inserted", "updated", "closed", "unchanged")}


def null_safe(left: str, right: str, keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _now(processing_ts: str | None) -> Column:
    return F.current_timestamp() if processing_ts is None else F.to_timestamp(F.lit(processing_ts))


#: Ranges of places that the rows of a bucket are dealt to while a merge runs, and the column with a row's place.
PLACES, PLACE = 4096, "_place"


def place_of(keys: list[str], n: int) -> Column:
    """Bucket and, within it, a range of keys: rows in the order of places are in the order of buckets."""
    return bucket_of(keys, n) * PLACES + F.pmod(F.hash(*keys), F.lit(PLACES))


def bucket_at() -> Column:
    return F.floor(F.col(PLACE) / PLACES).cast("int")


#: Rows that a task of a merge gets at most, about, and those below which it is not worth a task: what is sorted has to fit in its memory.
TASK_ROWS, LEAST_ROWS = 200_000, 20_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks among which a merge of so many old and new rows is dealt, whatever the session's number of partitions: in proportion to the rows."""
    return max(1, -(-rows // TASK_ROWS), min(spark.sparkContext.defaultParallelism, rows // LEAST_ROWS))


def unsaid(existing: DataFrame, made: dict[str, Callable[[str], Column]]) -> DataFrame:
    """existing without what `made` (column: its value, by the prefix of the columns it is made from) can make again.

    A digest hardly compresses, and so does not travel.  Where a row has another value than would be made, that one stays, in a struct.
    """
    return existing.withColumns({c: F.when(~F.col(c).eqNullSafe(make("")), F.struct(F.col(c).alias("said"))) for c, make in made.items()})


def say(joined: DataFrame, side: str, made: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Rows of meet() with the fields of t that unsaid() left out, or with those that s has not."""
    for c, make in made.items():
        value = make(f"{side}.")
        if side == "t":
            value = F.when(F.col(f"t.{c}").isNotNull(), F.col(f"t.{c}.said")).otherwise(value)
        joined = joined.withColumn(side, F.col(side).withField(c, value))
    return joined


def meet(existing: DataFrame, source: DataFrame, keys: list[str], latest_by: list[str] | None = None, place: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Structs t and s, NULL where there is none: each existing row with the source row of its key, and source rows without one.

    Of source rows with one key dedupe()'s choice counts.  NULL keys meet NULL keys.  Both sides are stacked and dealt once, by
    range of `place` (which the keys must determine; then column PLACE stays; to so many `tasks`, or as many as the session says) or else
    by key, and one sort brings together what meets.
    """
    here, have = existing.schema, source.schema
    shared = [f.name for f in have.fields if f.name in here.names and f.dataType == here[f.name].dataType]
    # Source columns that existing has not, or has in another type, travel beside.
    beside = {c: f"_s{k}" for k, c in enumerate(source.columns) if c not in shared and c not in keys}
    old = existing.select("*", F.lit(1).alias("_old"), *[F.lit(None).cast(have[c].dataType).alias(b) for c, b in beside.items()])
    new = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in shared or f.name in keys else F.lit(None).cast(f.dataType).alias(f.name) for f in here.fields], F.lit(0).alias("_old"), *[F.col(c).alias(b) for c, b in beside.items()])
    rows, by = old.unionByName(new), keys
    if place is not None:
        rows, by = rows.withColumn(PLACE, place).repartitionByRange(*([tasks] if tasks else []), PLACE), [PLACE, *keys]
    at = lambda c: F.col(beside.get(c, c))
    maps = {f.name for f in have.fields if isinstance(f.dataType, MapType)}
    rest = [c for c in source.columns if c not in keys and c not in (latest_by or [])]
    order = [at(c).desc_nulls_last() for c in latest_by or [] if c not in keys] + [(F.to_json(at(c)) if c in maps else at(c)).asc_nulls_last() for c in rest]
    w = Window.partitionBy(*by).orderBy("_old", *order)
    s = F.when(F.col("_old") == 0, F.struct(*[at(c).alias(c) for c in source.columns], F.lit(True).alias("_s")))
    met = rows.withColumns({
        "s": F.first(s).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_nth": F.row_number().over(w),
        "_any_old": F.max("_old").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    t = F.when(F.col("_old") == 1, F.struct(*existing.columns, F.lit(True).alias("_t")))
    kept = met.where("_old = 1 OR (_nth = 1 AND _any_old = 0)")
    return kept.select(t.alias("t"), "s", *([PLACE] if place is not None else []))


def scd1(existing: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, latest_by: list[str] | None = None, processing_ts: str | None = None, place: Column | None = None, tasks: int | None = None) -> DataFrame:
    """existing with source merged in by key, and column _op.

    Of source rows with one key the last in `latest_by` counts.  A matched row takes the source's `update` columns (all but
    the key and _first_seen_ts by default), _last_seen_ts becomes now; an unmatched source row is inserted and is first seen
    now unless it says otherwise; other rows stay.  Columns of source that existing has not are dropped.
    """
    if not keys:
        raise ValueError("a merge needs at least one key column")
    if FIRST_SEEN in (update or []):
        raise ValueError(f"{FIRST_SEEN} is set on insert and never updated")
    have = set(source.columns)
    update = [c for c in existing.columns if c not in keys and c not in (FIRST_SEEN, LAST_SEEN) and c in have] if update is None else update
    now = _now(processing_ts)
    joined = meet(existing, source, keys, latest_by, place, tasks)
    old, new = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()

    def merged(c: str) -> Column:
        given = F.col(f"s.{c}") if c in have else F.lit(None)
        if c == LAST_SEEN:
            value = F.when(new, now).otherwise(F.col(f"t.{c}"))
        elif c == FIRST_SEEN:
            value = F.when(old, F.col(f"t.{c}")).otherwise(F.coalesce(given, now))
        elif c in keys or c in update:
            value = F.when(new, given).otherwise(F.col(f"t.{c}"))
        else:
            value = F.when(old, F.col(f"t.{c}")).otherwise(given)
        return value.cast(existing.schema[c].dataType).alias(c)

    op = F.when(~new, "unchanged").when(old, "updated").otherwise("inserted")
    return joined.select(*[merged(c) for c in existing.columns], op.alias(OP), *([PLACE] if place is not None else []))


def scd2(current: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], logical_date: str, latest_by: list[str] | None = None, processing_ts: str | None = None, closed_versions: DataFrame | None = None, place: Column | None = None, tasks: int | None = None, made: dict[str, Callable[[str], Column]] | None = None) -> DataFrame:
    """Rows that replace `current`, the current rows of a versioned table, and column _op.

    A key whose tracked columns changed has its version closed on the day before logical_date and a new one opened; on the day
    the version was opened it is replaced in place; an older logical_date raises, as history is not rewritten.  A key
    without change is only seen again; one that the source lacks stays.  closed_versions (keys, max_version) says how far
    a key without a current row had come.  `made` names columns that follow from others, as surrogates do from the key, each with
    its value by the prefix of those: like change hashes they are made after rows are dealt, where source lacks them, and only
    where `current` says otherwise do they travel.
    """
    if not keys:
        raise ValueError("a merge needs at least one natural key column")
    date.fromisoformat(logical_date)
    day, now = F.lit(logical_date).cast("date"), _now(processing_ts)
    made = made or {}
    have = {*source.columns, HASH, *made}
    again = {HASH: lambda p: hash_diff(current, tracked, p)} if {HASH, *tracked} <= set(current.columns) else {}
    again |= {c: make for c, make in made.items() if c in current.columns}
    joined = say(meet(unsaid(current, again), source, keys, latest_by, place, tasks), "t", again)
    joined = say(joined, "s", {HASH: lambda p: hash_diff(source, tracked, p)} | {c: make for c, make in made.items() if c not in source.columns})
    if closed_versions is not None:
        joined = joined.join(closed_versions.alias("h"), null_safe("s", "h", keys), "left")
    reached = F.coalesce(F.col("t.version_number"), F.col("h.max_version") if closed_versions is not None else F.lit(None), F.lit(0))
    old, new = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    differs = ~F.col(f"t.{HASH}").eqNullSafe(F.col(f"s.{HASH}"))
    late = F.col("t.valid_from") > day

    def row(op: str, **over: Column) -> Column:
        fields = []
        for c in current.columns:
            base = F.col(f"t.{c}") if op in ("unchanged", "closed", "updated_seen") else F.coalesce(F.col(f"s.{c}") if c in have else F.lit(None), F.lit(None).cast(current.schema[c].dataType))
            fields.append(over.get(c, base).cast(current.schema[c].dataType).alias(c))
        return F.struct(*fields, F.lit("updated" if op == "updated_seen" else op).alias(OP))

    opened = {"valid_from": day, "valid_to": F.lit(None), "is_current": F.lit(True), LAST_SEEN: now}
    inserted = row("inserted", version_number=reached + 1, **{FIRST_SEEN: now}, **opened)
    replaced = row("updated", version_number=F.col("t.version_number"), **{FIRST_SEEN: F.col(f"t.{FIRST_SEEN}") if FIRST_SEEN in current.columns else now}, **opened)
    refused = F.raise_error(F.concat(F.lit(f"{logical_date} is before the current version of "), F.to_json(F.struct(*[F.col(f"t.{k}") for k in keys]))))
    rows = (
        F.when(~new, F.array(row("unchanged")))
        .when(~old, F.array(inserted))
        .when(~differs, F.array(row("updated_seen", **{LAST_SEEN: now})))
        .when(F.when(late, refused.cast("boolean")).otherwise(F.col("t.valid_from") < day), F.array(row("closed", valid_to=F.date_sub(day, 1), is_current=F.lit(False)), inserted))
        .otherwise(F.array(replaced))
    )
    return joined.select(*([PLACE] if place is not None else []), F.inline(rows))


#: Buckets of a table that no merge has written yet; a table keeps its number, so give large ones more.
BUCKETS = 16


def touched(table: SnapshotTable, manifest: dict, source: DataFrame, keys: list[str], buckets: int | None = None) -> tuple[int, set[int] | None]:
    """Number of the table's buckets, and those that hold a key of source; None for all, if rows lie in none yet.

    At most as many numbers as there are buckets come to the driver.
    """
    if not keys:
        raise ValueError("a merge needs at least one key column")
    n = manifest.get("buckets") or buckets or BUCKETS
    if not manifest["parts"]:
        return n, set()
    if any("bucket" not in p for p in manifest["parts"]):
        return n, None
    return n, {r[0] for r in source.select(bucket_of(keys, n).alias("b")).distinct().collect()}


def _in(part: dict, buckets: set[int] | None) -> bool:
    return buckets is None or part["bucket"] in buckets


def merge_scd1(table: SnapshotTable, source: DataFrame, keys: list[str], bucket_by: list[str] | None = None, then=None, operation: str = "merge_scd1", buckets: int | None = None, accept=None, rows: int | None = None, **options) -> dict:
    """scd1() as the table's next version; returns counts of inserted, updated and, in the buckets touched, unchanged rows.

    Rows lie in buckets by `bucket_by`, which the keys must determine (the keys by default).  `then` maps the merged rows of
    whole buckets to what is written.  `rows`, the number of source's rows where it is known, sets the number of tasks.
    """
    manifest, by = table.manifest(), bucket_by or keys
    n, hit = touched(table, manifest, source, by, buckets)
    old = table.read_parts([p for p in manifest["parts"] if _in(p, hit)], manifest)
    merged = scd1(old, source, keys, place=place_of(by, n), tasks=None if rows is None else tasks_for(table.spark, old.count() + rows), **options)
    merged = (then(merged) if then else merged).withColumn(BUCKET, bucket_at())
    return table.commit({"rows": merged}, lambda p: not _in(p, hit), operation, counters(), accept=accept, base=manifest, dealt=True, buckets=n)["metrics"]


def merge_scd2(table: SnapshotTable, source: DataFrame, keys: list[str], tracked: list[str], logical_date: str, validate: bool = True, buckets: int | None = None, rows: int | None = None, **options) -> dict:
    """scd2() as the table's next version, in one write that deals rows to current and closed parts.

    Closed rows stay in the files they are in; of current rows the buckets that source touches are written anew.  What is
    validated is each key's step: its current row and the version that this merge closed, if any.  As closed rows never change,
    a history whose steps are all valid is valid; check_history() looks at the whole of it.  `rows`, the number of source's rows
    where it is known, sets the number of tasks.
    """
    manifest = table.manifest()
    n, hit = touched(table, manifest, source, keys, buckets)
    parts = [p for p in manifest["parts"] if _in(p, hit)]
    # Every key has a current row, unless rows came some other way than by merges.
    current = table.read_parts([p for p in parts if p["tag"] == "current"], manifest)
    others = [p for p in parts if p["tag"] not in ("current", "closed")]
    history = table.read_parts(others, manifest).where("not is_current") if others else None
    if others:
        current = current.unionByName(table.read_parts(others, manifest).where("is_current"))
        options["closed_versions"] = history.groupBy(*keys).agg(F.max("version_number").alias("max_version"))
    tasks = None if rows is None else tasks_for(table.spark, current.count() + rows)
    merged = scd2(current, source, keys, tracked, logical_date, place=place_of(keys, n), tasks=tasks, **options)
    dealt = history is None
    if not dealt:
        merged = merged.unionByName(history.withColumns({OP: F.lit("unchanged"), PLACE: place_of(keys, n)}))
    merged = merged.withColumns({BUCKET: bucket_at(), TAG: F.when(F.col("is_current"), "current").otherwise("closed")})

    def check(_: dict, new: DataFrame) -> None:
        require(scd2_invariants(new, keys), SCD2_STEP_CHECKS)

    stays = lambda p: not _in(p, hit) or p["tag"] == "closed"
    return table.commit({"current": merged}, stays, "merge_scd2", counters(), accept=check if validate else None, base=manifest, dealt=dealt, buckets=n)["metrics"]


def check_history(table: SnapshotTable, keys: list[str], version: int | None = None) -> dict[str, int]:
    """Raise unless every key's whole history is valid: one current row, no overlaps, dense versions, the current one last."""
    return require(scd2_invariants(table.read(version), keys), SCD2_CHECKS)


def rebucket(table: SnapshotTable, keys: list[str], buckets: int) -> dict:
    """Deal all rows to another number of buckets, each tag by itself; a table that has grown needs more of them."""
    if buckets < 1:
        raise ValueError("a table has one bucket at least")
    manifest = table.manifest()
    tags = sorted({p["tag"] for p in manifest["parts"]})
    rows = [table.read_parts([p for p in manifest["parts"] if p["tag"] == t], manifest).withColumns({TAG: F.lit(t), BUCKET: bucket_of(keys, buckets)}) for t in tags]
    new = {"rows": reduce(DataFrame.unionByName, rows)} if rows else {}
    return table.commit(new, lambda _: False, "rebucket", base=manifest, buckets=buckets)


def scd2_invariants(df: DataFrame, keys: list[str]) -> DataFrame:
    """For each key: current, version and overlap counts, and version bounds.

    An overlap is a version that is still valid when the next one begins; the next one is found by a window and not by a
    self-join, so a key costs its number of versions and not the square of it.
    """
    w = Window.partitionBy(*keys).orderBy("valid_from", "version_number")
    nxt = F.lead("valid_from").over(w)
    rows = df.withColumn("_overlaps", F.coalesce(F.coalesce("valid_to", F.lit("9999-12-31").cast("date")) >= nxt, F.lit(False)))
    return rows.groupBy(*keys).agg(
        F.count_if("is_current").alias("current_count"), F.count_if("_overlaps").alias("overlap_count"), F.count("*").alias("version_count"),
        F.min("version_number").alias("min_version"), F.max("version_number").alias("max_version"), F.max(F.when(F.col("is_current"), F.col("version_number"))).alias("current_version"),
    )


def history_from(snapshots: DataFrame, keys: list[str], tracked: list[str], day: str) -> DataFrame:
    """The versions that folding dated snapshots (one row for a key and day) through scd2() would leave, by windows alone."""
    w = Window.partitionBy(*keys).orderBy(day)
    hashed = snapshots.withColumn(HASH, hash_diff(snapshots, tracked))
    changes = hashed.withColumn("_before", F.lag(HASH).over(w)).where(~F.col("_before").eqNullSafe(F.col(HASH))).drop("_before")
    nxt = F.lead(day).over(w)
    return changes.select(*keys, *tracked, HASH, F.row_number().over(w).alias("version_number"), F.col(day).alias("valid_from"), F.date_sub(nxt, 1).alias("valid_to"), nxt.isNull().alias("is_current"))


def point_in_time(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, how: str = "left", width: int | None = None) -> DataFrame:
    """Each fact with the version valid on its day; versions do not overlap, so no fact is repeated.

    The version that began last is found by an as-of join and counts if it has not ended; `width` splits hot keys, as there.
    """
    v, ends = versions.withColumn("_began", F.col("valid_from")), [c for c in versions.columns if c not in keys and c not in facts.columns]
    found = asof(facts, v.select(*keys, *[c for c in v.columns if c not in keys]), keys, at, "_began", width=width, prefix="_v_")
    valid = F.col("_v__began").isNotNull() & (F.col("_v_valid_to").isNull() | (F.col(at).cast("date") <= F.col("_v_valid_to")))
    out = found.where(valid) if how == "inner" else found
    return out.select(*facts.columns, *[F.when(valid, F.col(f"_v_{c}")).alias(c) for c in ends])


def order_assertions(facts: DataFrame, keys: list[str], by: list[str], accession: str = "accession_number") -> DataFrame:
    """assertion_version, superseded_by_accession and is_current_assertion within each fact, oldest first; one window."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in by])
    nxt, newest = F.lead(accession).over(w), F.lead(F.lit(1)).over(w).isNull()
    return facts.withColumns({"assertion_version": F.row_number().over(w), "superseded_by_accession": nxt, "is_current_assertion": newest})


def grain_counts(df: DataFrame, grain: list[str]) -> DataFrame:
    """row_count for each key of the grain; NULLs group together."""
    return df.groupBy(*grain).agg(F.count("*").alias("row_count"))
