"""Marts kept by the changes of their source.

Two ways.  update_by_bucket() keeps marts whose rows come each from one fact: source and mart lie in the same buckets by that fact, and a
bucket of the mart is made anew where the source's bucket differs, no matter how.  update_activity() keeps counts across buckets by
signed deltas of rows, added to counts that can be taken back: a support table has, for each group and entity, how many rows and how many marked rows there are.  Counts add up and can be taken back, and an
entity is in a group while its count is not nought, so that distinct entities are exact too.  Support and mart lie in the
same buckets by group; a run reads and writes those that a change touches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .frame import align, stamp
from .tables import BUCKET, SnapshotTable, bucket_of
from .versioning import BUCKETS, FIRST_SEEN, LAST_SEEN

#: Columns of a source that are about its processing, and change no mart.
PROCESSING = (FIRST_SEEN, LAST_SEEN, "_ingest_batch_id", "_source_file")


def support_schema(source: StructType, group: list[str], entity: str) -> StructType:
    return StructType([source[c] for c in (*group, entity)]).add("rows", "long").add("marked", "long")


def _count(rows: DataFrame, group: list[str], entity: str, marked: Column, times: Column) -> DataFrame:
    return rows.groupBy(*group, entity).agg(F.sum(times).cast("long").alias("rows"), F.coalesce(F.sum(F.when(marked, times)), F.lit(0)).cast("long").alias("marked"))


def update_activity(source: SnapshotTable, support: SnapshotTable, mart: SnapshotTable, run_id: str, group: tuple[str, str] = ("filed_date", "base_form_type"), entity: str = "cik", marked: str = "is_amendment", where: str | None = "is_current", generated_at: str | None = None, inputs: dict[str, int | None] | None = None) -> dict[str, int]:
    """Bring counts by group up to the source's version; the mart equals a rebuild of marts.daily_activity().

    The support's manifest says which version it stands at; the changes since then are applied once.  A support or source
    without that version (a first run, or after vacuum()) is built from all rows.  If a run ends between support and mart, the next one makes
    the mart anew from the support.  `where` chooses the source's rows that count.
    """
    keys, until, base = list(group), source.version(), support.manifest()
    since = base.get("source_version")
    n = base.get("buckets") or BUCKETS
    chosen = lambda df: df.where(where) if where else df
    if since is not None and source.store.exists(source._manifest_path(since)):
        changed = chosen(source.changes(since, until, ignore=PROCESSING)) if since != until else None
        delta = None if changed is None else _count(changed, keys, entity, F.col(marked), F.col("_change") * F.col("_times"))
        rebuilt = False
    else:
        delta, rebuilt = _count(chosen(source.read(until)), keys, entity, F.col(marked), F.lit(1)), True
    hit: set[int] = set()
    if delta is not None:
        staged = f"{support.path}/_staged/{until}-{run_id}"
        delta.withColumn(BUCKET, bucket_of(keys, n)).where("rows <> 0 or marked <> 0").write.mode("overwrite").parquet(staged)
        try:
            delta = source.spark.read.schema(StructType([*delta.schema.fields, StructField(BUCKET, IntegerType())])).parquet(staged)
            hit = {r[0] for r in delta.select(BUCKET).distinct().collect()}
            old = support.read_parts([] if rebuilt else [p for p in base["parts"] if p["bucket"] in hit], base)
            new = old.unionByName(delta.drop(BUCKET)).groupBy(*keys, entity).agg(F.sum("rows").alias("rows"), F.sum("marked").alias("marked")).where("rows <> 0")
            base = support.commit({"rows": new.withColumn(BUCKET, bucket_of(keys, n))}, lambda p: not rebuilt and p["bucket"] not in hit, "delta", base=base, source_version=until, buckets=n)
        finally:
            source.store.delete(staged)
    made = mart.manifest()
    if made.get("support_version") == base["version"]:
        return {"buckets_touched": 0, "rebuilt": int(rebuilt)}
    # The buckets of this change alone, if the mart stands at the support's version before it.
    partly = delta is not None and not rebuilt and made.get("support_version") == base["version"] - 1 and all("bucket" in p for p in made["parts"])
    rows = support.read_parts([p for p in base["parts"] if not partly or p["bucket"] in hit], base)
    counts = rows.groupBy(*keys).agg(F.sum("rows").cast("int").alias("filing_count"), F.sum("marked").cast("int").alias("amendment_count"), F.count(entity).cast("int").alias("distinct_cik_count"))
    out = align(stamp(counts, run_id, until, generated_at), mart.schema).withColumn(BUCKET, bucket_of(keys, n))
    mart.commit({"rows": out}, lambda p: partly and p["bucket"] not in hit, "delta", base=made, support_version=base["version"], inputs=inputs or {}, buckets=n)
    return {"buckets_touched": len(hit), "rebuilt": int(rebuilt)}


def changed_buckets(table: SnapshotTable, since: int | None, until: int) -> set[int] | None:
    """Buckets whose files differ between two versions; None where that cannot be told.

    It cannot where there is no earlier version, vacuum() took it, rows lie in no buckets yet, or in another number of them.
    """
    if since is None or not table.store.exists(table._manifest_path(since)):
        return None
    n = {table.manifest(v).get("buckets") for v in (since, until)}
    differ = [p for parts in table.changed_parts(since, until) for p in parts]
    if len(n) > 1 or None in n or any("bucket" not in p for p in differ):
        return None
    return {p["bucket"] for p in differ}


def in_buckets(table: SnapshotTable, buckets: Iterable[int] | None, version: int | None = None) -> DataFrame:
    """Rows of some buckets of a version, of all for None; other buckets' files are not opened."""
    m, some = table.manifest(version), None if buckets is None else set(buckets)
    return table.read_parts([p for p in m["parts"] if some is None or p.get("bucket", -1) in some], m)


def renamed(table: SnapshotTable, since: int | None, until: int, entity: str, columns: list[str], where: str | None = "is_current") -> DataFrame | None:
    """Entities whose columns differ between two versions, those that came or went among them; None where the earlier version is gone."""
    if since is None or not table.store.exists(table._manifest_path(since)):
        return None
    c = table.changes(since, until, ignore=PROCESSING)
    net = (c.where(where) if where else c).groupBy(entity, *columns).agg(F.sum(F.col("_change") * F.col("_times")).alias("_net"))
    return net.where("_net <> 0").select(entity).distinct()


def update_by_bucket(source: SnapshotTable, mart: SnapshotTable, build: Callable[[DataFrame, set[int] | None], DataFrame], key: list[Column | str], run_id: str, names: SnapshotTable | None = None, entity: str = "cik", name_columns: tuple[str, ...] = ("company_name",), names_where: str | None = "is_current", inputs: dict[str, int | None] | None = None, generated_at: str | None = None) -> dict[str, int]:
    """Bring a mart up to its source's version, bucket by bucket; it equals a rebuild.

    `key` is what the source's rows are dealt by, told by columns that the mart has as well.  build(rows, buckets) makes mart rows from
    all source rows of the buckets (None: of all).  `names` has columns that the mart takes over by entity: where they change, the mart's
    rows of the entity are looked up, by key columns alone, and their buckets are made anew too.  The mart's manifest names the versions that it
    stands at, `inputs` further ones; where they are gone, or buckets do not match, all is built.  A row is stamped with the
    version that it was last made from.  Another writer of the mart meanwhile makes this fail with a conflict.
    """
    until, made = source.version(), mart.manifest()
    now, before = source.manifest(until), made.get("inputs", {})
    n = now.get("buckets") or BUCKETS
    hit = changed_buckets(source, before.get(source.name), until)
    if made.get("buckets") != n or any("bucket" not in p for p in made["parts"]):
        hit = None
    stand = {source.name: until} | (inputs or {})
    if names is not None:
        stand = {source.name: until, names.name: names.version()} | (inputs or {})
        since = before.get(names.name)
        if hit is not None and since != stand[names.name]:
            others = renamed(names, since, stand[names.name], entity, list(name_columns), names_where)
            rest = [p for p in made["parts"] if p["bucket"] not in hit]
            if others is None:
                hit = None
            elif rest:
                found = mart.read_parts(rest, made).join(others, entity, "left_semi").select(bucket_of(key, n).alias("b")).distinct()
                # No more numbers than there are buckets.
                hit = hit | {r["b"] for r in found.collect()}
    if hit is not None and stand == before:
        return {"buckets_touched": 0, "rebuilt": 0, "rows": 0}
    parts = [p for p in now["parts"] if hit is None or p["bucket"] in hit]
    new = {}
    if parts and hit != set():
        rows = align(stamp(build(source.read_parts(parts, now), hit), run_id, until, generated_at), mart.schema)
        new = {"rows": rows.withColumn(BUCKET, bucket_of(key, n))}
    got = mart.commit(new, lambda p: hit is not None and p["bucket"] not in hit, "by_bucket", base=made, inputs=stand, buckets=n)["metrics"]
    return {"buckets_touched": n if hit is None else len(hit), "rebuilt": int(hit is None), "rows": got.get("rows", 0)}
