"""Versioned Parquet tables: write, validate, then publish by creating the next version's manifest.

A table is a folder with data folders that are never changed, a manifest for each version that names its data folders, and a
pointer to a late version, from which readers go on to the last.  A failed write or validation makes no manifest, so there
is nothing to roll back.  A manifest is created only where there is none: of two writers of one version one wins; the other
appends to what the first has left, or fails with a conflict where it has replaced rows that it read before.

A data folder is a part.  Rows are dealt to parts by what readers prune by: a tag, a bucket of their key, a day.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..runtime.files import Store
from .frame import align


class MissingTable(Exception):
    def __init__(self, missing: list[str]):
        self.missing = missing
        super().__init__(f"tables not created: {', '.join(missing)}; create them with SnapshotTable.create")


class CommitConflict(Exception):
    def __init__(self, table: str, version: int):
        super().__init__(f"{table}: another writer has made version {version}; read the table and try again")


#: Columns that tell a row's part while rows are written: tag, bucket, and day as text.
TAG, BUCKET, DAY = "_tag", "_bucket", "_day"
_DEALT = {TAG: ("tag", StringType(), str), BUCKET: ("bucket", IntegerType(), int), DAY: ("day", StringType(), str)}
_NULL = "__HIVE_DEFAULT_PARTITION__"
#: Of the Parquet files: half of a table may be digests as text, which only an entropy coder makes smaller.
CODEC = "zstd"
#: Bytes that a bucket of a merged table should hold.
BUCKET_BYTES = 256 << 20


def buckets_for(size: int) -> int:
    """Buckets for a table of so many bytes: a power of two, so that a larger number only splits them."""
    return 1 << max(0, -(-size // BUCKET_BYTES) - 1).bit_length()


def bucket_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name, self.path = spark, name, f"{root.rstrip('/')}/{name}"
        self.store = Store(spark)

    def _pointer(self) -> str:
        return f"{self.path}/_current.json"

    def exists(self) -> bool:
        return self.store.exists(self._pointer())

    def create(self, schema: StructType, buckets: int | None = None) -> SnapshotTable:
        """Version 0, without rows; a table that is there stays as it is.  Merges deal rows to so many buckets."""
        if not self.exists():
            try:
                self._publish({"version": 0, "operation": "create", "schema": schema.jsonValue(), "parts": [], "metrics": {}} | ({"buckets": buckets} if buckets else {}))
            except CommitConflict:
                # Another writer has made it, or a crash came between this manifest and the pointer.
                self._point(self.version())
        return self

    def _publish(self, manifest: dict) -> dict:
        if not self.store.create(self._manifest_path(manifest["version"]), json.dumps(manifest, sort_keys=True).encode()):
            raise CommitConflict(self.name, manifest["version"])
        # The pointer only saves readers the way: the manifest is the commit.
        self._point(manifest["version"])
        return manifest

    def _point(self, version: int) -> None:
        self.store.write(self._pointer(), json.dumps({"version": version}).encode())

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/_manifests/{version:08d}.json"

    def version(self) -> int | None:
        """Current version; None if the table is not there.

        The pointer may lag behind other writers, and may even name a version that vacuum() took; then manifests are listed.
        """
        version = json.loads(self.store.read(self._pointer()))["version"] if self.exists() else None
        if version is None or not self.store.exists(self._manifest_path(version)):
            found = [int(n.split(".")[0]) for n in self.store.names(f"{self.path}/_manifests") if n.endswith(".json")]
            return max(found, default=None)
        while self.store.exists(self._manifest_path(version + 1)):
            version += 1
        return version

    def manifest(self, version: int | None = None) -> dict:
        if version is None and (version := self.version()) is None:
            raise MissingTable([self.name])
        return json.loads(self.store.read(self._manifest_path(version)))

    def history(self) -> list[dict]:
        """Manifests up to the current version, newest first; those that vacuum() took are not there."""
        found = (json.loads(self.store.read(p)) for p, _ in self.store.list(f"{self.path}/_manifests") if p.endswith(".json"))
        return sorted(found, key=lambda m: -m["version"])

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(self.manifest()["schema"])

    def read(self, version: int | None = None, tag: str | None = None, days: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version, the current one by default; with tag or days, of the parts that bear it or may hold them."""
        m, some = self.manifest(version), None if days is None else set(days)
        held = lambda p: (tag is None or p.get("tag") == tag) and (some is None or "day" not in p or p["day"] in some)
        return self.read_parts([p for p in m["parts"] if held(p)], m)

    def read_parts(self, parts: list[dict], manifest: dict | None = None) -> DataFrame:
        schema = StructType.fromJson((manifest or self.manifest())["schema"])
        paths = [f"{self.path}/{p['path']}" for p in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, tag: str, counters: dict | None, schema: StructType, dealt: bool = False) -> tuple[list[dict], dict]:
        """Parts written from df in one pass, one for each value of the columns TAG, BUCKET and DAY that it has, and what was counted."""
        top, seen, by = f"data/{uuid.uuid4().hex}", Observation(), [c for c in _DEALT if c in df.columns]
        # Rows of a part come together, so that it is written as few files; large parts are split by size.
        rows = df.hint("rebalance", *[F.col(c) for c in by]) if by and not dealt else df
        observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[e.alias(k) for k, e in (counters or {}).items()])
        out = align(observed, StructType([*schema.fields, *[StructField(c, _DEALT[c][1]) for c in by]])).write.option("compression", CODEC)
        (out.partitionBy(*by) if by else out).parquet(f"{self.path}/{top}")
        folders = [top]
        for c in by:
            folders = [f"{f}/{n}" for f in folders for n in self.store.names(f"{self.path}/{f}") if n.startswith(f"{c}=")]

        def part(folder: str) -> dict:
            values = dict(unquote(x).split("=", 1) for x in folder.split("/")[2:])
            return {"path": folder, "tag": tag} | {_DEALT[c][0]: None if v == _NULL else _DEALT[c][2](v) for c, v in values.items()}

        return [part(f) for f in folders], dict(seen.get)

    def commit(self, new: dict[str, DataFrame], keep: Callable[[dict], bool], operation: str, counters: dict | None = None, validate: Callable[[DataFrame], object] | None = None, rebase: bool = False, accept: Callable[[dict, DataFrame], object] | None = None, base: dict | None = None, batch: tuple[str, int] | None = None, dealt: bool = False, **more) -> dict:
        """Publish a version of the parts to keep and of new parts by tag.

        Counters, a name and an aggregate each, are taken in the same pass as the write.  validate gets the rows of the new
        version, accept the counts and the new rows; either may raise, and then nothing is published.  `base` is the
        manifest whose rows were read to make the new ones; where another version came after it the commit fails, but with
        `rebase` is made upon that.  `batch` names a source and the number of its batch: the manifest keeps the last number of
        every source, and a batch whose number is there already is not written again, also where another
        writer has published it meanwhile.  With `dealt` rows of a part lie together already.  Further fields go into the manifest.
        """
        base = base or self.manifest()
        schema, metrics, staged = StructType.fromJson(base["schema"]), {}, []
        done = lambda m: batch is not None and m.get("batches", {}).get(batch[0], -1) >= batch[1]
        if done(base):
            return base | {"metrics": {"rows": 0, **dict.fromkeys(counters or {}, 0)}}
        try:
            for tag, df in new.items():
                parts, got = self._write(df, tag, counters, schema, dealt)
                staged += parts
                for k, v in got.items():
                    metrics[k] = metrics.get(k, 0) + (v or 0)
            if accept is not None:
                accept(metrics, self.read_parts(staged, base))
            if validate is not None:
                validate(self.read_parts([p for p in base["parts"] if keep(p)] + staged, base))
            while True:
                fields = {"version": base["version"] + 1, "operation": operation, "parts": [p for p in base["parts"] if keep(p)] + staged, "metrics": metrics}
                if batch is not None:
                    fields["batches"] = base.get("batches", {}) | {batch[0]: batch[1]}
                try:
                    return self._publish(base | fields | more)
                except CommitConflict:
                    if not rebase:
                        raise
                    base = self.manifest()
                    if done(base):
                        self._drop(staged)
                        return base | {"metrics": {"rows": 0, **dict.fromkeys(counters or {}, 0)}}
        except Exception:
            self._drop(staged)
            raise

    def _drop(self, parts: list[dict]) -> None:
        for p in parts:
            self.store.delete(f"{self.path}/{p['path']}")

    def append(self, df: DataFrame, counters: dict | None = None, accept=None, **more) -> dict:
        return self.commit({"rows": df}, lambda _: True, "append", counters, rebase=True, accept=accept, **more)

    def overwrite(self, df: DataFrame, operation: str = "overwrite", counters: dict | None = None, validate=None, base: dict | None = None, **more) -> dict:
        """Replace all rows; the schema stays."""
        return self.commit({"rows": df}, lambda _: False, operation, counters, validate, base=base, **more)

    def restore(self, version: int) -> dict:
        """Publish an older version's parts as a new version."""
        old = self.manifest(version)
        return self._publish(old | {"version": self.version() + 1, "operation": "restore", "metrics": {"restored_version": version}})

    def compact(self, most: int = 8) -> dict | None:
        """Rewrite the parts of one tag, bucket and day as one where there are more than `most`; None if there are none such.

        Rows do not change.  Appends that come meanwhile stay; where another writer replaced one of the parts, this fails with a
        conflict and nothing is lost.
        """
        base, groups = self.manifest(), defaultdict(list)
        place = lambda p: tuple((k, p[k]) for k in ("tag", "bucket", "day") if k in p)
        for p in base["parts"]:
            groups[place(p)].append(p)
        many = {k: ps for k, ps in groups.items() if len(ps) > most}
        if not many:
            return None
        old, new = {p["path"] for ps in many.values() for p in ps}, []
        schema = StructType.fromJson(base["schema"])
        try:
            for k, ps in many.items():
                parts, _ = self._write(self.read_parts(ps, base).coalesce(max(1, len(ps) // most)), dict(k)["tag"], None, schema)
                new += [p | dict(k) for p in parts]
            while True:
                if not old <= {p["path"] for p in base["parts"]}:
                    raise CommitConflict(self.name, base["version"])
                try:
                    return self._publish(base | {"version": base["version"] + 1, "operation": "compact", "parts": [p for p in base["parts"] if p["path"] not in old] + new, "metrics": {"parts_before": len(old), "parts_after": len(new)}})
                except CommitConflict:
                    base = self.manifest()
        except Exception:
            self._drop(new)
            raise

    def vacuum(self, keep: int) -> int:
        """Drop manifests older than the newest `keep` versions and data that none of the rest names; returns folders dropped.

        The pointer goes on first, so that no reader starts at a version that is gone.
        """
        if keep < 1:
            raise ValueError("at least one version has to stay")
        history = self.history()
        if not history:
            return 0
        self._point(history[0]["version"])
        stay = {p["path"] for m in history[:keep] for p in m["parts"]}
        gone = {p["path"] for m in history[keep:] for p in m["parts"]} - stay
        for m in reversed(history[keep:]):
            self.store.delete(self._manifest_path(m["version"]))
        for path in gone:
            self.store.delete(f"{self.path}/{path}")
        return len(gone)

    def changed_parts(self, since: int, until: int | None = None) -> tuple[list[dict], list[dict]]:
        """Parts that a version has lost and gained since another; all others are the same files in both."""
        old, new = self.manifest(since), self.manifest(until)
        before, after = ({p["path"]: p for p in m["parts"]} for m in (old, new))
        return [p for k, p in before.items() if k not in after], [p for k, p in after.items() if k not in before]

    def changes(self, since: int, until: int | None = None, ignore: Iterable[str] = ()) -> DataFrame:
        """Rows that a version has lost (_change -1) and gained (1) since another, with how often (_times).

        Only parts that differ are read, both in one pass; rows that are in both, as often, cancel out.  Columns to
        `ignore`, such as times of processing, are left out and make no change.  Rows meet by all their columns, NULL
        equals NULL, and maps are compared as JSON.
        """
        gone, come = self.changed_parts(since, until)
        m = self.manifest(until)
        both = self.read_parts(gone, m).withColumn("_change", F.lit(-1)).unionByName(self.read_parts(come, m).withColumn("_change", F.lit(1)))
        names = [c for c in both.columns if c != "_change" and c not in set(ignore)]
        maps = {n for n, kind in both.dtypes if "map<" in kind}
        keys = [F.to_json(c).alias(c) if c in maps else F.col(c) for c in names]
        net = both.groupBy(*keys).agg(F.sum("_change").alias("_net")).where("_net <> 0")
        return net.select(*names, F.signum("_net").cast("int").alias("_change"), F.abs("_net").alias("_times"))


def require_tables(spark: SparkSession, root: str, names: list[str]) -> None:
    """Raise once, naming every table that is not there."""
    if missing := [n for n in names if not SnapshotTable(spark, root, n).exists()]:
        raise MissingTable(missing)
