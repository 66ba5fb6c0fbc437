"""Marts as single Parquet objects with a manifest that names their content."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..runtime.files import Store
from .frame import align, stamp
from .tables import SnapshotTable

EXPORTED = ("restatement_event", "financials_current", "filing_activity_daily", "company_profile")


@dataclass(frozen=True)
class Exported:
    table: str
    path: str
    row_count: int
    bytes: int
    sha256: str


def write_mart(table: SnapshotTable, df: DataFrame, run_id: str, source_version: int | None, generated_at: str | None = None, inputs: dict[str, int | None] | None = None) -> dict:
    """Overwrite a mart with df, stamped; its schema stays.  The manifest names the version of every input table."""
    return table.overwrite(align(stamp(df, run_id, source_version, generated_at), table.schema), inputs=inputs or {})["metrics"]


def export_table(spark: SparkSession, df: DataFrame, name: str, root: str) -> Exported:
    """df as <root>/v1/<name>/data.parquet: staged as one part, then moved into place.

    One task writes, as one object is asked for; what makes the rows runs in as many as it likes.
    """
    store, staging = Store(spark), f"{root.rstrip('/')}/_staging/{name}"
    target = f"{root.rstrip('/')}/v1/{name}/data.parquet"
    store.delete(staging)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).repartition(1).write.parquet(staging)
    parts = [(p, n) for p, n in store.list(staging) if p.endswith(".parquet")]
    if len(parts) != 1:
        raise RuntimeError(f"{name}: expected one part, found {len(parts)}")
    store.move(parts[0][0], target)
    store.delete(staging)
    return Exported(name, f"v1/{name}/data.parquet", seen.get["n"], parts[0][1], store.digest(target))


def build_manifest(exported: list[Exported], max_filed_date, run_id: str) -> str:
    """JSON with sorted keys; the tables come in a fixed order; freshness is the source's, not the clock's."""
    order = {t: k for k, t in enumerate(EXPORTED)}
    tables = [asdict(e) for e in sorted(exported, key=lambda e: (order.get(e.table, len(order)), e.table))]
    return json.dumps({"gold_max_filed_date": None if max_filed_date is None else str(max_filed_date), "run_id": run_id, "tables": tables}, sort_keys=True)


def export_all(spark: SparkSession, root: str, target: str, run_id: str) -> list[Exported]:
    exported = [export_table(spark, SnapshotTable(spark, root, f"gold.{t}").read(), t, target) for t in EXPORTED]
    newest = SnapshotTable(spark, root, "silver.filing").read().agg(F.max("filed_date")).first()[0]
    Store(spark).write(f"{target.rstrip('/')}/v1/manifest.json", build_manifest(exported, newest, run_id).encode())
    return exported


def verify_export(spark: SparkSession, target: str) -> dict:
    """The manifest, once every expected table is there with the content it names."""
    store, base = Store(spark), f"{target.rstrip('/')}/"
    if not store.exists(f"{base}v1/manifest.json"):
        raise FileNotFoundError("the export has no manifest")
    manifest = json.loads(store.read(f"{base}v1/manifest.json"))
    found = {t["table"]: t for t in manifest["tables"]}
    if missing := [t for t in EXPORTED if t not in found or not store.exists(base + found[t]["path"])]:
        raise FileNotFoundError(f"the export lacks {', '.join(missing)}")
    if wrong := [t for t in EXPORTED if store.digest(base + found[t]["path"]) != found[t]["sha256"]]:
        raise ValueError(f"content differs from the manifest: {', '.join(wrong)}")
    return manifest
