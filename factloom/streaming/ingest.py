"""Incremental ingest: new files once, all that are there, then stop."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import DAY, SnapshotTable
from ..runtime.files import Store
from ..sources import landing


def read_stream(spark: SparkSession, root: str, name: str, max_files: int | None = None) -> DataFrame:
    """Envelopes of a landing folder as a stream, rescued like a batch."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = reader.format("text").load(landing.landing_path(root, name)).select("value", F.col("_metadata.file_path").alias("_source_file"))
    return landing.parse_envelopes(lines)


def _append(table: SnapshotTable, name: str, envelopes: DataFrame, batch_id: str, ingest_ts: str | None, supported, **more) -> dict:
    """Append envelopes; versions are checked on what was written, in the same pass, before it is published.

    Each day's rows are parts of their own, so that a run over one day opens no other.
    """
    rows = landing.PROJECTIONS[name](landing.with_metadata(envelopes, batch_id=batch_id, ingest_ts=ingest_ts), landing.MALFORMED)
    refused = F.col(landing.MALFORMED).isNull() & ~F.coalesce(F.col("_envelope_version").isin(*supported), F.lit(False))

    def accept(metrics: dict, staged: DataFrame) -> None:
        if metrics["refused"]:
            others = staged.where(~F.col("_envelope_version").isin(*supported)).select("_envelope_version").distinct().limit(5).collect()
            raise ValueError(f"envelope versions {sorted(r[0] for r in others) or [None]} of {metrics['refused']} rows are not among {list(supported)}; nothing was ingested")

    return table.append(rows.withColumn(DAY, F.date_format("logical_date", "yyyy-MM-dd")), {"rescued": landing.rescued_rows(rows), "refused": F.count_if(refused)}, accept, **more)


def ingest_stream(spark: SparkSession, root: str, name: str, table: SnapshotTable, checkpoint_root: str, batch_id: str = "unknown", ingest_ts: str | None = None, supported=landing.SUPPORTED_VERSIONS) -> dict[str, int]:
    """Append all new files to a bronze table in one or more micro-batches, then stop; returns row and rescue counts.

    Files are remembered by the query's checkpoint.  A micro-batch is appended once: each manifest has the last batch of each
    query, by its checkpoint's own id, and a batch that is run again after a crash finds itself there.  A batch is read once;
    an unsupported envelope version in it fails the query, and nothing of the batch is published.
    """
    totals, checkpoint, store = {"rows": 0, "rescued": 0}, landing.checkpoint_path(checkpoint_root, name), Store(spark)

    def write(batch: DataFrame, number: int) -> None:
        query = json.loads(store.read(f"{checkpoint}/metadata"))["id"]
        m = _append(table, name, batch, batch_id, ingest_ts, supported, batch=(query, number))
        for k in totals:
            totals[k] += m["metrics"][k]

    query = read_stream(spark, root, name).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return totals


def ingest_batch(spark: SparkSession, root: str, name: str, table: SnapshotTable, ledger_root: str, logical_date: str | None = None, batch_id: str = "unknown", ingest_ts: str | None = None, supported=landing.SUPPORTED_VERSIONS) -> dict[str, int]:
    """As ingest_stream(), by a ledger of files.  No new file, no write.

    The ledger notes a batch and its files before the append and that it is done after it.  A run that finds a batch that was not
    finished takes it up with the same files and number, and the manifest says whether it was appended: once, whatever
    crashes and whoever else runs.
    """
    totals = {"rows": 0, "rescued": 0}
    while not (batch := landing.read_landing_batch(spark, root, name, ledger_root, logical_date)).is_empty:
        if not batch.begin():
            continue
        metrics = _append(table, name, batch.frame, batch_id, ingest_ts, supported, batch=(f"{name}/{batch.place}", batch.number))["metrics"]
        batch.commit()
        for k in totals:
            totals[k] += metrics[k]
        if not batch.resumed:
            break
    return totals
