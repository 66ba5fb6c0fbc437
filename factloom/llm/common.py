"""What the training-data operators share: table access, lineage cuts, code shipping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Code points that one in-memory slice of texts may hold (a single longer text is a slice of its own).
SLICE_CHARS = 500_000

#: Rows of texts that a Python worker holds at once, and Spark's setting for it, which Spark reads as late as a frame is run.
MAX_BATCH_ROWS, BATCH_ROWS = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Tables that stored() has written, and the batch settings that ship() found.
_stored: list[str] = []
_batch_rows: dict[int, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each Spark context, and bound the rows they get at once.

    The bound holds in this session until release().
    """
    sc = spark.sparkContext
    if int(now := spark.conf.get(BATCH_ROWS)) > MAX_BATCH_ROWS:
        _batch_rows.setdefault(id(spark._jsparkSession), now)
        spark.conf.set(BATCH_ROWS, str(MAX_BATCH_ROWS))
    if getattr(sc, "_factloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(root)
    # The driver alone reads this folder: addPyFile() copies the archive to whoever needs it.
    path = os.path.join(tempfile.mkdtemp(), "factloom_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    sc._factloom_shipped = True


class NoSharedFolder(Exception):
    def __init__(self):
        super().__init__("set spark.checkpoint.dir to a folder that driver and executors share")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; own one only where all run on this machine."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found is None and not sc.master.startswith("local"):
        raise NoSharedFolder
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="factloom-checkpoint-"))
    return found or sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder; its later readers no longer depend on any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As checkpointed(), as a compressed Parquet table in the shared folder."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/factloom-{uuid.uuid4().hex}"
    _stored.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Delete the tables that stored() has written in this process, once their readers are done; returns how many."""
    n = len(_stored)
    while _stored:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def release(spark: SparkSession) -> int:
    """Once all results are written: drop_stored(), and the session's own batch size again."""
    if before := _batch_rows.pop(id(spark._jsparkSession), None):
        spark.conf.set(BATCH_ROWS, before)
    return drop_stored(spark)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_CHARS):
    """Yield (from row, to row, texts) so that each slice holds few code points; a null text is empty."""
    texts, first, size = [], 0, 0
    for i, text in enumerate(batch.column(batch.schema.get_field_index(column))):
        text = text.as_py() or ""
        if texts and size + len(text) > limit:
            yield first, i, texts
            texts, first, size = [], i, 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, first + len(texts), texts


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


