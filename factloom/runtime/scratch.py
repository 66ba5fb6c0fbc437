"""A fresh folder that driver and executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .files import Store

#: Folders handed out in this process and not yet dropped.
_made: list[str] = []


class NoSharedFolder(Exception):
    def __init__(self):
        super().__init__("set spark.checkpoint.dir to a folder that driver and executors share")


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; below a local one only where that is unset and all runs on this machine, as in tests."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not sc.master.startswith("local["):
        raise NoSharedFolder
    _made.append(f"{(base or tempfile.mkdtemp(prefix='factloom-')).rstrip('/')}/scratch-{uuid.uuid4().hex}")
    return _made[-1]


def drop_scratch(spark: SparkSession) -> int:
    """Delete the folders that scratch() gave, once what was read from them is written elsewhere; returns how many."""
    n = len(_made)
    while _made:
        Store(spark).delete(_made.pop())
    return n


@contextlib.contextmanager
def scratched(spark: SparkSession) -> Iterator[str]:
    """A folder for the time of a block."""
    folder = scratch(spark)
    try:
        yield folder
    finally:
        _made.remove(folder)
        Store(spark).delete(folder)
