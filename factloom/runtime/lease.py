"""One run at a time over a warehouse, by leases that are created where there is none."""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .files import Store

#: Seconds after which a lease that nobody gave back no longer holds: longer than any run.
HOLDS = 12 * 3600


class Busy(Exception):
    def __init__(self, holder: str):
        super().__init__(f"another run holds the warehouse: {holder}")


@contextlib.contextmanager
def held(spark: SparkSession, root: str, holder: str, seconds: float = HOLDS, now=time.time) -> Iterator[int]:
    """Hold the warehouse for a block; Busy at once if another run does.

    Leases are numbered files.  The last one holds until it is given back or has run out; then the next number may be created,
    and of two runs that try one wins.
    """
    store, folder = Store(spark), f"{root.rstrip('/')}/_leases"
    names = store.names(folder)
    last = max((int(n[:8]) for n in names if n.endswith(".json")), default=0)
    if last and f"{last:08d}.back" not in names:
        lease = json.loads(store.read(f"{folder}/{last:08d}.json"))
        if lease["until"] > now():
            raise Busy(lease["holder"])
    number = last + 1
    if not store.create(f"{folder}/{number:08d}.json", json.dumps({"holder": holder, "until": now() + seconds, "id": uuid.uuid4().hex}).encode()):
        raise Busy(f"a run that began at the same time as {holder}")
    try:
        yield number
    finally:
        store.write(f"{folder}/{number:08d}.back", b"")
        # The last lease alone decides; older ones go.
        for n in names:
            store.delete(f"{folder}/{n}")
