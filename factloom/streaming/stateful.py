"""Streams with state that is let go behind a watermark: first arrivals, sessions, and a join of two streams."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.frame import unused
from ..operators.tables import SnapshotTable


def first_arrivals(envelopes: DataFrame, ts: str = "fetched_ts", delay: str = "1 day", content: tuple[str, ...] = ("stream", "resource_id", "content_sha256")) -> DataFrame:
    """Drops envelopes whose content came before within the delay, in whatever micro-batch; older state is let go."""
    timed = envelopes if ts in envelopes.columns else envelopes.withColumn(ts, F.try_to_timestamp("fetched_at"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(content))


def sessions(events: DataFrame, keys: list[str], ts: str, gap: str, delay: str) -> DataFrame:
    """(keys, started, ended, n_events): activity of a key without a pause of `gap`; ended is its last event.

    A late event, up to `delay` behind the newest one, can lengthen a session or join two.  A session is given out once, when
    the watermark has passed its last event by the gap.
    """
    w = F.session_window(ts, gap)
    rows = events.withWatermark(ts, delay).groupBy(*keys, w.alias("w")).agg(F.count("*").alias("n_events"), F.max(ts).alias("ended"))
    return rows.select(*keys, F.col("w.start").alias("started"), "ended", "n_events")


def join_streams(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, within: str, delay: str = "1 day", how: str = "left_outer") -> DataFrame:
    """Left rows with the right rows of their key that come in the time `within` after them; both columns `at` are kept.

    The bounds let state go on both sides: a right row once no left row can still be early enough, a left row once the
    watermark has passed its time by `within`; then an outer join gives it out alone.  Key columns are the left ones.
    """
    a, b = left.withWatermark(at, delay).alias("a"), right.withWatermark(right_at, delay).alias("b")
    return a.join(b, _met(keys, at, right_at, within), how).select(*_both(left, right, keys))


def _met(keys: list[str], at: str, right_at: str, within: str) -> Column:
    on = (F.col(f"b.{right_at}") >= F.col(f"a.{at}")) & (F.col(f"b.{right_at}") <= F.col(f"a.{at}") + F.expr(f"interval {within}"))
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    return on


def _both(left: DataFrame, right: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(f"a.{c}") for c in left.columns] + [F.col(f"b.{c}") for c in right.columns if c not in keys]


#: State on the executors' disks in place of their heaps: one store a partition for both sides of a join, a commit writes what changed.
_STORE = "spark.sql.streaming.stateStore"
ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextlib.contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_to_table(stream: DataFrame, table: SnapshotTable, checkpoint: str, on_disk: bool = False, partitions: int | None = None) -> None:
    """Append all that a stream gives with what has arrived, each micro-batch once; a restart goes on where it ended.

    State lies in the heap unless `on_disk`; large joins need that.  Every partition of the state costs some files a batch, however small;
    `partitions` sets their number, which like the kind of store stays as the checkpoint's first run had it.
    """
    def write(batch: DataFrame, number: int, query: str) -> None:
        table.append(batch, batch=(query, number))

    settings = (ON_DISK if on_disk else {}) | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    _run(stream, write, table, checkpoint, settings)


def _run(stream: DataFrame, write: Callable[[DataFrame, int, str], None], table: SnapshotTable, checkpoint: str, settings: dict[str, str]) -> None:
    def each(batch: DataFrame, number: int) -> None:
        write(batch, number, json.loads(table.store.read(f"{checkpoint}/metadata"))["id"])

    # A query keeps the settings that it was started with.
    with _set(stream.sparkSession, settings):
        query = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()


#: Live rows for which a micro-batch's join gets a task.
TASK_ROWS = 1_000_000


def join_to_table(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, within: str, table: SnapshotTable, checkpoint: str, delay: str = "1 day", how: str = "left_outer") -> None:
    """What join_streams() gives, appended to `table` by run_to_table(), for state that is large: it lies in a table, not in key-value stores.

    A micro-batch adds its rows to the state as they come, each written once, and meets it in one sorted join that is dealt by the number
    of live rows; a store is asked for every row of either side by itself.  Each batch reads all of the live state, so few large
    batches suit it.  The watermark is the earlier one of both sides' latest times less `delay`; a batch drops rows that are not
    after the one it began with, and gives left rows alone that the one it ends with has passed by `within`, or that have no
    time.  Right rows stay by `within` longer than they can be met, so that what a left row has met is known without marking it.  A part
    of the state goes once all its rows are behind.  State is published before the output, both by number of batch, so a restart repeats nothing.
    """
    spark, state = table.spark, SnapshotTable(table.spark, checkpoint, "rows")
    a_side = left.select(F.lit(True).alias("is_left"), F.struct(*left.columns).alias("l"), F.lit(None).cast(right.schema).alias("r"))
    b_side = right.select(F.lit(False).alias("is_left"), F.lit(None).cast(left.schema).alias("l"), F.struct(*right.columns).alias("r"))
    stream, a_new, b_new = a_side.unionByName(b_side), unused(left, "_new"), unused(right, "_new")
    state.create(stream.schema)
    table.create(left.alias("a").join(right.alias("b"), _met(keys, at, right_at, within), how).select(*_both(left, right, keys)).schema)
    counters = {"lefts": F.count(f"l.{at}"), "left": F.unix_micros(F.max(f"l.{at}")), "rights": F.count(f"r.{right_at}"), "right": F.unix_micros(F.max(f"r.{right_at}"))}
    time = lambda micros: F.timestamp_micros(F.lit(micros))
    until = lambda c: F.col(c) + F.expr(f"interval {within}")

    def before(micros: int | None, interval: str) -> int | None:
        return None if micros is None else spark.sql(f"SELECT unix_micros(timestamp_micros({micros}) - interval {interval}) AS t").first().t

    def watermark(seen: dict | None) -> int | None:
        return None if not seen or seen["left"] is None or seen["right"] is None else before(min(seen["left"], seen["right"]), delay)

    def write(batch: DataFrame, number: int, query: str) -> None:
        tag, base = str(number), state.manifest()
        # Latest times up to a batch, by its number, for the parts that are there and the batch before this one.
        known = base.get("seen", {})
        last = max((int(k) for k in known if int(k) < number), default=None)
        seen_before = known.get(str(last))
        old = watermark(seen_before)
        # A day more, for the hours by which clocks are set.
        behind = before(before(old, within), "1 day")
        live = {k for k, v in known.items() if behind is None or any(t is not None and t > behind for t in (v["left"], v["right"]))}
        seen = {k: v for k, v in known.items() if k in live or k == str(last)}

        def count(got: dict, _: DataFrame) -> None:
            latest = lambda side: max((t for t in ((seen_before or {}).get(side), got[side] if got[f"{side}s"] else None) if t is not None), default=None)
            seen[tag] = {"left": latest("left"), "right": latest("right"), "rows": got["rows"]}

        rows = batch.where(F.col("is_left") | F.col(f"r.{right_at}").isNotNull())
        if old is not None:
            rows = rows.where(F.coalesce(F.col(f"l.{at}"), F.col(f"r.{right_at}"), time(old + 1)) > time(old))
        m = state.commit({tag: rows}, lambda p: p["tag"] in live, "append", counters, accept=count, batch=(query, number), seen=seen)

        new, held = watermark(m["seen"][tag]), [p for p in m["parts"] if p["tag"] != tag]
        arrived = state.read_parts([p for p in m["parts"] if p["tag"] == tag], m)

        def side(which: Column, struct: str, flag: str, c: str) -> DataFrame:
            pick = lambda df, is_new: df.where(which).select(f"{struct}.*", F.lit(is_new).alias(flag))
            kept = pick(state.read_parts(held, m), False).where(F.col(c).isNotNull())
            return pick(arrived, True).unionByName(kept if old is None else kept.where(until(c) > time(old)))

        a, b = side(F.col("is_left"), "l", a_new, at).alias("a"), side(~F.col("is_left"), "r", b_new, right_at).alias("b")
        met = F.col(f"b.{right_at}").isNotNull()
        given = met & (F.col(f"a.{a_new}") | F.col(f"b.{b_new}"))
        if how == "left_outer":
            over = F.col(f"a.{at}").isNull()
            given |= ~met & (over if new is None else over | (until(f"a.{at}") <= time(new)))
        found = a.join(b, _met(keys, at, right_at, within), how).where(given).select(*_both(left, right, keys))
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(v["rows"] for v in m["seen"].values()) // TASK_ROWS))
        with _set(spark, {"spark.sql.shuffle.partitions": str(tasks)}):
            table.append(found, batch=(query, number))
        state.vacuum(1)

    _run(stream, write, table, checkpoint, {})
