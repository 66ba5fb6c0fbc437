import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from factloom.operators import incremental, joins, marts, versioning
from factloom.operators.filings import schema_of
from factloom.operators.frame import stamp
from factloom.operators.tables import BUCKET, DAY, CommitConflict, SnapshotTable, bucket_of, buckets_for
from factloom.runtime import scratch as scratch_module
from factloom.runtime.files import Store
from factloom.runtime.lease import Busy, held
from factloom.sources import landing
from factloom.streaming.ingest import ingest_batch

INDEX = "bronze.filing_index_raw"


def ints(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def table(spark, tmp_path, name="t"):
    return SnapshotTable(spark, str(tmp_path), name).create(ints(spark).schema)


def values(t, **more):
    return sorted(r.n for r in t.read(**more).collect())


# Commit protocol


def test_a_lagging_pointer_survives_vacuum(spark, tmp_path):
    t = table(spark, tmp_path)
    for k in range(3):
        t.append(ints(spark, k))
    # A slower writer's pointer comes last.
    t._point(1)
    assert t.version() == 3
    t.vacuum(1)
    assert t.version() == 3 and values(t) == [0, 1, 2]
    # One that comes after vacuum() names a version that is gone.
    t._point(1)
    assert t.version() == 3 and values(t) == [0, 1, 2]
    t.append(ints(spark, 9))
    assert t.version() == 4 and values(t) == [0, 1, 2, 9]


def test_a_crash_between_manifest_and_pointer_is_a_commit(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_point", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            t.append(ints(spark, 1))
    assert t.version() == 1 and values(t) == [1]
    # The same while the table is made: the next writer takes it up.
    u = SnapshotTable(spark, str(tmp_path), "u")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_point", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            u.create(t.schema)
    assert SnapshotTable(spark, str(tmp_path), "u").create(t.schema).version() == 0 and u.exists()


def meanwhile(monkeypatch, action):
    """Runs action once, after rows are written and before they are published."""
    write, ran = SnapshotTable._write, []

    def wrapped(self, *a):
        out = write(self, *a)
        if not ran:
            ran.append(1)
            action()
        return out

    monkeypatch.setattr(SnapshotTable, "_write", wrapped)


def test_rebased_appends_keep_the_marks_of_others(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    meanwhile(monkeypatch, lambda: t.append(ints(spark, 2), batch=("q2", 7)))
    t.append(ints(spark, 1), batch=("q1", 5))
    assert t.manifest()["batches"] == {"q1": 5, "q2": 7} and values(t) == [1, 2]
    t.append(ints(spark, 2), batch=("q2", 7))
    assert values(t) == [1, 2]


def test_a_batch_that_another_driver_published_is_not_appended_again(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    meanwhile(monkeypatch, lambda: t.append(ints(spark, 1), batch=("q", 0)))
    assert t.append(ints(spark, 1), batch=("q", 0))["metrics"] == {"rows": 0}
    assert values(t) == [1] and t.version() == 1 and len(t.store.names(f"{t.path}/data")) == 1


def test_writers_of_one_file_do_not_share_a_temporary_name(spark, tmp_path, monkeypatch):
    store, seen = Store(spark), []
    replace = Store._replace
    monkeypatch.setattr(Store, "_replace", lambda self, fs, a, b, *o: (seen.append(a.getName()), replace(self, fs, a, b, *o))[1])
    for k in range(2):
        store.write(f"{tmp_path}/f.json", b"%d" % k)
    assert len(set(seen)) == 2 and store.read(f"{tmp_path}/f.json") == b"1" and store.names(str(tmp_path)) == ["f.json"]


@pytest.mark.parametrize("crash", ["before the append", "after the append"])
def test_the_ledger_takes_up_what_was_begun(spark, tmp_path, crash):
    name, root, state = "filing_index", f"{tmp_path}/landing", f"{tmp_path}/state"
    one = spark.createDataFrame([("1", "r1", "2030-01-01", "{}")], "envelope_version string, resource_id string, logical_date string, payload_json string")
    t = SnapshotTable(spark, str(tmp_path), INDEX).create(schema_of(INDEX))
    landing.write_envelopes(one, landing.landing_path(root, name, "2030-01-01"))
    batch = landing.read_landing_batch(spark, root, name, state, "2030-01-01")
    assert batch.begin() and not landing.read_landing_batch(spark, root, name, state, "2030-01-01").is_empty
    if crash == "after the append":
        from factloom.streaming.ingest import _append

        _append(t, name, batch.frame, "b", None, landing.SUPPORTED_VERSIONS, batch=(f"{name}/2030-01-01", batch.number))
    # More has landed before the next run; the batch that was begun stays as it was.
    landing.write_envelopes(one.withColumn("resource_id", F.lit("r2")), landing.landing_path(root, name, "2030-01-01") + "/more")
    for _ in range(2):
        ingest_batch(spark, root, name, t, state, "2030-01-01")
    assert sorted(r.resource_id for r in t.read().collect()) == ["r1", "r2"]
    # Runs over all days see what days have taken.
    assert ingest_batch(spark, root, name, t, state)["rows"] == 0


def test_two_drivers_cannot_begin_one_number(spark, tmp_path):
    name, root, state = "filing_index", f"{tmp_path}/landing", f"{tmp_path}/state"
    landing.write_envelopes(spark.createDataFrame([("1", "r", "2030-01-01")], "envelope_version string, resource_id string, logical_date string"), landing.landing_path(root, name))
    a, b = (landing.read_landing_batch(spark, root, name, state) for _ in range(2))
    assert a.begin() and not b.begin()


def test_one_run_at_a_time(spark, tmp_path):
    root = str(tmp_path)
    with held(spark, root, "first"):
        with pytest.raises(Busy, match="first"), held(spark, root, "second"):
            pass
    with pytest.raises(KeyError), held(spark, root, "fails"):
        raise KeyError
    with held(spark, root, "stuck", seconds=-1), held(spark, root, "next"):
        pass
    with held(spark, root, "last") as n:
        assert n == 5


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    with scratch_module.scratched(spark) as folder:
        ints(spark, 1).write.parquet(folder)
        assert Store(spark).exists(folder)
    assert not Store(spark).exists(folder)

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(scratch_module.NoSharedFolder):
        scratch_module.scratch(Session())


# Parts


def test_one_day_opens_its_parts_alone(spark, tmp_path):
    t = table(spark, tmp_path)
    rows = spark.createDataFrame([(k, f"2030-01-0{1 + k % 3}" if k % 4 else None) for k in range(24)], f"n int, {DAY} string")
    t.append(rows)
    t.append(ints(spark, 100))
    assert {p.get("day", "any") for p in t.manifest()["parts"]} == {"2030-01-01", "2030-01-02", "2030-01-03", None, "any"}
    assert values(t, days=["2030-01-02"]) == [k for k in range(24) if k % 4 and k % 3 == 1] + [100]
    read = t.read(days=["2030-01-02"]).inputFiles()
    assert all(f"/{DAY}=2030-01-02" in f or f"/{DAY}=" not in f for f in read) and len(read) < len(t.read().inputFiles())
    assert values(t) == [*range(24), 100]


def test_compaction_changes_no_row(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    for k in range(5):
        t.append(ints(spark, k).withColumn(BUCKET, bucket_of(["n"], 2)))
    assert t.compact(most=9) is None
    before = len(t.manifest()["parts"])
    meanwhile(monkeypatch, lambda: t.append(ints(spark, 77)))
    t.compact(most=1)
    assert values(t) == [0, 1, 2, 3, 4, 77] and len(t.manifest()["parts"]) < before + 1 and {p.get("bucket") for p in t.manifest()["parts"]} <= {0, 1, None}
    # Where another writer has replaced the parts, nothing is lost.
    for k in range(3):
        t.append(ints(spark, 100 + k))
    monkeypatch.undo()
    meanwhile(monkeypatch, lambda: t.overwrite(ints(spark, 5)))
    with pytest.raises(CommitConflict):
        t.compact(most=1)
    assert values(t) == [5]


def test_a_one_percent_merge_reads_few_of_many_buckets(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id as k", "cast(id % 7 as string) as v")
    t = SnapshotTable(spark, str(tmp_path), "t").create(rows.selectExpr("k", "v", "1 as version_number", "date'2030-01-01' as valid_from", "date'2030-01-01' as valid_to", "true as is_current", "'' as _hash_diff", "now() as _first_seen_ts", "now() as _last_seen_ts").schema, buckets=2)
    versioning.merge_scd2(t, rows, ["k"], ["v"], "2030-01-01")
    versioning.rebucket(t, ["k"], 1024)
    assert t.manifest()["buckets"] == 1024 and t.read().count() == 5000
    delta = rows.where("k < 50").withColumn("v", F.lit("new"))
    n, hit = versioning.touched(t, t.manifest(), delta, ["k"])
    assert n == 1024 and len(hit) < 0.1 * n
    got = versioning.merge_scd2(t, delta, ["k"], ["v"], "2030-01-02")
    assert (got["inserted"], got["closed"]) == (50, 50) and got["unchanged"] < 600
    assert versioning.check_history(t, ["k"]) and {p["tag"] for p in t.manifest()["parts"]} == {"current", "closed"}
    assert buckets_for(0) == buckets_for(1) == 1 and buckets_for(300 << 20) == 2 and buckets_for(1 << 40) == 4096


def test_changes_read_only_parts_that_differ(spark, tmp_path):
    t = table(spark, tmp_path)
    for k in range(4):
        t.append(ints(spark, k, k))
    t.commit({"rows": ints(spark, 3, 8)}, lambda p: p["path"] != t.manifest()["parts"][3]["path"], "replace")
    c = t.changes(4)
    assert sorted(map(tuple, c.collect())) == [(3, -1, 1), (8, 1, 1)]
    gone, come = t.changed_parts(4)
    assert len(gone) == len(come) == 1 and len(c.inputFiles()) == len(t.read_parts(gone + come).inputFiles()) < len(t.read().inputFiles())
    assert t.changes(5).count() == 0 and sorted(map(tuple, t.changes(5, 4).collect())) == [(3, 1, 1), (8, -1, 1)]


def test_incremental_activity_equals_a_rebuild(spark, tmp_path, monkeypatch):
    rng, day = random.Random(1), date(2030, 1, 1)
    schema = "k int, filed_date date, base_form_type string, cik string, is_amendment boolean"
    row = lambda k: (k, day + timedelta(rng.randrange(4)), rng.choice(["A", "B", None]), rng.choice(["x", "y", "z"]), rng.choice([True, False]))
    source = SnapshotTable(spark, str(tmp_path), "source").create(spark.createDataFrame([], schema + ", _first_seen_ts timestamp, _last_seen_ts timestamp").schema, buckets=4)
    group, name = ["filed_date", "base_form_type"], "gold.filing_activity_daily"
    support = SnapshotTable(spark, str(tmp_path), "support").create(incremental.support_schema(source.schema, group, "cik"), buckets=4)
    mart = SnapshotTable(spark, str(tmp_path), name).create(schema_of(name))
    run = lambda: incremental.update_activity(source, support, mart, "run", where="k >= 0")

    def same():
        want = marts.daily_activity(source.read().where("k >= 0"))
        return sorted(map(str, mart.read().select(want.columns).collect())) == sorted(map(str, want.collect()))

    for step in range(3):
        versioning.merge_scd1(source, spark.createDataFrame([row(k) for k in rng.sample(range(-2, 40), 15)], schema), ["k"])
        assert run()["rebuilt"] == int(step == 0) and same()
    assert run() == {"buckets_touched": 0, "rebuilt": 0}
    # A run ends between support and mart; the next one sees it.
    source.overwrite(spark.createDataFrame(source.read().where("cik <> 'x'").collect(), source.schema))
    with monkeypatch.context() as m:
        m.setattr(mart, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            run()
    assert not same()
    run()
    assert same()
    # The version that the support stands at is gone: all is built anew.
    source.append(spark.createDataFrame([(*row(99), None, None)], source.schema))
    source.append(spark.createDataFrame([(*row(98), None, None)], source.schema))
    source.vacuum(1)
    assert run()["rebuilt"] == 1 and same()


def test_mart_by_bucket_equals_a_rebuild(spark, tmp_path, monkeypatch):
    rng, root = random.Random(2), str(tmp_path)
    facts = "cik string, n int, value int"
    source = SnapshotTable(spark, root, "facts").create(spark.createDataFrame([], facts + ", _first_seen_ts timestamp, _last_seen_ts timestamp").schema, buckets=16)
    names = SnapshotTable(spark, root, "names").create(spark.createDataFrame([], "cik string, company_name string, sic string, is_current boolean").schema)
    mart = SnapshotTable(spark, root, "mart").create(stamp(spark.createDataFrame([], "cik string, total long, company_name string"), "", None).schema)
    name = lambda k, label, sic="1": (f"c{k}", label, sic, True)
    put_names = lambda rows: names.overwrite(spark.createDataFrame(rows, names.schema))
    # A fact without an entity lies in a bucket too.
    merge = lambda rows: versioning.merge_scd1(source, spark.createDataFrame(rows, facts), ["cik", "n"], bucket_by=["cik"])
    opened = []

    def build(rows, buckets):
        opened.append(len(rows.inputFiles()))
        sums = rows.groupBy("cik").agg(F.sum("value").alias("total"))
        return sums.join(names.read().where("is_current").select("cik", "company_name"), "cik", "left")

    run = lambda: incremental.update_by_bucket(source, mart, build, ["cik"], "run", names=names)

    def same():
        want = sorted(map(str, build(source.read(), None).select("cik", "total", "company_name").collect()))
        return sorted(map(str, mart.read().select("cik", "total", "company_name").collect())) == want

    assert run() == {"buckets_touched": 16, "rebuilt": 1, "rows": 0} and same()
    put_names([name(k, f"name {k}") for k in range(0, 60, 2)])
    merge([(None if k == 0 else f"c{k}", n, rng.randrange(9)) for k in range(60) for n in range(3)])
    run()
    assert same() and run() == {"buckets_touched": 0, "rebuilt": 0, "rows": 0}
    merge([("c7", 1, 100), ("c7", 9, 5)])
    opened.clear()
    got = run()
    assert (got["buckets_touched"], got["rebuilt"]) == (1, 0) and opened[0] < len(source.read().inputFiles()) / 4 and same()
    # One name changes, one company comes, one goes; what marts do not take over makes no change.
    put_names([name(k, "other" if k == 4 else f"name {k}", "2") for k in range(0, 58, 2)] + [name(9, "new")])
    got = run()
    assert 1 <= got["buckets_touched"] <= 3 and not got["rebuilt"] and same()
    put_names([(*r[:2], "3", True) for r in names.read().collect()])
    assert run() == {"buckets_touched": 0, "rebuilt": 0, "rows": 0} and same()
    # The last rows of a bucket go.
    source.overwrite(source.read().where("false"))
    assert run()["rebuilt"] == 1 and mart.read().count() == 0
    merge([("c1", 1, 1)])
    run()
    versioning.rebucket(source, ["cik"], 4)
    assert run() == {"buckets_touched": 4, "rebuilt": 1, "rows": 1} and same()
    # Another writer of the mart comes between.
    merge([("c1", 1, 2)])
    with monkeypatch.context() as m:
        plain = mart.commit
        m.setattr(mart, "commit", lambda *a, **k: (mart.overwrite(mart.read().where("false")), plain(*a, **k))[1] if k.get("inputs") else plain(*a, **k))
        with pytest.raises(CommitConflict):
            run()
    assert run()["rebuilt"] == 1 and same()


# Joins by time


@pytest.mark.parametrize("width, tolerance", [(None, None), (10, None), (7, 12)])
def test_asof_against_brute_force(spark, width, tolerance):
    rng, zero = random.Random(2), datetime(2030, 1, 1)
    at = lambda: rng.choice([None, *[zero + timedelta(seconds=rng.randrange(60)) for _ in range(8)]])
    left = [(k, rng.choice(["a", "a", "b", None]), at()) for k in range(80)]
    right = [(rng.choice(["a", "a", "c", None]), at(), rng.choice([1, 2, None])) for _ in range(60)]
    a, b = spark.createDataFrame(left, "id int, key string, t timestamp"), spark.createDataFrame(right, "key string, t timestamp, v int")
    got = joins.asof(a, b, ["key"], "t", tolerance=tolerance, width=width, prefix="r_")
    assert got.columns == ["id", "key", "t", "r_t", "r_v"]
    low = lambda v: (v is not None, v or 0)
    want = {}
    for k, key, t in left:
        fit = [(u, v) for x, u, v in right if x == key and u is not None and t is not None and u <= t]
        u, v = max(fit, key=lambda x: (x[0], low(x[1])), default=(None, None))
        want[k] = (u, v) if u is not None and (tolerance is None or (t - u).total_seconds() <= tolerance) else (None, None)
    assert {r.id: (r.r_t, r.r_v) for r in got.collect()} == want
    with pytest.raises(ValueError, match="prefix"):
        joins.asof(a, b, ["key"], "t")


def test_asof_of_a_hot_key_is_not_quadratic(spark):
    n = 100_000
    a = spark.range(n).selectExpr("1 as key", "id", "timestamp_seconds(id) as t")
    got = joins.asof(a, a.select("key", "t", "id").withColumnRenamed("id", "other"), ["key"], "t", width=1000, prefix="r_")
    assert got.where("id = r_other").count() == n


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_overlaps_against_brute_force(spark, width):
    rng, day = random.Random(3), date(2030, 1, 1)

    def spans(n):
        out = []
        for k in range(n):
            s = rng.randrange(40)
            out.append((k, rng.choice(["a", "a", "b", None]), rng.choice([None, day + timedelta(s), day + timedelta(s)]), rng.choice([None, day + timedelta(s + rng.randrange(-2, 15))])))
        return out

    left, right, schema = spans(40), spans(40), "id int, key string, s date, e date"
    got = joins.overlaps(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["key"], ("s", "e"), width=width * 86_400)
    far = date(9999, 1, 1)
    valid = lambda x: x[2] is not None and (x[3] or far) >= x[2]
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and valid(x) and valid(y) and x[2] <= (y[3] or far) and y[2] <= (x[3] or far))
    assert sorted((r.id, r.right_id) for r in got.collect()) == want and len(want) > 50
    assert joins.overlaps(spark.createDataFrame([], schema), spark.createDataFrame(right, schema), ["key"], ("s", "e")).count() == 0


def test_index_keeps_names_with_double_blanks(spark):
    lines = ["10-K   ACME  WIDGETS INC   1234   20300101   x/0000001234-30-000001.txt", "SC 13D/A    A    B 9 CO  9  2030-01-01  y", "Form Type   Company Name   CIK   Date Filed   File Name", "-" * 40, ""]
    got = landing.parse_index(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.form_type, r.company_name, r.cik, r.date_filed, r.accession_number) for r in got] == [("10-K", "ACME  WIDGETS INC", "1234", "20300101", "0000001234-30-000001"), ("SC 13D/A", "A    B 9 CO", "9", "2030-01-01", "")]


def test_state_on_disk_with_its_own_partitions(spark, tmp_path):
    """a join's state lies in one store a partition, as many as asked for; the session keeps its settings."""
    from factloom.streaming import stateful

    left, right = (spark.sql(f"SELECT id k, timestamp'2024-01-0{d}' {c} FROM range({n})") for d, c, n in ((1, "a", 8), (2, "b", 4)))
    far = lambda c: spark.sql(f"SELECT -1L k, timestamp'2034-01-01' {c}")
    before = {k: spark.conf.get(k, None) for k in [*stateful.ON_DISK, "spark.sql.shuffle.partitions"]}
    t = None
    for rows in ((left, right), (far("a"), far("b"))):
        for df in rows:
            df.write.mode("append").parquet(f"{tmp_path}/{df.columns[1]}")
        a, b = (spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{df.columns[1]}") for df in rows)
        found = stateful.join_streams(a, b, ["k"], "a", "b", "5 days")
        t = t or SnapshotTable(spark, str(tmp_path), "joined").create(found.schema)
        stateful.run_to_table(found, t, f"{tmp_path}/state", on_disk=True, partitions=3)
    assert sorted((r.k, r.b is not None) for r in t.read().where("k >= 0").collect()) == [(k, k < 4) for k in range(8)]
    assert {k: spark.conf.get(k, None) for k in before} == before
    stores = {p.relative_to(tmp_path / "state/state/0").parts[0] for p in (tmp_path / "state/state/0").rglob("*.changelog")}
    assert stores == {"0", "1", "2"}


def _joined(spark, path, name, batches, how="left_outer", stops=None):
    """Rows of join_to_table() over (left rows, right rows) a run; keys k, times by day of 2024, state let go ten days behind; appends that stop."""
    from factloom.streaming import stateful

    root, kinds = f"{path}/{name}", {"a": "k long, a timestamp, n int", "b": "k long, b timestamp, m int"}
    table = SnapshotTable(spark, root, "joined")
    read = lambda c: spark.readStream.schema(kinds[c]).parquet(f"{root}/{c}")
    run = lambda: stateful.join_to_table(read("a"), read("b"), ["k"], "a", "b", "5 days", table, f"{root}/state", delay="10 days", how=how)
    for i, rows in enumerate(batches):
        for c, found in zip("ab", rows):
            text = [(k, None if d is None else f"{date(2024, 1, 1) + timedelta(d)}", n) for k, d, n in found]
            df = spark.createDataFrame(text, "k long, d string, n int").selectExpr("k", f"CAST(d AS timestamp) {c}", f"n {kinds[c].split()[-2]}")
            df.coalesce(1).write.mode("append").parquet(f"{root}/{c}")
        if i in (stops or {}):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(SnapshotTable, "append", stops[i])
                with pytest.raises(Exception, match="stopped"):
                    run()
        run()
    return table, sorted(((r.k, r.n, r.m) for r in table.read().collect()), key=str)


#: Keys 1: met within a batch, twice; 2: right row a batch later; 3: left row a batch later; 4: right row too late for the bound; 5: never met;
#: 6: comes behind the watermark; 7 and NULL: no time, no key.
_STREAMS = [
    ([(1, 0, 10), (2, 0, 20), (4, 0, 40), (5, 1, 50), (7, None, 70), (None, 2, 80)], [(1, 0, 11), (1, 5, 12), (3, 3, 31), (7, 1, 71), (None, 2, 81), (1, None, 13)]),
    ([(3, 0, 30)], [(2, 5, 21), (4, 6, 41)]),
    ([(9, 40, 90)], [(9, 41, 91)]),
    ([(6, 20, 60), (8, 38, 85)], [(6, 21, 61), (8, 39, 86), (9, 45, 92), (9, 46, 93)]),
    ([(-1, 300, 0)], [(-1, 300, 0)]),
]
_MET = [(-1, 0, 0), (1, 10, 11), (1, 10, 12), (2, 20, 21), (3, 30, 31), (8, 85, 86), (9, 90, 91), (9, 90, 92)]
_ALONE = [(4, 40, None), (5, 50, None), (7, 70, None), (None, 80, None)]


def test_join_of_streams_over_a_table(spark, tmp_path):
    """the join's state is a table: rows meet across batches, leave alone once, late ones are dropped, old parts go."""
    table, got = _joined(spark, tmp_path, "outer", _STREAMS)
    assert got == sorted([*_MET, *_ALONE], key=str)
    state = SnapshotTable(spark, f"{tmp_path}/outer/state", "rows")
    assert [p["tag"] for p in state.manifest()["parts"]] == ["2", "3", "4"] and len(state.history()) == 1
    assert _joined(spark, tmp_path, "inner", _STREAMS[:2], how="inner")[1] == sorted([x for x in _MET if 0 < x[0] < 8], key=str)


def test_join_over_a_table_goes_on_after_a_crash(spark, tmp_path):
    """a run that stops once the state is published, before or after its output is, repeats and loses nothing."""
    append = SnapshotTable.append

    def before(self, *a, **more):
        raise RuntimeError("stopped")

    def after(self, *a, **more):
        append(self, *a, **more)
        raise RuntimeError("stopped")

    assert _joined(spark, tmp_path, "stops", _STREAMS[:3], stops={0: before, 1: after, 2: before})[1] == sorted([x for x in _MET if x[0] in (1, 2, 3, 9) and x[2] < 92] + _ALONE, key=str)


def test_stream_stream_join_keeps_state_in_a_table(spark, tmp_path, monkeypatch):
    """the query asks no key-value store for rows, and orders without a key or day come out alone, as in the SQL."""
    from factloom.plans import queries

    seen = []
    monkeypatch.setattr(queries, "scratch", lambda s: seen.append(f"{tmp_path}/scratch") or seen[-1])
    spark.sql("SELECT * FROM VALUES (1L, timestamp'1996-01-01'), (7L, timestamp'2000-02-01'), (2L, NULL), (NULL, timestamp'1996-01-01') t(o_orderkey, o_orderdate)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT * FROM VALUES (1L, 1, timestamp'1996-03-31'), (1L, 2, timestamp'1996-04-01'), (7L, 1, timestamp'2000-02-01'), (2L, 1, timestamp'1996-01-01'), (NULL, 1, timestamp'1996-01-01') t(l_orderkey, l_linenumber, l_shipdate)").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.stream_stream_join(spark, str(tmp_path)).collect()
    want = [(1, "1996-01-01", 1, "1996-03-31"), (7, "2000-02-01", 1, "2000-02-01"), (2, None, None, None), (None, "1996-01-01", None, None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert not [p for p in (tmp_path / "scratch").rglob("*") if p.suffix in (".delta", ".changelog", ".snapshot", ".zip")]
