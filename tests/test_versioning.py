import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.functions.keys import surrogate_key
from factloom.operators import filings
from factloom.operators import versioning as v
from factloom.operators.frame import align, dedupe
from factloom.operators.quality import SCD2_CHECKS, BatchRejected, require
from factloom.operators.tables import SnapshotTable
from factloom.plans import inspect
from factloom.runtime.report import Report

DDL = "cik string, company_name string, tickers array<string>, version_number int, valid_from date, valid_to date, is_current boolean, _hash_diff string, _first_seen_ts timestamp, _last_seen_ts timestamp"
TRACKED = ["company_name", "tickers"]


def table(spark, tmp_path):
    from pyspark.sql.types import StructType

    return SnapshotTable(spark, str(tmp_path), "company").create(StructType.fromDDL(DDL))


def merge(spark, t, rows, day):
    source = spark.createDataFrame(rows, "cik string, company_name string, tickers array<string>")
    return v.merge_scd2(t, source, ["cik"], TRACKED, day, processing_ts=day)


def state(t):
    return [(r.cik, r.company_name, r.version_number, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.is_current) for r in t.read().orderBy("cik", "version_number").collect()]


def test_scd2_cases(spark, tmp_path):
    t = table(spark, tmp_path)
    got = merge(spark, t, [("1", "a", ["x", "y"]), ("2", "b", None)], "2024-01-01")
    assert got["inserted"] == 2
    # No change, whatever the order of a list: only seen again.
    merge(spark, t, [("1", "a", ["y", "x"])], "2024-01-02")
    assert state(t) == [("1", "a", 1, "2024-01-01", None, True), ("2", "b", 1, "2024-01-01", None, True)]
    seen = {r.cik: (str(r._first_seen_ts.date()), str(r._last_seen_ts.date())) for r in t.read().collect()}
    assert seen == {"1": ("2024-01-01", "2024-01-02"), "2": ("2024-01-01", "2024-01-01")}
    # A change closes the day before; a key that is missing stays.
    got = merge(spark, t, [("1", "a2", ["x"])], "2024-01-05")
    assert got["closed"] == 1 and got["inserted"] == 1
    assert state(t)[:2] == [("1", "a", 1, "2024-01-01", "2024-01-04", False), ("1", "a2", 2, "2024-01-05", None, True)]
    # The same day: replaced in place.
    merge(spark, t, [("1", "a3", ["x"])], "2024-01-05")
    assert state(t)[1] == ("1", "a3", 2, "2024-01-05", None, True)
    # Back to the first value is a version of its own.
    merge(spark, t, [("1", "a", ["x", "y"])], "2024-01-09")
    assert [s[1:3] for s in state(t)[:3]] == [("a", 1), ("a3", 2), ("a", 3)]
    # Running it again changes nothing.
    before = state(t)
    merge(spark, t, [("1", "a", ["x", "y"])], "2024-01-09")
    assert state(t) == before


def test_older_day_is_refused_and_leaves_the_table_alone(spark, tmp_path):
    t = table(spark, tmp_path)
    merge(spark, t, [("1", "a", None)], "2024-01-05")
    with pytest.raises(PySparkException, match="before the current version"):
        merge(spark, t, [("1", "b", None)], "2024-01-01")
    assert t.version() == 1 and state(t)[0][1] == "a"


def test_null_key_is_a_key(spark, tmp_path):
    t = table(spark, tmp_path)
    merge(spark, t, [(None, "a", None)], "2024-01-01")
    merge(spark, t, [(None, "b", None)], "2024-01-02")
    assert [s[1:3] for s in state(t)] == [("a", 1), ("b", 2)]


def test_closed_files_are_carried_over(spark, tmp_path):
    t = table(spark, tmp_path)
    for n, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        merge(spark, t, [("1", f"a{n}", None)], day)
    parts = {m["version"]: {p["path"] for p in m["parts"] if p["tag"] == "closed"} for m in t.history()}
    assert parts[2] < parts[3]


def test_arguments(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(ValueError):
        v.merge_scd2(t, t.read(), [], TRACKED, "2024-01-01")
    with pytest.raises(ValueError):
        v.merge_scd2(t, t.read(), ["cik"], TRACKED, "2024-13-01")
    with pytest.raises(ValueError):
        v.scd1(t.read(), t.read(), [])
    with pytest.raises(ValueError):
        v.scd1(t.read(), t.read(), ["cik"], update=[v.FIRST_SEEN])


def test_random_folds_agree_with_a_model_and_with_windows(spark, tmp_path):
    rng, days = random.Random(5), [date(2024, 1, 1) + timedelta(d) for d in range(6)]
    t, model, snapshots = table(spark, tmp_path), {}, []
    for day in days:
        batch = {k: rng.choice("ab") for k in "123" if rng.random() < 0.8}
        if not batch:
            continue
        merge(spark, t, [(k, n, None) for k, n in batch.items()], str(day))
        for k, n in batch.items():
            snapshots.append((k, n, None, day))
            versions = model.setdefault(k, [])
            if not versions or versions[-1][0] != n:
                if versions:
                    versions[-1][2] = str(day - timedelta(1))
                versions.append([n, str(day), None])
    assert state(t) == [(k, n, i, a, b, b is None) for k in sorted(model) for i, (n, a, b) in enumerate(model[k], 1)]
    frame = spark.createDataFrame(snapshots, "cik string, company_name string, tickers array<string>, day date")
    h = v.history_from(frame, ["cik"], TRACKED, "day").orderBy("cik", "version_number").collect()
    assert [(r.cik, r.company_name, r.version_number, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.is_current) for r in h] == state(t)


def test_invariants_find_what_is_wrong(spark):
    rows = [("ok", 1, date(2024, 1, 1), date(2024, 1, 4), False), ("ok", 2, date(2024, 1, 5), None, True), ("two", 1, date(2024, 1, 1), None, True), ("two", 2, date(2024, 1, 1), None, True), ("gap", 2, date(2024, 1, 1), None, True)]
    df = spark.createDataFrame(rows, "cik string, version_number int, valid_from date, valid_to date, is_current boolean")
    got = {r.cik: r for r in v.scd2_invariants(df, ["cik"]).collect()}
    assert (got["ok"].current_count, got["ok"].overlap_count) == (1, 0)
    assert (got["two"].current_count, got["two"].overlap_count) == (2, 1)
    require(v.scd2_invariants(df.where("cik = 'ok'"), ["cik"]), SCD2_CHECKS)
    for bad in ("two", "gap"):
        with pytest.raises(BatchRejected):
            require(v.scd2_invariants(df.where(F.col("cik") == bad), ["cik"]), SCD2_CHECKS)


def test_scd1(spark):
    seen = "timestamp'2024-01-01'"
    target = spark.sql(f"select 1 k, 'a' n, {seen} _first_seen_ts, {seen} _last_seen_ts union all select 2, 'b', {seen}, {seen}")
    source = spark.createDataFrame([(2, "b2", 1), (2, "b3", 2), (3, "c", 1)], "k int, n string, at int")
    got = {r.k: r for r in v.scd1(target, source, ["k"], latest_by=["at"], processing_ts="2024-02-01").collect()}
    assert [(got[k].n, got[k]._op, got[k]._first_seen_ts.month, got[k]._last_seen_ts.month) for k in (1, 2, 3)] == [("a", "unchanged", 1, 1), ("b3", "updated", 1, 2), ("c", "inserted", 2, 2)]


def test_dedupe_is_total(spark):
    rows = [(1, None, "z"), (1, 5, "b"), (1, 5, "a"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k int, at int, x string")
    assert {(r.k, r.x) for r in dedupe(df, ["k"], ["at"]).collect()} == {(1, "a"), (None, "m")}
    with pytest.raises(ValueError):
        dedupe(df, [])


def test_point_in_time_and_assertion_order(spark):
    versions = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(2024, 1, 4)), (1, "b", date(2024, 1, 5), None)], "k int, name string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(1, date(2024, 1, 4)), (1, date(2024, 1, 5)), (1, date(2023, 1, 1)), (2, date(2024, 1, 5))], "k int, day date")
    assert [r.name for r in v.point_in_time(facts, versions, ["k"], "day").orderBy("k", "day").collect()] == [None, "a", "b", None]
    a = spark.createDataFrame([("f", "x", date(2024, 1, 2)), ("f", "y", date(2024, 1, 1)), ("g", "z", None)], "fact_sk string, accession_number string, filed_date date")
    got = {r.accession_number: (r.assertion_version, r.superseded_by_accession, r.is_current_assertion) for r in v.order_assertions(a, ["fact_sk"], ["filed_date", "accession_number"]).collect()}
    assert got == {"y": (1, "x", False), "x": (2, None, True), "z": (1, None, True)}


def test_tables(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path), "t")
    assert not t.exists() and t.version() is None
    t.create(spark.range(0).schema)
    t.append(spark.range(3))
    t.append(spark.range(3, 5))
    t.overwrite(spark.range(1))
    assert [t.read(n).count() for n in range(4)] == [0, 3, 5, 1]

    def refuse(df):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        t.overwrite(spark.range(9), validate=refuse)
    assert t.version() == 3 and t.read().count() == 1
    t.restore(2)
    assert t.read().count() == 5 and t.history()[0]["operation"] == "restore"
    t.vacuum(1)
    assert t.read().count() == 5 and len(t.history()) == 1


def test_a_small_delta_rewrites_its_buckets_alone(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path), "t").create(spark.createDataFrame([], "k long, n string, _first_seen_ts timestamp, _last_seen_ts timestamp").schema)
    v.merge_scd1(t, spark.range(500).selectExpr("id k", "'a' n"), ["k"], buckets=16)
    before = {p["path"]: p["bucket"] for p in t.manifest()["parts"]}
    assert set(before.values()) == set(range(16)) and t.manifest()["buckets"] == 16
    got = v.merge_scd1(t, spark.createDataFrame([(7, "b")], "k long, n string"), ["k"])
    after = {p["path"]: p["bucket"] for p in t.manifest()["parts"]}
    (bucket,) = {b for p, b in before.items() if p not in after}
    assert {b for p, b in after.items() if p not in before} == {bucket} and got["updated"] == 1 and got["unchanged"] < 100
    assert {(r.k, r.n) for r in t.read().collect()} == {(k, "b" if k == 7 else "a") for k in range(500)}
    # Rows that came without buckets are dealt to them by the next merge.
    t.append(spark.createDataFrame([(900, "x", None, None)], t.schema))
    v.merge_scd1(t, spark.createDataFrame([(900, "y")], "k long, n string"), ["k"])
    assert all("bucket" in p for p in t.manifest()["parts"]) and t.read().where("k = 900").first().n == "y" and t.read().count() == 501


def test_scd2_rewrites_its_buckets_alone(spark, tmp_path):
    t = table(spark, tmp_path)
    source = lambda keys, n, day: v.merge_scd2(t, spark.createDataFrame([(str(k), n, None) for k in keys], "cik string, company_name string, tickers array<string>"), ["cik"], TRACKED, day, buckets=8)
    source(range(100), "a", "2024-01-01")
    before = {p["path"]: p["bucket"] for p in t.manifest()["parts"]}
    assert source([5], "b", "2024-01-02")["closed"] == 1
    after = {p["path"]: (p["tag"], p["bucket"]) for p in t.manifest()["parts"]}
    gone = {b for p, b in before.items() if p not in after}
    assert len(gone) == 1 and {b for p, (_, b) in after.items() if p not in before} == gone
    assert [(s[1], s[2]) for s in state(t) if s[0] == "5"] == [("a", 1), ("b", 2)] and len(state(t)) == 101


def test_two_writers_cannot_both_win(spark, tmp_path):
    from factloom.operators.tables import CommitConflict

    t = SnapshotTable(spark, str(tmp_path), "t").create(spark.range(0).schema)
    t.append(spark.range(2))
    base = t.manifest()
    t.overwrite(spark.range(5), base=base)
    with pytest.raises(CommitConflict):
        t.overwrite(spark.range(9), base=base)
    assert t.read().count() == 5 and t.version() == 2
    # An append is made upon what the other writer has left.
    t.append(spark.range(3), base=base)
    assert t.read().count() == 8 and t.version() == 3
    # Data of the loser is gone, and a lost pointer update hides no version.
    assert len({p.split("/data/")[1].split("/")[0] for p, _ in t.store.list(f"{t.path}/data")}) == 3
    t.store.write(t._pointer(), b'{"version": 1}')
    assert t.version() == 3 and t.read().count() == 8


def test_dedupe_and_views_take_any_column_names(spark):
    from factloom.operators.marts import latest_by_period

    df = spark.createDataFrame([(1, 5, "mine", 1), (1, 6, "mine", 2)], "k int, at int, _rank string, _RANK_ int")
    one = dedupe(df, ["k"], ["at"])
    assert one.columns == df.columns and one.first()["_rank"] == "mine"
    # A quarter and a year that end on one day: the answer does not depend on the order of rows.
    rows = [("c", date(2024, 10, 1), date(2024, 12, 31), 3), ("c", date(2024, 1, 1), date(2024, 12, 31), 10), ("c", None, date(2024, 6, 30), 1)]
    for order in (rows, rows[::-1]):
        got = latest_by_period(spark.createDataFrame(order, "k string, period_start date, period_end date, v int"), ["k"], "period_end").collect()
        assert [(r.period_start, r.v) for r in got] == [(date(2024, 1, 1), 10)]


def test_fact_merge_deals_rows_once(spark):
    """old and new facts meet, are numbered and lie in the order of their buckets after one shuffle."""
    schema = filings.schema_of("silver.financial_fact")
    old, new = spark.range(20).selectExpr("cast(id as string) fact_sk", "id"), spark.range(10, 30).selectExpr("cast(id as string) fact_sk", "id")
    facts = lambda df: align(df.withColumn("cik", F.lit("1")), schema)
    merged = filings.ordered_facts(v.scd1(facts(old), facts(new), [*filings.FACT_KEY, "fact_sk"], latest_by=filings.LATEST, place=v.place_of(["fact_sk"], 16)))
    assert inspect.shuffles(merged) == 1
    assert merged.count() == 30 and merged.where(v.bucket_at() != v.bucket_of(["fact_sk"], 16)).count() == 0


def test_filing_merge_deals_rows_once(spark):
    """so does a merge of versions, whose validation reads what was written."""
    schema = filings.schema_of("silver.filing")
    rows = lambda lo, hi: align(spark.range(lo, hi).selectExpr("cast(id as string) accession_number", "'x' company_name"), schema)
    merged = v.scd2(rows(0, 20), rows(10, 30), ["accession_number"], filings.FILING_TRACKED, "2030-01-01", latest_by=filings.LATEST, place=v.place_of(["accession_number"], 16))
    assert inspect.shuffles(merged) == 1
    assert merged.where(v.bucket_at() != v.bucket_of(["accession_number"], 16)).count() == 0


def test_digests_of_filings_do_not_travel(spark, tmp_path):
    """surrogates and change hashes are made after rows are dealt; what a row says otherwise stays, and tasks follow the rows."""
    made = {"filing_sk": lambda p: surrogate_key(F.col(f"{p}accession_number"))}
    schema, key, other = filings.schema_of("silver.filing"), ["accession_number"], "a" * 64
    rows = lambda lo, hi, name: spark.range(lo, hi).selectExpr("cast(id as string) accession_number", f"'{name}' company_name")
    source = lambda *a: align(rows(*a), StructType([f for f in schema if f.name not in (*made, v.HASH, *v.VERSION_COLUMNS)]))
    t = SnapshotTable(spark, str(tmp_path), "silver.filing").create(schema)
    assert v.merge_scd2(t, source(0, 20, "x"), key, filings.FILING_TRACKED, "2030-01-01", made=made, rows=20)["inserted"] == 20
    assert {(r.filing_sk == r.want, len(r[v.HASH])) for r in t.read().withColumn("want", made["filing_sk"]("")).collect()} == {(True, 64)}
    # A surrogate and a change hash that were made otherwise, and ones that are not there, are kept as they are.
    k = F.col("accession_number")
    t.overwrite(t.read().withColumns({"filing_sk": F.when(k == "1", other).when(k == "2", None).otherwise(F.col("filing_sk")), v.HASH: F.when(k == "3", other).when(k == "4", None).otherwise(F.col(v.HASH))}))
    merged = v.scd2(t.read(), source(0, 4, "x"), key, filings.FILING_TRACKED, "2030-01-02", made=made, place=v.place_of(key, 16), tasks=3)
    assert inspect.shuffles(merged) == 1 and merged.rdd.getNumPartitions() == 3
    got = {(r.accession_number, r.version_number): r for r in merged.collect()}
    assert got["1", 1].filing_sk == other and got["2", 1].filing_sk is None and got["3", 1][v.HASH] == other and got["4", 1][v.HASH] is None
    assert {k for k, r in got.items() if r[v.OP] == "closed"} == {("3", 1)} and len(got) == 21 and got["3", 2][v.HASH] == got["0", 1][v.HASH]
    assert {r.accession_number for r in v.unsaid(t.read(), made).where("filing_sk is not null").collect()} == {"1", "2"}
    assert [v.tasks_for(spark, n) for n in (0, 20_000, 60_000, 800_000, 90_000_000)] == [1, 1, 3, 4, 450]


def test_surrogates_are_not_staged(spark, tmp_path, monkeypatch):
    """typed rows are staged packed and without their surrogates, which the merge makes from the key."""
    pq, whole, seen = pytest.importorskip("pyarrow.parquet"), filings.merge_scd2, []

    def merge(table, source, *args, **options):
        staged = [pq.ParquetFile(f) for f in tmp_path.rglob("_staged/*/*.parquet")]
        seen.append(({*source.columns, *(n for f in staged for n in f.schema_arrow.names)}, {f.metadata.row_group(0).column(0).compression for f in staged if f.metadata.num_rows}, options["rows"]))
        return whole(table, source, *args, **options)

    monkeypatch.setattr(filings, "merge_scd2", merge)
    name = "bronze.filing_index_raw"
    bronze = spark.createDataFrame([("1", "10-K", "20240102"), ("2", "10-K", "20240231")], "accession_number string, form_type string, date_filed string")
    bronze = bronze.withColumns({"accession_number": F.lpad("accession_number", 18, "0"), "cik": F.lit("7"), "company_name": F.lit("c"), "logical_date": F.lit("2030-01-01").cast("date")})
    tables = {n: SnapshotTable(spark, str(tmp_path), n).create(filings.schema_of(n)) for n in (name, "silver.filing", "silver.filing_quarantine")}
    tables[name].append(align(bronze, filings.schema_of(name)))
    filings.run_filings(spark, str(tmp_path), "2030-01-01", "run", Report("silver", "run"))
    ((columns, codecs, rows),) = seen
    assert "filing_sk" not in columns and "accession_number" in columns and codecs == {"ZSTD"} and rows == 1
    (got,) = tables["silver.filing"].read().withColumn("want", surrogate_key(F.col("accession_number"))).collect()
    assert got.filing_sk == got.want and tables["silver.filing_quarantine"].read().count() == 1


def test_table_files_are_packed_by_an_entropy_coder(spark, tmp_path):
    """digests as text take half of their length in a table's files."""
    t = SnapshotTable(spark, str(tmp_path), "t").create(StructType.fromDDL("d string"))
    t.append(spark.range(0, 20_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("d")))
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 20_000 * 40
    assert t.read().distinct().count() == 20_000


def test_only_failing_rows_are_staged_with_their_record(spark, tmp_path):
    """the quarantine gets the record as it arrived; rows that pass are staged without it."""
    bronze = spark.createDataFrame([("1", "10-K", "20240102"), ("2", "10-K", "20240231")], "accession_number string, form_type string, date_filed string")
    bronze = align(bronze.withColumns({"accession_number": F.lpad("accession_number", 18, "0"), "cik": F.lit("7"), "company_name": F.lit("c"), "logical_date": F.lit("2030-01-01").cast("date")}), filings.schema_of("bronze.filing_index_raw"))
    quarantine = SnapshotTable(spark, str(tmp_path), "silver.filing_quarantine").create(filings.schema_of("silver.filing_quarantine"))
    with filings.check_and_quarantine(filings.build_filings(bronze), "silver.filing", "run", quarantine, Report("silver", "run")) as passed:
        staged = spark.read.parquet(f"{quarantine.path}/_staged/*")
        assert {r.accession_number[-1]: r["_raw"] is not None for r in staged.collect()} == {"1": False, "2": True}
        assert [r.accession_number[-1] for r in passed.collect()] == ["1"]
    (q,) = quarantine.read().collect()
    assert '"date_filed":"20240231"' in q.record_json and q["_dq_check_name"] == "filing_filed_date_present"
