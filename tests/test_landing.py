import gzip
import json
import os

import pytest

from factloom.operators.filings import schema_of
from factloom.operators.tables import SnapshotTable
from factloom.sources import landing
from factloom.streaming.ingest import ingest_batch, ingest_stream, read_stream
from factloom.streaming.stateful import first_arrivals

DAY = "2026-07-31"


def envelope(stream, resource, payload, **over):
    return {"envelope_version": "1", "source_system": "fixture", "stream": stream, "resource_id": resource, "logical_date": DAY, "batch_id": f"{stream}-{DAY}", "fetched_at": f"{DAY}T12:00:00Z", "request_url": "u", "http_status": 200, "content_sha256": "c", "payload_json": json.dumps(payload)} | over


def land(root, stream, rows, part=1, day=DAY, zipped=False):
    folder = os.path.join(root, stream, f"logical_date={day}")
    os.makedirs(folder, exist_ok=True)
    text = "".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    path = os.path.join(folder, f"part-{part:05d}.json" + (".gz" if zipped else ""))
    with gzip.open(path, "wt") if zipped else open(path, "w") as f:
        f.write(text)


FILING = {"form_type": "10-K", "company_name": "Acme", "cik": "1", "date_filed": "20260730", "accession_number": "000000000126000001", "file_name": "x.txt"}


def bronze(spark, tmp_path, name):
    table = f"bronze.{landing.stream(name).table}"
    return SnapshotTable(spark, f"{tmp_path}/w", table).create(schema_of(table))


def test_paths_and_registry():
    assert landing.landing_path("s3a://b/x/", "filing_index", DAY) == f"s3a://b/x/filing_index/logical_date={DAY}"
    assert landing.checkpoint_path("r", "filing_index") != landing.checkpoint_path("r", "company_concept")
    with pytest.raises(KeyError, match="filing_index"):
        landing.stream("nope")


def test_rescue(spark):
    rows = [
        envelope("filing_index", "a", FILING), envelope("filing_index", "b", FILING, extra=1), envelope("filing_index", "c", FILING, _injected="y"),
        envelope("filing_index", "d", FILING, http_status="oops"), "{broken", "",
    ]
    lines = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string")
    got = {r.resource_id: r for r in landing.parse_envelopes(lines).collect()}
    assert len(got) == 5
    assert got["a"]._rescued_data is None and json.loads(got["b"]._rescued_data) == {"extra": "1"} and json.loads(got["c"]._rescued_data) == {"_injected": "y"}
    assert got["d"].http_status is None and json.loads(got["d"]._rescued_data) == {"http_status": "oops"}
    assert got[None]._malformed == "{broken" and got["a"].http_status == 200


@pytest.mark.parametrize("ingest", [ingest_batch, ingest_stream])
def test_second_run_reads_nothing_and_new_files_are_found(spark, tmp_path, ingest):
    root, t = f"{tmp_path}/landing", bronze(spark, tmp_path, "filing_index")
    land(root, "filing_index", [envelope("filing_index", "a", FILING), envelope("filing_index", "b", FILING, odd=1)])
    assert ingest(spark, root, "filing_index", t, f"{tmp_path}/ck") == {"rows": 2, "rescued": 1}
    assert ingest(spark, root, "filing_index", t, f"{tmp_path}/ck") == {"rows": 0, "rescued": 0}
    land(root, "filing_index", [envelope("filing_index", "c", FILING)], part=2, zipped=True)
    assert ingest(spark, root, "filing_index", t, f"{tmp_path}/ck")["rows"] == 1
    rows = t.read().orderBy("resource_id").collect()
    assert [r.resource_id for r in rows] == ["a", "b", "c"] and rows[0].form_type == "10-K" and str(rows[0].logical_date) == DAY and rows[0]._source_file.endswith(".json")


def test_a_batch_that_runs_again_is_not_written_twice(spark, tmp_path):
    import os

    root, t, ck = f"{tmp_path}/landing", bronze(spark, tmp_path, "filing_index"), f"{tmp_path}/ck"
    land(root, "filing_index", [envelope("filing_index", "a", FILING)])
    ingest_stream(spark, root, "filing_index", t, ck)
    # As after a crash between the append and the query's own commit.
    for f in os.listdir(folder := f"{landing.checkpoint_path(ck, 'filing_index')}/commits"):
        os.remove(f"{folder}/{f}")
    ingest_stream(spark, root, "filing_index", t, ck)
    assert t.read().count() == 1
    # A new checkpoint is a new query: its first batch is not taken for the old one's.
    ingest_stream(spark, root, "filing_index", t, f"{tmp_path}/other")
    assert t.read().count() == 2


@pytest.mark.parametrize("ingest", [ingest_batch, ingest_stream])
def test_unknown_version_fails_the_batch(spark, tmp_path, ingest):
    root, t = f"{tmp_path}/landing", bronze(spark, tmp_path, "filing_index")
    land(root, "filing_index", [envelope("filing_index", "a", FILING), envelope("filing_index", "b", FILING, envelope_version="2")])
    with pytest.raises(Exception, match="envelope versions"):
        ingest(spark, root, "filing_index", t, f"{tmp_path}/ck")
    assert t.version() == 0
    # The file is not in the ledger: with the version supported it is read.
    assert ingest(spark, root, "filing_index", t, f"{tmp_path}/ck", supported=("1", "2"))["rows"] == 2


def test_missing_root_is_empty_with_a_schema(spark, tmp_path):
    b = landing.read_landing_batch(spark, f"{tmp_path}/none", "company_concept", f"{tmp_path}/ck")
    assert b.is_empty and b.frame.count() == 0 and set(landing.ENVELOPE.names) <= set(b.frame.columns)


def test_one_day_alone(spark, tmp_path):
    root = f"{tmp_path}/landing"
    for day in ("2026-07-30", DAY):
        land(root, "filing_index", [envelope("filing_index", day, FILING)], day=day)
    assert len(landing.landing_files(spark, root, "filing_index", DAY)) == 1
    b = landing.read_landing_batch(spark, root, "filing_index", f"{tmp_path}/ck", file_filter=lambda p: DAY not in p)
    assert len(b.files) == 1 and DAY not in b.files[0]


def test_short_resource_ids(spark):
    lines = spark.createDataFrame([(json.dumps(envelope("company_concept", r, {})),) for r in ("1/us-gaap/Revenues", "1/us-gaap", "1")], "value string")
    rows = landing.parse_envelopes(lines.selectExpr("value", "'f' as _source_file"))
    got = [(r.cik, r.taxonomy, r.tag) for r in landing.project_company_concept(landing.with_metadata(rows)).collect()]
    assert got == [("1", "us-gaap", "Revenues"), ("1", "us-gaap", None), ("1", None, None)]


def test_stream_drops_repeats(spark, tmp_path):
    root = f"{tmp_path}/landing"
    land(root, "filing_index", [envelope("filing_index", "a", FILING)] * 3)
    q = first_arrivals(read_stream(spark, root, "filing_index")).writeStream.format("memory").queryName("firsts").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == 1


def test_index_lines(spark):
    text = ["Form Type   Company Name   CIK   Date Filed  File Name", "-" * 60, "10-K        ACME  & SONS INC          320193      20260730    data/320193/0000320193-26-000001.txt", "8-K/A       B CO      7   2026-07-30  data/7/0000000007-26-000002.txt"]
    got = landing.parse_index(spark.createDataFrame([(t,) for t in text], "value string"))
    rows = got.orderBy("cik").collect()
    assert [(r.form_type, r.cik, r.accession_number) for r in rows] == [("10-K", "320193", "0000320193-26-000001"), ("8-K/A", "7", "0000000007-26-000002")]
    assert [r.cik for r in landing.select_filings(got, 1, forced=["7"]).collect()] == ["7"]
    assert [r.form_type for r in landing.select_filings(got, 1, ranks={"8-K/A": 1}).collect()] == ["8-K/A"]


def test_trim_recent(spark):
    whole = {"cik": 7, "name": "X", "filings": {"recent": {"a": [1, 2, 3], "b": ["x", "y", "z"], "n": 4}, "files": [{"q": 1}], "more": True}, "list": [1, 2, 3]}
    want = whole | {"filings": {"recent": {"a": [1, 2], "b": ["x", "y"], "n": 4}, "files": [], "more": True}}
    texts = [json.dumps(whole), '{"a": 1}', '{"filings": {"recent": null, "files": [1]}}', "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r.t and json.loads(r.t) for r in df.select(landing.trim_recent(df.p, 2).alias("t")).collect()]
    assert got == [want, {"a": 1}, {"filings": {"recent": None, "files": [1]}}, None, None]


def test_selection_keeps_forms_of_interest_and_forced_ids(spark):
    rows = [("10-K", "7", "c"), ("4", "8", "a"), ("8-K", "9", "b"), ("4", "0000000010", "d"), ("10-K", "11", "a")]
    df = spark.createDataFrame(rows, "form_type string, cik string, accession_number string")
    pick = lambda n, **o: [(r.form_type, r.cik) for r in landing.select_filings(df, n, **o).collect()]
    ranks = {"10-K": 0, "8-K": 1}
    assert pick(9, ranks=ranks) == [("10-K", "11"), ("10-K", "7"), ("8-K", "9")]
    assert pick(9, ranks=ranks, forced=["10", "0000000008"]) == [("4", "8"), ("4", "0000000010"), ("10-K", "11"), ("10-K", "7"), ("8-K", "9")]
    assert len(pick(9)) == 5 and pick(1, ranks=ranks) == [("10-K", "11")]
