import io
import json

import pytest
from test_landing import DAY, envelope, land

from factloom.operators.filings import TABLES, build_facts, create_tables, schema_of
from factloom.operators.publish import EXPORTED, build_manifest, verify_export
from factloom.operators.tables import MissingTable, SnapshotTable, require_tables
from factloom.runtime import jobs
from factloom.runtime.report import job_run
from factloom.runtime.settings import MissingSetting, resolve, run_id_for

NEXT = "2026-08-03"


def filing(n, **over):
    return {"form_type": "10-K", "company_name": "Acme", "cik": "1", "date_filed": "20260730", "accession_number": f"0000000001260000{n:02d}", "file_name": f"a/{n}.txt"} | over


def company(name):
    return {"cik": "1", "name": name, "sic": "10", "tickers": ["AC"], "formerNames": [{"name": "Old", "from": "x", "to": "y"}]}


def concept(*facts):
    return {"cik": 1, "taxonomy": "us-gaap", "tag": "Revenues", "units": {"USD": list(facts)}}


def value(v, n, filed, end="2025-12-31"):
    return {"start": "2025-01-01", "end": end, "val": v, "accn": f"0000000001-26-0000{n:02d}", "fy": 2025, "fp": "FY", "form": "10-K", "filed": filed}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("world"))
    make = lambda day: resolve(logical_date=day, landing_root=f"{root}/landing", warehouse=f"{root}/w", export_root=f"{root}/out")
    land(f"{root}/landing", "filing_index", [envelope("filing_index", "a", filing(1)), envelope("filing_index", "b", filing(2, accession_number="bad")), envelope("filing_index", "c", filing(3, date_filed="20260231"))])
    land(f"{root}/landing", "company_submissions", [envelope("company_submissions", "1", company("Acme"))])
    land(f"{root}/landing", "company_concept", [envelope("company_concept", "1/us-gaap/Revenues", concept(value(1000000, 1, "2026-02-01"), value(1100000, 2, "2026-05-01"), value(7, 3, "2026-05-01", "2025-06-30"))), envelope("company_concept", "1/us-gaap/Empty", {"cik": 1})])
    out = io.StringIO()
    first = jobs.run_all(spark, make(DAY), out)
    land(f"{root}/landing", "company_submissions", [envelope("company_submissions", "1", company("Acme Two"), logical_date=NEXT)], part=2, day=NEXT)
    second = jobs.run_all(spark, make(NEXT), out)
    return root, make, first, second, out.getvalue()


def test_reports(world):
    _, _, first, second, out = world
    lines = [json.loads(x) for x in out.splitlines()]
    assert [x["task"] for x in lines] == list(jobs.TASKS) * 2 and not any(x["status"] == "FAILED" for x in lines)
    assert first[0].metrics["filing_index.rows"] == 3 and second[0].metrics["filing_index.rows"] == 0
    assert first[1].metrics["dq.rows_quarantined"] == 4 - 1 and first[1].status == "WARN"


def test_bad_rows_are_quarantined_as_they_arrived(spark, world):
    root = world[0]
    q = SnapshotTable(spark, f"{root}/w", "silver.filing_quarantine").read().collect()
    assert {(r._dq_check_name, json.loads(r.record_json)["accession_number"], json.loads(r.record_json)["date_filed"]) for r in q} == {("filing_accession_format", "bad", "20260730"), ("filing_filed_date_present", "000000000126000003", "20260231")}
    assert {r._dq_check_name for r in SnapshotTable(spark, f"{root}/w", "silver.financial_fact_quarantine").read().collect()} == {"fact_accession_format"}


def test_versions_and_marts(spark, world):
    root = world[0]
    read = lambda n: SnapshotTable(spark, f"{root}/w", n).read()
    assert [(r.company_name, str(r.valid_from), str(r.valid_to), r.is_current) for r in read("silver.company").orderBy("version_number").collect()] == [("Acme", DAY, "2026-08-02", False), ("Acme Two", NEXT, "None", True)]
    facts = {r.accession_number[-2:]: (r.assertion_version, r.superseded_by_accession, r.is_current_assertion) for r in read("silver.financial_fact").collect()}
    assert facts == {"01": (1, "0000000001-26-000002", False), "02": (2, None, True), "03": (1, None, True)}
    (e,) = read("gold.restatement_event").collect()
    assert e.company_name == "Acme Two" and e.days_to_restatement == 89 and e._source_version is not None
    assert {r.was_restated for r in read("gold.financials_current").collect()} == {True, False}
    (p,) = read("gold.company_profile").collect()
    assert (p.filing_count, p.restatement_count) == (1, 1)
    assert read("gold.filing_activity_daily").count() == 1


def test_export(spark, world):
    root, make, *_ = world
    m = verify_export(spark, f"{root}/out")
    assert [t["table"] for t in m["tables"]] == list(EXPORTED) and m["gold_max_filed_date"] == "2026-07-30"
    for t in EXPORTED:
        assert spark.read.parquet(f"{root}/out/v1/{t}/data.parquet").count() == next(x["row_count"] for x in m["tables"] if x["table"] == t)
    assert build_manifest([], None, "r") == build_manifest([], None, "r")
    jobs.run_task(spark, "serving_export", make(NEXT), io.StringIO())
    again = verify_export(spark, f"{root}/out")
    assert [(t["table"], t["row_count"]) for t in again["tables"]] == [(t["table"], t["row_count"]) for t in m["tables"]]
    with pytest.raises(FileNotFoundError):
        verify_export(spark, f"{root}/nothing")


def test_silver_twice_is_the_same(spark, world):
    root, make, *_ = world
    read = lambda n: [tuple(r) for r in SnapshotTable(spark, f"{root}/w", n).read().drop("_last_seen_ts").orderBy("accession_number").collect()]
    before = read("silver.filing"), read("silver.financial_fact")
    jobs.run_task(spark, "silver_transform", make(NEXT), io.StringIO())
    assert (read("silver.filing"), read("silver.financial_fact")) == before


def test_views(spark, world):
    got = {n: df.count() for n, df in jobs.views(spark, world[1](NEXT)).items()}
    assert got == {"v_company_current": 1, "v_filing_current": 1, "v_financials_latest": 1, "v_restatement_history": 1, "v_company_timeline": 2, "v_pipeline_health": 4}
    assert spark.sql("select previous_company_name from v_company_timeline where version_number = 2").first()[0] == "Acme"


def test_documents_without_units_are_kept(spark):
    import datetime

    rows = [(datetime.date(2026, 7, 31), "r", None, "1", "us-gaap", "X", p, "b", "f") for p in ("{}", "{broken", json.dumps(concept(value(1, 1, "2026-01-01"))))]
    df = spark.createDataFrame(rows, "logical_date date, resource_id string, fetched_at timestamp, cik string, taxonomy string, tag string, payload_json string, _ingest_batch_id string, _source_file string")
    assert [r.value for r in build_facts(df).orderBy("value").collect()][:2] == [None, None]


def test_preflight_names_every_missing_table(spark, tmp_path):
    with pytest.raises(MissingTable) as e:
        require_tables(spark, str(tmp_path), ["a", "b"])
    assert e.value.missing == ["a", "b"]
    create_tables(spark, str(tmp_path))
    require_tables(spark, str(tmp_path), list(TABLES))


VERSION = {"version_number", "valid_from", "valid_to", "is_current", "_hash_diff"}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_layer_can_be_told_from_columns(name):
    cols = set(schema_of(name).names)
    layer = name.split(".")[0]
    assert ({"_ingest_ts"} <= cols) == (layer == "bronze") and ({"_generated_at"} <= cols) == (layer == "gold")
    assert VERSION <= cols if name in ("silver.filing", "silver.company") else not (cols & {"version_number", "_hash_diff"})
    assert ("_dq_record_id" in cols) == name.endswith("_quarantine")


def test_settings(monkeypatch):
    given = {"logical_date": DAY, "landing_root": "/l", "warehouse": "/w", "export_root": "/e"}
    s = resolve(**given)
    assert s.checkpoint_root == "/l/_checkpoints" and s.run_id == resolve(**given).run_id
    monkeypatch.setenv("FACTLOOM_ENVIRONMENT", "prod")
    assert resolve(**given).environment == "prod"
    for key in given:
        with pytest.raises(MissingSetting, match=key):
            resolve(**{k: v for k, v in given.items() if k != key})
    for bad in ({"logical_date": "2026-02-30"}, {"logical_date": "20260731"}, {"ingest_mode": "x"}, {"storage_mode": "x"}):
        with pytest.raises(ValueError):
            resolve(**given | bad)
    with pytest.raises(ValueError, match="one machine"):
        resolve(**given | {"storage_mode": "shared"})
    assert resolve(**{k: v if k == "logical_date" else f"hdfs://h{v}" for k, v in given.items()}, storage_mode="shared").storage_mode == "shared"
    assert run_id_for("t", DAY, "a", "b") == run_id_for("t", DAY, "b", "a") != run_id_for("t", NEXT, "a", "b")


def test_report_is_emitted_whatever_happens():
    out = io.StringIO()
    with pytest.raises(KeyError):
        with job_run("t", "r", out) as report:
            report.add("n", 1)
            report.add("n", 2)
            report.warn("w")
            raise KeyError("x")
    got = json.loads(out.getvalue())
    assert got["status"] == "FAILED" and got["metrics"] == {"n": 3} and got["warnings"] == ["w"] and "KeyError" in got["error"]


def test_command_line(capsys):
    assert jobs.main([]) == 2 and "bronze_ingest" in capsys.readouterr().err
    with pytest.raises(MissingSetting):
        jobs.main(["gold_build", "logical_date="])


def test_marts_name_the_versions_of_all_inputs(spark, world):
    root = world[0]
    made = {n: SnapshotTable(spark, f"{root}/w", f"gold.{n}").manifest()["inputs"] for n in EXPORTED}
    assert set(made["company_profile"]) == {"silver.company", "silver.filing", "gold.restatement_event"}
    # Another test may have run silver once more since.
    assert 1 <= made["restatement_event"]["silver.financial_fact"] <= SnapshotTable(spark, f"{root}/w", "silver.financial_fact").version()


def test_replay_of_all_landed_days(spark, world, capsys):
    root, make, *_ = world
    assert jobs.landed_days(spark, f"{root}/landing") == [DAY, NEXT]
    again = resolve(logical_date=NEXT, landing_root=f"{root}/landing", warehouse=f"{root}/w2", export_root=f"{root}/out2", checkpoint_root=f"{root}/ck2")
    reports = jobs.replay(spark, again)
    assert [r.task for r in reports] == list(jobs.TASKS) * 2
    rows = lambda w: sorted(map(str, SnapshotTable(spark, f"{root}/{w}", "silver.company").read().select("cik", "company_name", "version_number", "valid_from", "valid_to").collect()))
    assert rows("w2") == rows("w")


def test_gold_kept_by_changes_equals_a_rebuild(spark, tmp_path):
    root, days = str(tmp_path), (DAY, NEXT)
    land(f"{root}/landing", "filing_index", [envelope("filing_index", str(n), filing(n, cik=str(n % 3))) for n in range(1, 7)])
    land(f"{root}/landing", "company_submissions", [envelope("company_submissions", "1", company("Acme"))])
    land(f"{root}/landing", "company_concept", [envelope("company_concept", "1/us-gaap/Revenues", concept(value(1000000, 1, "2026-02-01"), value(1100000, 2, "2026-05-01"), value(7, 3, "2026-05-01", "2025-06-30")))])
    land(f"{root}/landing", "filing_index", [envelope("filing_index", "2", filing(2, form_type="10-K/A"), logical_date=NEXT)], part=2, day=NEXT)
    land(f"{root}/landing", "company_submissions", [envelope("company_submissions", "1", company("Acme Two"), logical_date=NEXT)], part=2, day=NEXT)
    land(f"{root}/landing", "company_concept", [envelope("company_concept", "1/us-gaap/Revenues", concept(value(9, 4, "2026-06-01", "2025-06-30")), logical_date=NEXT)], part=2, day=NEXT)
    rows, reports = {}, {}
    for mode in ("rebuild", "changes"):
        for day in days:
            s = resolve(logical_date=day, landing_root=f"{root}/landing", warehouse=f"{root}/{mode}", export_root=f"{root}/{mode}-out", checkpoint_root=f"{root}/{mode}-state", gold_mode=mode, ingest_mode="batch")
            reports[mode] = jobs.run_all(spark, s, io.StringIO())
        gold = {n: SnapshotTable(spark, f"{root}/{mode}", f"gold.{n}").read() for n in EXPORTED}
        rows[mode] = {n: sorted(str(r) for r in df.drop("_generated_at", "_run_id", "_source_version").collect()) for n, df in gold.items()}
    assert rows["changes"] == rows["rebuild"] and all(rows["changes"].values()) and len(rows["changes"]["restatement_event"]) == 2
    m = reports["changes"][2].metrics
    assert m["restatement_event.rebuilt"] == m["financials_current.rebuilt"] == m["filing_activity_daily.rebuilt"] == 0
    # A rebuild of the same warehouse, and changes after it.
    for mode in ("rebuild", "changes"):
        s = resolve(logical_date=NEXT, landing_root=f"{root}/landing", warehouse=f"{root}/changes", export_root=f"{root}/out", checkpoint_root=f"{root}/changes-state", gold_mode=mode)
        jobs.run_task(spark, "gold_build", s, io.StringIO())
        assert {n: sorted(str(r) for r in SnapshotTable(spark, f"{root}/changes", f"gold.{n}").read().drop("_generated_at", "_run_id", "_source_version").collect()) for n in EXPORTED} == rows["rebuild"]
