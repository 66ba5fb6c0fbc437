"""The four tasks, in order, and a command line: python -m factloom.runtime.jobs TASK key=value ..."""

from __future__ import annotations

import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from ..functions.keys import surrogate_key
from ..operators import filings, incremental, marts, publish
from ..operators.tables import SnapshotTable, require_tables
from ..sources import landing
from ..streaming.ingest import ingest_batch, ingest_stream
from .lease import held
from .report import Report, job_run
from .settings import Settings, batch_id_for, resolve, run_id_for


def _table(spark, s: Settings, name: str) -> SnapshotTable:
    return SnapshotTable(spark, s.warehouse, name)


def bronze_ingest(spark: SparkSession, s: Settings, report: Report) -> None:
    for name in landing.STREAMS:
        table = _table(spark, s, f"bronze.{landing.stream(name).table}")
        one = {"batch_id": batch_id_for(name, s.logical_date)}
        got = ingest_stream(spark, s.landing_root, name, table, s.checkpoint_root, **one) if s.ingest_mode == "stream" else ingest_batch(spark, s.landing_root, name, table, s.checkpoint_root, s.logical_date, **one)
        for k, v in got.items():
            report.add(f"{name}.{k}", v)
        if got["rescued"]:
            report.warn(f"{name}: {got['rescued']} rows with unknown fields")


def silver_transform(spark: SparkSession, s: Settings, report: Report) -> None:
    for name, run in (("filing", filings.run_filings), ("company", filings.run_companies), ("financial_fact", filings.run_facts)):
        for k, v in run(spark, s.warehouse, s.logical_date, report.run_id, report).items():
            report.record(f"{name}.{k}", v)


def gold_build(spark: SparkSession, s: Settings, report: Report) -> None:
    """Change events first, as the other marts read them.

    With gold_mode=changes, events, current assertions and daily activity are kept by what their sources have changed since the marts
    were made; company profiles, one small row for each company, are rebuilt in either mode.
    """
    versions: dict[str, int | None] = {}
    version = lambda n: versions.setdefault(n, _table(spark, s, n).version())
    # What is read is the version that is noted, whatever other writers do meanwhile.
    read = lambda n: _table(spark, s, n).read(version(n))
    companies = marts.current_rows(read("silver.company"))
    filed = marts.current_rows(read("silver.filing"))
    facts, names = read("silver.financial_fact"), companies.select("cik", "company_name")

    def put(name: str, df, source: str, *more: str) -> None:
        inputs = {n: version(n) for n in (source, *more)}
        report.record(f"{name}.rows", publish.write_mart(_table(spark, s, f"gold.{name}"), df, report.run_id, inputs[source], inputs=inputs)["rows"])

    def keep(name: str, build, inputs: dict) -> None:
        got = incremental.update_by_bucket(_table(spark, s, "silver.financial_fact"), _table(spark, s, f"gold.{name}"), build, [surrogate_key(*marts.FACT_GRAIN)], report.run_id, names=_table(spark, s, "silver.company"), inputs=inputs)
        for k, v in got.items():
            report.record(f"{name}.{k}", v)

    if s.gold_mode == "changes":
        keep("restatement_event", lambda rows, _: marts.change_events(rows, names=names), {})
        made = _table(spark, s, "gold.restatement_event")
        keep("financials_current", lambda rows, hit: marts.current_assertion(rows, incremental.in_buckets(made, hit, version(made.name)), names=names), {made.name: version(made.name)})
        support = _table(spark, s, "gold._filing_activity_support").create(incremental.support_schema(filed.schema, ["filed_date", "base_form_type"], "cik"))
        for k, v in incremental.update_activity(_table(spark, s, "silver.filing"), support, _table(spark, s, "gold.filing_activity_daily"), report.run_id, inputs={"silver.filing": version("silver.filing")}).items():
            report.record(f"filing_activity_daily.{k}", v)
    else:
        put("restatement_event", marts.change_events(facts, names=names), "silver.financial_fact", "silver.company")
        put("financials_current", marts.current_assertion(facts, read("gold.restatement_event"), names=names), "silver.financial_fact", "gold.restatement_event", "silver.company")
        put("filing_activity_daily", marts.daily_activity(filed), "silver.filing")
    events = read("gold.restatement_event")
    put("company_profile", marts.entity_profile(companies, filed, events), "silver.company", "silver.filing", "gold.restatement_event")
    report.record("source_versions", {n: version(n) for n in ("silver.company", "silver.filing", "silver.financial_fact")})


def serving_export(spark: SparkSession, s: Settings, report: Report) -> None:
    for e in publish.export_all(spark, s.warehouse, s.export_root, report.run_id):
        report.record(f"{e.table}.rows", e.row_count)
    publish.verify_export(spark, s.export_root)


TASKS = {f.__name__: f for f in (bronze_ingest, silver_transform, gold_build, serving_export)}


def run_task(spark: SparkSession, task: str, s: Settings, out=None) -> Report:
    run_id = run_id_for(task, s.logical_date)
    with job_run(task, run_id, out) as report, held(spark, s.warehouse, run_id):
        report.record("environment", s.environment)
        require_tables(spark, s.warehouse, list(filings.TABLES))
        TASKS[task](spark, s, report)
    return report


def run_all(spark: SparkSession, s: Settings, out=None) -> list[Report]:
    """All four tasks for one day, tables created if need be."""
    filings.create_tables(spark, s.warehouse)
    return [run_task(spark, t, s, out) for t in TASKS]


def landed_days(spark: SparkSession, root: str) -> list[str]:
    """Logical dates that any stream has landed, in order."""
    found = {p.split("logical_date=", 1)[1].split("/", 1)[0] for name in landing.STREAMS for p in landing.landing_files(spark, root, name) if "logical_date=" in p}
    return sorted(found)


def replay(spark: SparkSession, s: Settings, days: list[str] | None = None, out=None) -> list[Report]:
    """run_all() for each day in order; all landed days by default."""
    days = landed_days(spark, s.landing_root) if days is None else sorted(days)
    return [r for day in days for r in run_all(spark, replace(s, logical_date=day), out)]


def views(spark: SparkSession, s: Settings) -> dict:
    """The read-only views, as frames and temporary views."""
    read = lambda n: _table(spark, s, n).read()
    found = {
        "v_company_current": marts.current_rows(read("silver.company")),
        "v_filing_current": marts.current_rows(read("silver.filing")),
        "v_financials_latest": marts.latest_by_period(read("gold.financials_current"), ["cik", "concept_canonical", "unit", "period_type"], "period_end"),
        "v_restatement_history": read("gold.restatement_event"),
        "v_company_timeline": marts.timeline(read("silver.company"), ["cik"], ["company_name", "sic", "state_of_incorporation"]),
        "v_pipeline_health": marts.pipeline_health({"silver.filing": (read("silver.filing"), "filed_date"), "silver.company": (read("silver.company"), "valid_from"), "silver.financial_fact": (read("silver.financial_fact"), "filed_date"), "gold.restatement_event": (read("gold.restatement_event"), "restated_filed_date")}),
    }
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in {*TASKS, "all"}:
        print(f"usage: TASK key=value ...; tasks are {', '.join(TASKS)}, all (with days=FIRST,SECOND,... or days=landed), and sql=... to be shown over the views", file=sys.stderr)
        return 2
    given = dict(a.split("=", 1) for a in argv[1:])
    days, sql = given.pop("days", ""), given.pop("sql", "")
    if days and days != "landed":
        given.setdefault("logical_date", max(days.split(",")))
    s = resolve(**{k: v for k, v in given.items() if v})
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if argv[0] == "all" and days:
        replay(spark, s, None if days == "landed" else days.split(","))
    elif argv[0] == "all":
        run_all(spark, s)
    else:
        run_task(spark, argv[0], s)
    if sql:
        views(spark, s)
        spark.sql(sql).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

