"""Bronze to silver: typed filings, companies and financial facts, and the runs that publish them."""

from __future__ import annotations

import contextlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import concepts, normalise
from ..functions.keys import surrogate_key
from ..functions.tolerance import MONEY
from . import quality
from .frame import unused
from .tables import CODEC, SnapshotTable
from .versioning import PLACE, grain_counts, merge_scd1, merge_scd2, order_assertions

FILING_TRACKED = ["form_type", "base_form_type", "is_amendment", "company_name", "primary_doc_url"]
COMPANY_TRACKED = ["company_name", "sic", "sic_description", "ein", "entity_type", "state_of_incorporation", "fiscal_year_end", "tickers", "exchanges", "former_names"]
FACT_KEY = ["cik", "taxonomy", "concept_tag", "unit", "period_start", "period_end", "period_type", "accession_number"]
LATEST = ["logical_date", "_ingest_batch_id", "_source_file"]
# Payload fields, and names and types of the columns of all tables.
SUBMISSION = "cik string, entityType string, sic string, sicDescription string, name string, ein string, fiscalYearEnd string, stateOfIncorporation string, tickers array<string>, exchanges array<string>, formerNames array<struct<name:string,from:string,to:string>>"
CONCEPT = "cik string, taxonomy string, tag string, entityName string, units map<string,array<struct<start:string,end:string,val:decimal(38,6),accn:string,fy:int,fp:string,form:string,filed:string,frame:string,decimals:int>>>"

_VERSION = "version_number int, valid_from date, valid_to date, is_current boolean, _hash_diff string"
_LINEAGE = "_first_seen_ts timestamp, _last_seen_ts timestamp, _ingest_batch_id string, _source_file string"
_PROVENANCE = "_generated_at timestamp, _run_id string, _source_version bigint"
_BRONZE = "logical_date date, resource_id string, fetched_at timestamp"
_META = "_ingest_batch_id string, _ingest_ts timestamp, _source_file string, _source_system string, _envelope_version string, _rescued_data string"
_QUARANTINE = "_dq_record_id string, _dq_run_id string, _dq_check_name string, _dq_failure_reason string, _quarantined_at timestamp, _source_table string, _source_file string, _ingest_batch_id string, record_json string"
_GRAIN = "cik string, concept_canonical string, unit string, period_start date, period_end date, period_type string"

#: Schemas of all tables, as DDL.
TABLES = {
    "bronze.filing_index_raw": f"{_BRONZE}, form_type string, company_name string, cik string, date_filed string, accession_number string, file_name string, {_META}",
    "bronze.company_submissions_raw": f"{_BRONZE}, cik string, payload_json string, {_META}",
    "bronze.company_concept_raw": f"{_BRONZE}, cik string, taxonomy string, tag string, payload_json string, {_META}",
    "silver.filing": f"filing_sk string, accession_number string, cik string, company_name string, form_type string, base_form_type string, is_amendment boolean, filed_date date, primary_doc_url string, logical_date date, {_VERSION}, {_LINEAGE}",
    "silver.company": f"company_sk string, cik string, company_name string, sic string, sic_description string, ein string, entity_type string, state_of_incorporation string, fiscal_year_end string, tickers array<string>, exchanges array<string>, former_names array<string>, {_VERSION}, {_LINEAGE}",
    "silver.financial_fact": f"fact_sk string, cik string, taxonomy string, concept_tag string, concept_canonical string, unit string, period_start date, period_end date, period_type string, accession_number string, value {MONEY}, decimals int, fiscal_year int, fiscal_period string, form_type string, filed_date date, frame string, logical_date date, assertion_version int, is_current_assertion boolean, superseded_by_accession string, {_LINEAGE}",
    "silver.filing_quarantine": _QUARANTINE,
    "silver.company_quarantine": _QUARANTINE,
    "silver.financial_fact_quarantine": _QUARANTINE,
    "gold.restatement_event": f"restatement_id string, {_GRAIN}, original_accession_number string, original_form_type string, original_filed_date date, original_value {MONEY}, original_decimals int, restated_accession_number string, restated_form_type string, restated_filed_date date, restated_value {MONEY}, restated_decimals int, delta_abs {MONEY}, delta_pct double, days_to_restatement int, materiality_band string, company_name string, {_PROVENANCE}",
    "gold.financials_current": f"{_GRAIN}, accession_number string, value {MONEY}, decimals int, fiscal_year int, fiscal_period string, form_type string, filed_date date, assertion_count int, was_restated boolean, company_name string, {_PROVENANCE}",
    "gold.filing_activity_daily": f"filed_date date, base_form_type string, filing_count int, amendment_count int, distinct_cik_count int, {_PROVENANCE}",
    "gold.company_profile": f"cik string, company_name string, sic string, sic_description string, entity_type string, state_of_incorporation string, fiscal_year_end string, tickers array<string>, exchanges array<string>, filing_count int, first_filed_date date, last_filed_date date, restatement_count int, {_PROVENANCE}",
}


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def create_tables(spark: SparkSession, root: str, buckets: dict[str, int] | None = None) -> None:
    """All tables that are not there; `buckets` gives large merged tables their number of buckets, which versioning.rebucket() changes."""
    for name in TABLES:
        SnapshotTable(spark, root, name).create(schema_of(name), (buckets or {}).get(name))


def build_filings(bronze: DataFrame) -> DataFrame:
    """Typed filings; _raw keeps each row as it arrived, for the quarantine."""
    n = normalise
    form = n.form_type(F.col("form_type"))
    return bronze.select(
        surrogate_key(n.accession(F.col("accession_number"))).alias("filing_sk"), n.accession(F.col("accession_number")).alias("accession_number"), n.cik(F.col("cik")).alias("cik"),
        F.nullif(F.trim("company_name"), F.lit("")).alias("company_name"), form.alias("form_type"), n.base_form_type(form).alias("base_form_type"), n.is_amendment(form).alias("is_amendment"),
        n.filing_date(F.col("date_filed")).alias("filed_date"), n.document_url(F.col("file_name")).alias("primary_doc_url"), "logical_date", "_ingest_batch_id", "_source_file",
        F.struct("resource_id", "form_type", "company_name", "cik", "date_filed", "accession_number", "file_name").alias("_raw"),
    )


def build_companies(bronze: DataFrame) -> DataFrame:
    """Companies from submission documents; lists that are not there are empty."""
    empty = F.array().cast("array<string>")
    d = bronze.withColumn("d", F.from_json("payload_json", SUBMISSION))
    cik = F.coalesce(normalise.cik(F.col("d.cik")), normalise.cik(F.col("cik")))
    return d.select(
        surrogate_key(cik).alias("company_sk"), cik.alias("cik"), F.nullif(F.trim("d.name"), F.lit("")).alias("company_name"), F.col("d.sic").alias("sic"), F.col("d.sicDescription").alias("sic_description"), F.col("d.ein").alias("ein"),
        F.col("d.entityType").alias("entity_type"), F.col("d.stateOfIncorporation").alias("state_of_incorporation"), F.col("d.fiscalYearEnd").alias("fiscal_year_end"),
        F.coalesce("d.tickers", empty).alias("tickers"), F.coalesce("d.exchanges", empty).alias("exchanges"), F.coalesce(F.transform("d.formerNames", lambda x: x["name"]), empty).alias("former_names"),
        "logical_date", "_ingest_batch_id", "_source_file", F.struct("resource_id", "payload_json").alias("_raw"),
    )


def build_facts(bronze: DataFrame) -> DataFrame:
    """One row for each unit and assertion of a concept document; a document without units gives one row of NULLs.

    fact_sk names the fact and not the assertion: concept (its tag where it is not mapped), unit and whole period.
    """
    d = bronze.withColumn("d", F.from_json("payload_json", CONCEPT))
    keep = ["resource_id", "logical_date", "_ingest_batch_id", "_source_file"]
    d = d.select(*keep, F.coalesce(normalise.cik(F.col("d.cik")), normalise.cik(F.col("cik"))).alias("cik"), F.coalesce("d.taxonomy", "taxonomy").alias("taxonomy"), F.coalesce("d.tag", "tag").alias("concept_tag"), F.col("d.units").alias("units"))
    named = [*keep, "cik", "taxonomy", "concept_tag"]
    d = d.select(*named, F.explode_outer("units").alias("unit", "facts")).select(*named, "unit", F.explode_outer("facts").alias("x"))
    rows = d.select(
        "cik", "taxonomy", "concept_tag", concepts.canonical_concept(F.col("taxonomy"), F.col("concept_tag")).alias("concept_canonical"), "unit",
        F.try_to_date("x.start", "yyyy-MM-dd").alias("period_start"), F.try_to_date("x.end", "yyyy-MM-dd").alias("period_end"), F.when(F.col("x.start").isNull(), "instant").otherwise("duration").alias("period_type"),
        normalise.accession(F.col("x.accn")).alias("accession_number"), F.col("x.val").alias("value"), F.col("x.decimals").alias("decimals"), F.col("x.fy").alias("fiscal_year"), F.col("x.fp").alias("fiscal_period"), F.col("x.form").alias("form_type"),
        F.try_to_date("x.filed", "yyyy-MM-dd").alias("filed_date"), F.col("x.frame").alias("frame"), "logical_date", "_ingest_batch_id", "_source_file", F.struct("resource_id", "unit", F.to_json("x").alias("fact")).alias("_raw"),
    )
    concept = F.coalesce("concept_canonical", F.concat_ws("|", "taxonomy", "concept_tag"))
    return rows.withColumn("fact_sk", surrogate_key(F.col("cik"), concept, F.col("unit"), F.col("period_start"), F.col("period_end"), F.col("period_type")))


@contextlib.contextmanager
def check_and_quarantine(rows: DataFrame, table: str, run_id: str, quarantine: SnapshotTable, report):
    """The rows that pass; the others are merged into the quarantine.

    Typed rows are written once, as counts, quarantine and what passes are all made from them; the copy goes in the end.  A
    batch without a reject leaves the quarantine as it is.
    """
    staged, checks = f"{quarantine.path}/_staged/{uuid.uuid4().hex}", quality.CHECKS[table.split(".")[-1]]
    # Only rows that fail a check need the record as it arrived.
    failed = reduce(Column.__or__, [c.failed() for c in checks if c.severity != quality.WARN], F.lit(False))
    rows.withColumn("_raw", F.when(failed, F.col("_raw"))).write.option("compression", CODEC).parquet(staged)
    try:
        typed = quarantine.spark.read.schema(rows.schema).parquet(staged)
        checked = quality.apply_checks(typed, checks, run_id, table, raw="_raw")
        if checked.metrics["dq.rows_quarantined"]:
            merge_scd1(quarantine, checked.quarantined, ["_dq_record_id"], operation="quarantine", rows=checked.metrics["dq.rows_quarantined"])
        for k, v in checked.metrics.items():
            report.add(k, v)
        if checked.has_warnings:
            report.warn("data quality warnings")
        yield checked.passed.drop("_raw")
    finally:
        quarantine.store.delete(staged)


def _of_day(spark: SparkSession, root: str, name: str, logical_date: str) -> DataFrame:
    """Bronze rows of a day; only the parts that hold it are read."""
    return SnapshotTable(spark, root, name).read(days=[logical_date]).where(F.col("logical_date") == F.lit(logical_date).cast("date"))


def run_filings(spark: SparkSession, root: str, logical_date: str, run_id: str, report) -> dict:
    # Surrogates are neither staged nor dealt: the merge makes them from the key.
    made = {"filing_sk": lambda p: surrogate_key(F.col(f"{p}accession_number"))}
    rows = build_filings(_of_day(spark, root, "bronze.filing_index_raw", logical_date)).drop(*made)
    with check_and_quarantine(rows, "silver.filing", run_id, SnapshotTable(spark, root, "silver.filing_quarantine"), report) as passed:
        return merge_scd2(SnapshotTable(spark, root, "silver.filing"), passed, ["accession_number"], FILING_TRACKED, logical_date, latest_by=LATEST, made=made, rows=passed.count())


def run_companies(spark: SparkSession, root: str, logical_date: str, run_id: str, report) -> dict:
    made = {"company_sk": lambda p: surrogate_key(F.col(f"{p}cik"))}
    rows = build_companies(_of_day(spark, root, "bronze.company_submissions_raw", logical_date)).drop(*made).withColumn("valid_from", F.lit(logical_date).cast("date"))
    with check_and_quarantine(rows, "silver.company", run_id, SnapshotTable(spark, root, "silver.company_quarantine"), report) as passed:
        return merge_scd2(SnapshotTable(spark, root, "silver.company"), passed.drop("valid_from"), ["cik"], COMPANY_TRACKED, logical_date, latest_by=LATEST, made=made, rows=passed.count())


def ordered_facts(merged: DataFrame) -> DataFrame:
    """Merged facts with each fact's assertions numbered anew."""
    preference = unused(merged, "_preference")
    rows = merged.withColumn(preference, concepts.tag_preference(F.col("taxonomy"), F.col("concept_tag")))
    return order_assertions(rows, [c for c in (PLACE, "fact_sk") if c in merged.columns], ["filed_date", "accession_number", preference, "concept_tag"]).drop(preference)


def run_facts(spark: SparkSession, root: str, logical_date: str, run_id: str, report) -> dict:
    """Merge the day's facts by their full key and number the assertions of the facts' buckets anew, in one write."""
    rows = build_facts(_of_day(spark, root, "bronze.company_concept_raw", logical_date))
    with check_and_quarantine(rows, "silver.financial_fact", run_id, SnapshotTable(spark, root, "silver.financial_fact_quarantine"), report) as passed:
        # The merge keeps one row a key; what it has written is checked for that before it is published.
        unique = lambda _, new: quality.require(grain_counts(new, FACT_KEY), [quality.GRAIN_CHECK])
        return merge_scd1(SnapshotTable(spark, root, "silver.financial_fact"), passed, FACT_KEY, bucket_by=["fact_sk"], then=ordered_facts, operation="merge_facts", accept=unique, latest_by=LATEST, rows=passed.count())
