"""Declarative data quality: one pass counts every check; rejected rows go to a replayable quarantine."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import ACCESSION, CIK

REJECT, WARN, REJECT_BATCH = "reject", "warn", "reject_batch"
ROW, AGGREGATE = "row", "aggregate"


@dataclass(frozen=True)
class Check:
    """A row passes when the SQL expression is true; NULL fails."""

    name: str
    expression: str
    severity: str = REJECT
    description: str = ""
    kind: str = ROW

    def __post_init__(self):
        if self.severity not in (REJECT, WARN, REJECT_BATCH) or self.kind not in (ROW, AGGREGATE):
            raise ValueError(f"{self.name}: unknown severity or kind")

    def failed(self) -> Column:
        return ~F.coalesce(F.expr(self.expression), F.lit(False))


class BatchRejected(Exception):
    """A check that no batch may fail has failed."""

    def __init__(self, check: Check, failed: int, samples: list[dict]):
        self.check, self.failed, self.samples = check, failed, samples
        super().__init__(f"{check.name}: {failed} rows fail ({check.expression}); for example {samples}")


@dataclass
class Checked:
    passed: DataFrame
    quarantined: DataFrame
    metrics: dict[str, int]

    @property
    def has_warnings(self) -> bool:
        return any(v for k, v in self.metrics.items() if k.endswith(".warn"))


def _flag(check: Check) -> str:
    return f"_failed_{check.name}"


def first_failure(checks: list[Check], value) -> Column:
    """value(check) of the first failed check in registry order, NULL if none failed."""
    return F.coalesce(*[F.when(F.col(_flag(c)), F.lit(value(c))) for c in checks]) if checks else F.lit(None).cast("string")


def quarantine(flagged: DataFrame, checks: list[Check], run_id: str, source_table: str, raw: str | None = None) -> DataFrame:
    """One row for each rejected record.

    The record's id comes from table, check and record alone, so a replay on another day meets its earlier self.  `raw`
    names a column with the record as it arrived; without it the record is the row itself.
    """
    names = [c for c in flagged.columns if not c.startswith("_failed_")]
    of = lambda name: (F.col(name) if name in names else F.lit(None)).cast("string").alias(name)
    record = F.to_json(raw) if raw else F.to_json(F.struct(*[F.col(c) for c in names]))
    rows = flagged.select(first_failure(checks, lambda c: c.name).alias("_dq_check_name"), first_failure(checks, lambda c: c.description or c.expression).alias("_dq_failure_reason"), of("_source_file"), of("_ingest_batch_id"), record.alias("record_json"))
    return rows.where("_dq_check_name is not null").select(
        F.sha2(F.concat_ws("|", F.lit(source_table), "_dq_check_name", "record_json"), 256).alias("_dq_record_id"),
        F.lit(run_id).alias("_dq_run_id"), "_dq_check_name", "_dq_failure_reason", F.current_timestamp().alias("_quarantined_at"),
        F.lit(source_table).alias("_source_table"), "_source_file", "_ingest_batch_id", "record_json",
    )


def flag(df: DataFrame, checks: list[Check]) -> DataFrame:
    return df.withColumns({_flag(c): c.failed() for c in checks}) if checks else df


def check_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, severity, failed_count), one row for each check, zero included."""
    one = flag(df, checks).agg(*[F.count_if(_flag(c)).alias(c.name) for c in checks])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(c.name).alias("failed_count")) for c in checks])
    return one.select(F.inline(rows))


def apply_checks(df: DataFrame, checks: list[Check], run_id: str, source_table: str, raw: str | None = None) -> Checked:
    """Split df into rows that pass and a quarantine.  A failed reject_batch check raises before anything is returned.

    One aggregation counts all checks.  Warnings never drop a row; a row that fails several checks is quarantined once,
    under the first.
    """
    row_checks = [c for c in checks if c.kind == ROW]
    flagged = flag(df, row_checks)
    rejects = [c for c in row_checks if c.severity == REJECT]
    any_reject = reduce(Column.__or__, [F.col(_flag(c)) for c in rejects], F.lit(False))
    counted = flagged.agg(F.count("*").alias("_n"), F.count_if(any_reject).alias("_rejected"), *[F.count_if(_flag(c)).alias(c.name) for c in row_checks]).first()
    metrics: dict[str, int] = {}
    for c in row_checks:
        n = counted[c.name]
        metrics[f"dq.{c.name}.failed"] = n
        metrics[f"dq.severity_{c.severity}"] = metrics.get(f"dq.severity_{c.severity}", 0) + n
        if c.severity == WARN and n:
            metrics[f"dq.{c.name}.warn"] = n
    for c in row_checks:
        if c.severity == REJECT_BATCH and counted[c.name]:
            samples = [r.asDict(recursive=True) for r in flagged.where(_flag(c)).select(df.columns).limit(3).collect()]
            raise BatchRejected(c, counted[c.name], samples)
    metrics |= {"dq.rows_in": counted["_n"], "dq.rows_passed": counted["_n"] - counted["_rejected"], "dq.rows_quarantined": counted["_rejected"]}
    # The checks themselves, not their flags: a scan can take these as pushed filters, and a NULL fails here as well.
    passed = df
    for c in rejects:
        passed = passed.where(c.expression)
    return Checked(passed, quarantine(flagged.where(any_reject), rejects, run_id, source_table, raw), metrics)


@dataclass(frozen=True)
class Reference:
    """A row passes when a second table has its key; a NULL in the key fails, as it names nothing."""

    name: str
    keys: dict[str, str]
    severity: str = REJECT
    description: str = ""

    def __post_init__(self):
        if self.severity not in (REJECT, WARN, REJECT_BATCH) or not self.keys:
            raise ValueError(f"{self.name}: unknown severity, or no keys")


def apply_reference(df: DataFrame, check: Reference, others: DataFrame, run_id: str, source_table: str, raw: str | None = None, staged: str | None = None) -> Checked:
    """As apply_checks(), for rows whose key (columns of df to columns of others) is in another table.

    Rows meet others by semi and anti joins, so repeated keys there repeat no row, and a failed reject_batch check shows
    three samples at most.  Ids of quarantined records do not depend on the run: a replay meets its earlier self.
    With `staged`, a new folder that the caller drops, rejected rows are written there once, as far as the quarantine needs
    them; their count and the quarantine come from there, and the tables meet no more for these.
    """
    there = others.select(*[F.col(b).alias(f"_there{k}") for k, b in enumerate(check.keys.values())])
    on = reduce(Column.__and__, [F.col(a) == F.col(f"_there{k}") for k, a in enumerate(check.keys)])
    orphans = df.join(there, on, "left_anti")
    plain = Check(check.name, "false", REJECT, check.description or f"{', '.join(check.keys)} not found")
    if staged and check.severity == REJECT:
        needed = [c for c in df.columns if raw is None or c in (raw, "_source_file", "_ingest_batch_id")]
        rows = orphans.select(*needed)
        rows.write.parquet(staged)
        orphans = df.sparkSession.read.schema(rows.schema).parquet(staged)
    n, failed = df.count(), orphans.count()
    metrics = {f"dq.{check.name}.failed": failed, f"dq.severity_{check.severity}": failed, "dq.rows_in": n}
    if check.severity == REJECT_BATCH and failed:
        raise BatchRejected(plain, failed, [r.asDict(recursive=True) for r in orphans.limit(3).collect()])
    dropped = failed if check.severity == REJECT else 0
    if check.severity == WARN and failed:
        metrics[f"dq.{check.name}.warn"] = failed
    rejected = orphans if check.severity == REJECT else orphans.limit(0)
    return Checked(df.join(there, on, "left_semi") if check.severity == REJECT else df, quarantine(flag(rejected, [plain]), [plain], run_id, source_table, raw), metrics | {"dq.rows_passed": n - dropped, "dq.rows_quarantined": dropped})


# The registry of checks by table.
CHECKS: dict[str, list[Check]] = {
    "bronze": [Check("bronze_rescued_data_absent", "_rescued_data IS NULL", WARN, "no unknown fields arrived")],
    "filing": [
        Check("filing_accession_format", f"accession_number IS NOT NULL AND accession_number RLIKE '{ACCESSION}'"),
        Check("filing_cik_zero_padded", f"cik IS NOT NULL AND cik RLIKE '{CIK}'"),
        Check("filing_form_type_present", "form_type IS NOT NULL AND length(trim(form_type)) > 0"),
        Check("filing_filed_date_present", "filed_date IS NOT NULL"),
        Check("filing_filed_date_not_after_logical_date", "filed_date IS NULL OR filed_date <= date_add(logical_date, 1)"),
        Check("filing_company_name_present", "company_name IS NOT NULL AND length(trim(company_name)) > 0", WARN),
    ],
    "company": [
        Check("company_cik_zero_padded", f"cik IS NOT NULL AND cik RLIKE '{CIK}'"),
        Check("company_name_present", "company_name IS NOT NULL AND length(trim(company_name)) > 0", WARN),
        Check("company_valid_from_present", "valid_from IS NOT NULL"),
    ],
    "financial_fact": [
        Check("fact_cik_zero_padded", f"cik IS NOT NULL AND cik RLIKE '{CIK}'"),
        Check("fact_accession_format", f"accession_number IS NOT NULL AND accession_number RLIKE '{ACCESSION}'"),
        Check("fact_taxonomy_present", "taxonomy IS NOT NULL AND length(trim(taxonomy)) > 0"),
        Check("fact_concept_tag_present", "concept_tag IS NOT NULL AND length(trim(concept_tag)) > 0"),
        Check("fact_filed_date_present", "filed_date IS NOT NULL"),
        Check("fact_unit_present", "unit IS NOT NULL AND length(trim(unit)) > 0"),
        Check("fact_value_present", "value IS NOT NULL"),
        Check("fact_period_end_present", "period_end IS NOT NULL"),
        Check("fact_period_order", "period_start IS NULL OR period_end >= period_start"),
        Check("fact_period_type_valid", "period_type IN ('instant', 'duration') AND (period_type = 'instant') = (period_start IS NULL)"),
        Check("fact_concept_mapped", "concept_canonical IS NOT NULL", WARN),
    ],
}
SCD2_CHECKS = [
    Check("exactly_one_current", "current_count = 1", REJECT_BATCH, kind=AGGREGATE),
    Check("no_overlapping_versions", "overlap_count = 0", REJECT_BATCH, kind=AGGREGATE),
    Check("versions_dense", "version_count = max_version AND min_version = 1", REJECT_BATCH, kind=AGGREGATE),
    Check("current_is_newest", "current_version = max_version", REJECT_BATCH, kind=AGGREGATE),
]
#: Of the rows that one merge writes for a key: the version it closed, if any, and the current one.
SCD2_STEP_CHECKS = [
    *(c for c in SCD2_CHECKS if c.name != "versions_dense"),
    Check("versions_consecutive", "version_count = max_version - min_version + 1", REJECT_BATCH, kind=AGGREGATE),
]
GRAIN_CHECK = Check("fact_grain_unique", "row_count = 1", REJECT_BATCH, kind=AGGREGATE)


def require(aggregated: DataFrame, checks: list[Check]) -> dict[str, int]:
    """Aggregate checks over a frame of invariants; the first that fails raises."""
    flagged = flag(aggregated, checks)
    counted = flagged.agg(*[F.count_if(_flag(c)).alias(c.name) for c in checks]).first()
    for c in checks:
        if counted[c.name]:
            raise BatchRejected(c, counted[c.name], [r.asDict(recursive=True) for r in flagged.where(_flag(c)).select(aggregated.columns).limit(3).collect()])
    return {f"dq.{c.name}.failed": 0 for c in checks}
