"""Rebuilt marts: change events, current assertions, daily activity, entity profiles, and views."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.concepts import tag_preference
from ..functions.tolerance import MONEY, Tolerance, materiality, tolerance
from .frame import first_of, unused
from .versioning import null_safe

FACT_GRAIN = ["cik", "concept_canonical", "unit", "period_start", "period_end", "period_type"]


@dataclass(frozen=True)
class FactShape:
    """Which columns of a frame make a fact, an assertion of it, and their order."""

    grain: list[str] = field(default_factory=lambda: list(FACT_GRAIN))
    assertion: str = "accession_number"
    asserted_on: str = "filed_date"
    value: str = "value"
    decimals: str = "decimals"
    form: str = "form_type"
    tag: str | None = "concept_tag"
    taxonomy: str = "taxonomy"

    def by_preference(self) -> list[Column]:
        """Order of a fact's tags; none where it has no tags."""
        return [tag_preference(F.col(self.taxonomy), F.col(self.tag)), F.col(self.tag), F.col(self.taxonomy)] if self.tag else []


def _preferred(facts: DataFrame, shape: FactShape) -> DataFrame:
    """One row for each fact and assertion: the tag with the lowest preference."""
    if shape.tag is None:
        return facts
    return first_of(facts, [*shape.grain, shape.assertion], [*shape.by_preference(), F.col(shape.value)])


def change_events(facts: DataFrame, config: Tolerance = Tolerance(), shape: FactShape = FactShape(), names: DataFrame | None = None, name_limit: int = 200_000) -> DataFrame:
    """One row for each pair of consecutive assertions of a fact whose values differ by more than the tolerance.

    Rows are dealt once, by the fact, and both windows (preferred tag, previous assertion) use that.  `names` (first grain
    column, company_name) is broadcast only if a count finds at most `name_limit` rows.
    """
    s = shape
    rows = facts.where(" and ".join(f"{c} is not null" for c in ([s.grain[1], s.value] if s.tag else [s.value])))
    rows = _preferred(rows.repartition(*s.grain), s)
    w = Window.partitionBy(*s.grain).orderBy(s.asserted_on, s.assertion)
    before = {f"_p_{c}": F.lag(c).over(w) for c in (s.value, s.decimals, s.assertion, s.asserted_on, s.form)}
    pairs = rows.withColumns(before).where(f"_p_{s.value} is not null")
    old, new = F.col(f"_p_{s.value}"), F.col(s.value)
    limit = tolerance(old, new, F.col(f"_p_{s.decimals}"), F.col(s.decimals), config)
    delta = new.cast(MONEY) - old.cast(MONEY)
    changed = pairs.where(F.abs(new.cast("double") - old.cast("double")) > limit)
    # In double: decimal division would round small shares away.
    pct = F.when(old != 0, (new.cast("double") - old.cast("double")) / F.abs(old.cast("double")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    event_id = F.sha2(F.concat_ws("|", *[text(c) for c in s.grain], text(f"_p_{s.assertion}"), text(s.assertion)), 256)
    events = changed.select(
        event_id.alias("restatement_id"), *s.grain,
        *[F.col(f"_p_{c}").alias(f"original_{c}") for c in (s.assertion, s.form, s.asserted_on, s.value, s.decimals)],
        *[F.col(c).alias(f"restated_{c}") for c in (s.assertion, s.form, s.asserted_on, s.value, s.decimals)],
        F.abs(delta).cast(MONEY).alias("delta_abs"), pct.alias("delta_pct"), F.datediff(F.col(s.asserted_on), F.col(f"_p_{s.asserted_on}")).alias("days_to_restatement"),
    ).withColumn("materiality_band", materiality(F.col("delta_pct")))
    return with_names(events, names, s.grain[0], name_limit)


def with_names(df: DataFrame, names: DataFrame | None, key: str, limit: int = 200_000) -> DataFrame:
    """df with company_name; names is broadcast if it has at most `limit` rows, else joined by shuffle."""
    if names is None:
        return df.withColumn("company_name", F.lit(None).cast("string"))
    few = names.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(names) if few else names, key, "left")


def current_assertion(facts: DataFrame, events: DataFrame, shape: FactShape = FactShape(), keep: list[str] | None = None, names: DataFrame | None = None) -> DataFrame:
    """The latest assertion of each fact, the exact number of its assertions, and whether an event is on record.

    Grains are compared null-safe: a fact without period_start can be restated as well.
    """
    s = shape
    keep = [s.assertion, s.value, s.decimals, "fiscal_year", "fiscal_period", s.form, s.asserted_on] if keep is None else keep
    rows = facts.where(" and ".join(f"{c} is not null" for c in ([s.grain[1], s.value] if s.tag else [s.value]))) if s.tag else facts
    latest = Window.partitionBy(*s.grain).orderBy(F.col(s.asserted_on).desc(), F.col(s.assertion).desc(), *s.by_preference(), F.col(s.value))
    whole = Window.partitionBy(*s.grain)
    # Each assertion is counted at its first row: exact, and no set of a fact's assertions is held in memory.
    mark = F.when(F.row_number().over(Window.partitionBy(*s.grain).orderBy(s.assertion)) == 1, F.col(s.assertion).isNotNull()).otherwise(F.coalesce(F.lag(s.assertion).over(Window.partitionBy(*s.grain).orderBy(s.assertion)) != F.col(s.assertion), F.col(s.assertion).isNotNull()))
    new, rank = unused(rows, "_new"), unused(rows, "_rank")
    ranked = rows.withColumn(new, mark.cast("int")).withColumns({rank: F.row_number().over(latest), "assertion_count": F.sum(new).over(whole).cast("int")})
    top = ranked.where(F.col(rank) == 1).select(*s.grain, *keep, "assertion_count")
    restated = events.select(*s.grain).distinct().withColumn("_r", F.lit(True))
    out = top.alias("a").join(restated.alias("b"), null_safe("a", "b", s.grain), "left").select("a.*", F.coalesce("b._r", F.lit(False)).alias("was_restated"))
    return with_names(out, names, s.grain[0]) if names is not None else out


def daily_activity(rows: DataFrame, day: str = "filed_date", kind: str = "base_form_type", amended: Column | None = None, entity: str = "cik") -> DataFrame:
    """Counts for each day and kind: all, amended, and distinct entities."""
    amended = F.col("is_amendment") if amended is None else amended
    return rows.groupBy(day, kind).agg(F.count("*").cast("int").alias("filing_count"), F.count_if(amended).cast("int").alias("amendment_count"), F.count_distinct(entity).cast("int").alias("distinct_cik_count"))


def entity_profile(entities: DataFrame, filings: DataFrame, events: DataFrame, key: str = "cik", day: str = "filed_date") -> DataFrame:
    """Current entities with counts and bounds of their filings and their number of events; nought where there are none."""
    stats = filings.groupBy(key).agg(F.count("*").cast("int").alias("filing_count"), F.min(day).alias("first_filed_date"), F.max(day).alias("last_filed_date"))
    changes = events.groupBy(key).agg(F.count("*").cast("int").alias("restatement_count"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("filing_count", "restatement_count")}
    return entities.join(stats, key, "left").join(changes, key, "left").withColumns(zero)


# Views


def current_rows(versions: DataFrame) -> DataFrame:
    return versions.where("is_current")


def timeline(versions: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Each version with what the columns were before."""
    w = Window.partitionBy(*keys).orderBy("version_number")
    return versions.withColumns({f"previous_{c}": F.lag(c).over(w) for c in columns})


def latest_by_period(current: DataFrame, key: list[str], period: str) -> DataFrame:
    """The newest period of each series.  Of periods that end together the first by all other columns, in their order: of
    durations the longest, as it begins first."""
    rest = [F.col(c) for c, kind in current.dtypes if c not in key and c != period and "map<" not in kind]
    return first_of(current, key, [F.col(period).desc_nulls_last(), *rest])


def pipeline_health(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, row_count, newest) for each table and its date column."""
    parts = [df.agg(F.count("*").alias("row_count"), F.max(F.col(c).cast("date")).alias("newest")).select(F.lit(n).alias("table_name"), "row_count", "newest") for n, (df, c) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_changes(events: DataFrame, n: int = 10, size: str = "delta_abs", key: str = "restatement_id") -> DataFrame:
    """The n largest changes."""
    return events.orderBy(F.col(size).desc(), key).limit(n)


# Roll-ups, sketches, time ranges, statements

#: Bits of a distinct-count sketch: 2^12 registers, whose relative standard error is 1.04 / 2^6.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(rows: DataFrame, groups: list[str], entity: str) -> DataFrame:
    """A row for each group with its number of rows and a sketch of its distinct entities; sketches unite, counts of distinct do not."""
    return rows.groupBy(*groups).agg(F.count("*").alias("row_count"), F.hll_sketch_agg(F.col(entity), SKETCH_BITS).alias("sketch"))


def rolled_up(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches united over each leading part of groups: level (their grouping id), row_count and about_distinct.

    The source is not read again; the estimate errs by SKETCH_ERROR, one standard deviation.
    """
    united = sketches.rollup(*groups).agg(F.grouping_id().alias("level"), F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*groups, "level", "row_count", F.hll_sketch_estimate("sketch").alias("about_distinct"))


def recent_before(rows: DataFrame, keys: list[str], at: str, days: int, name: str = "recent_count") -> DataFrame:
    """rows with how many others of their key came in the `days` before them or on the same moment; a row without a time has NULL."""
    second = F.unix_seconds(F.col(at).cast("timestamp"))
    w = Window.partitionBy(*keys).orderBy(second).rangeBetween(-days * 86_400, Window.currentRow)
    return rows.withColumn(name, F.when(F.col(at).isNotNull(), F.count(F.lit(1)).over(w) - 1))


def statements(facts: DataFrame, names: list[str], filing: list[str], concept: str = "concept_canonical", value: str = "value", unit: str = "unit", by: list[Column] | None = None) -> DataFrame:
    """One row for each filing, period and unit, with a column for each concept among names.

    Names are given, so no pass is spent on finding them, and other concepts' rows never leave the scan.  Of several values for one cell the
    first in the order `by` counts, the smallest by default; units are kept apart.
    """
    order = F.struct(*(by or [F.col(value)]))
    rows = facts.where(F.col(concept).isin(*names) & F.col(value).isNotNull())
    return rows.groupBy(*filing, unit).pivot(concept, names).agg(F.min_by(value, order))
