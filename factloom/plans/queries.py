"""One query for each operator over the driver's tables, and the SQL that says what it returns.

QUERIES[name](spark, sf_dir) returns a DataFrame; ORACLES[name] is SQL over the same tables.  Dates leave as text and
decimals as rounded doubles, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import concepts, normalise
from ..functions.keys import hash_diff, surrogate_key
from ..functions.tolerance import MONEY, reporting_scale
from ..operators import filings, incremental, joins, marts, quality, versioning
from ..operators.filings import schema_of
from ..operators.frame import align, dedupe, stamp
from ..operators.publish import export_table, write_mart
from ..operators.tables import SnapshotTable
from ..runtime.report import Report
from ..runtime.scratch import scratch
from ..sources import landing
from ..streaming import stateful
from ..streaming.ingest import ingest_batch, ingest_stream, read_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _num(c, digits: int = 6):
    return F.round(F.col(c).cast("double") if isinstance(c, str) else c.cast("double"), digits)


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


# Projections, rescue, normalisers


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def payload_projection(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))


def _event_lines(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    unknown = F.when(F.col("user_id") % 5 != 0, F.col("user_id"))
    return e.select(F.to_json(F.struct("event_id", "event_type", unknown.alias("user_id"))).alias("value"))


@query("""
    SELECT event_id, event_type, CASE WHEN user_id % 5 <> 0 THEN '{"user_id":"' || user_id || '"}' END AS rescued FROM events
""")
def rescue_unknown_keys(spark, sf_dir):
    return landing.parse_envelopes(_event_lines(spark, sf_dir), _schema("event_id bigint, event_type string")).select("event_id", "event_type", F.col(landing.RESCUED).alias("rescued"))


@query("SELECT count(*) AS row_count, count(*) FILTER (WHERE user_id % 5 <> 0) AS rescued_count FROM events")
def rescued_row_count(spark, sf_dir):
    rows = landing.parse_envelopes(_event_lines(spark, sf_dir), _schema("event_id bigint, event_type string"))
    return rows.agg(F.count("*").alias("row_count"), landing.rescued_rows(rows).alias("rescued_count"))


@query("SELECT DISTINCT event_type AS envelope_version FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')")
def envelope_version_gate(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.col("event_type").alias("envelope_version"))
    return landing.unsupported_versions(rows, ("click", "view", "purchase"))


@query("""
    SELECT c_custkey, lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 10, '0') AS cik,
           substr(k, 1, 10) || '-' || substr(k, 11, 2) || '-' || substr(k, 13) AS accession, f AS form_type,
           CASE WHEN c_custkey % 2 = 0 THEN left(f, length(f) - 2) ELSE f END AS base_form_type, c_custkey % 2 = 0 AS is_amendment,
           'https://www.sec.gov/Archives/' || c_name AS url
    FROM (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS k, upper(trim(c_mktsegment)) || CASE WHEN c_custkey % 2 = 0 THEN '/A' ELSE '' END AS f FROM customer)
""")
def normalize_identifiers(spark, sf_dir):
    n = normalise
    form = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, "/a ").otherwise(""))
    c = _t(spark, sf_dir, "customer").withColumn("f", n.form_type(form))
    return c.select("c_custkey", n.cik(F.col("c_name")).alias("cik"), n.accession(F.lpad(F.col("c_custkey").cast("string"), 18, "0")).alias("accession"), F.col("f").alias("form_type"), n.base_form_type(F.col("f")).alias("base_form_type"), n.is_amendment(F.col("f")).alias("is_amendment"), n.document_url(F.col("c_name")).alias("url"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders
""")
def parse_dates_tolerant(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 2, "20260231").otherwise("n/a")
    return o.select("o_orderkey", _day(normalise.filing_date(text)).alias("parsed"))


@query("""
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR) || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || CASE WHEN o_orderkey % 3 = 0 THEN '<null>' ELSE o_orderstatus END) AS sk FROM orders
""")
def surrogate_keys(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", surrogate_key(F.col("o_custkey"), F.col("o_orderdate").cast("date"), status, null_mark="<null>").alias("sk"))


@query("""
    SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || chr(1) || CASE WHEN c_custkey % 4 = 0 THEN '␀' ELSE c_mktsegment END || chr(1)
        || CASE WHEN c_custkey % 3 = 0 THEN '[]' WHEN c_custkey % 3 = 1 THEN '␀' WHEN c_mktsegment < c_name THEN '["' || c_mktsegment || '","' || c_name || '"]' ELSE '["' || c_name || '","' || c_mktsegment || '"]' END) AS hash_diff
    FROM customer
""")
def hash_diff_rows(spark, sf_dir):
    k = F.col("c_custkey")
    tags = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 2, F.array("c_name", "c_mktsegment"))
    c = _t(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 != 0, F.col("c_mktsegment")).alias("segment"), tags.alias("tags"))
    return c.select("c_custkey", hash_diff(c, ["c_custkey", "segment", "tags"]).alias("hash_diff"))


_LATEST = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem
    ) WHERE rn = 1
"""


@query(_LATEST)
def dedupe_latest(spark, sf_dir):
    one = dedupe(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return one.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", _day("l_shipdate").alias("shipdate"))


# Data quality

ORDER_CHECKS = [
    quality.Check("priority_known", "o_orderpriority <> '5-LOW'"),
    quality.Check("price_in_range", "o_totalprice between 1000 and 400000", quality.REJECT, "price out of range"),
    quality.Check("status_final", "o_orderstatus <> 'P'", quality.WARN),
    quality.Check("key_present", "o_orderkey is not null", quality.REJECT_BATCH),
]


@query("""
    SELECT 'priority_known' AS check_name, 'reject' AS severity, count(*) FILTER (WHERE NOT coalesce(o_orderpriority <> '5-LOW', false)) AS failed_count FROM orders
    UNION ALL SELECT 'price_in_range', 'reject', count(*) FILTER (WHERE NOT coalesce(o_totalprice BETWEEN 1000 AND 400000, false)) FROM orders
    UNION ALL SELECT 'status_final', 'warn', count(*) FILTER (WHERE NOT coalesce(o_orderstatus <> 'P', false)) FROM orders
    UNION ALL SELECT 'key_present', 'reject_batch', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
""")
def dq_check_counts(spark, sf_dir):
    return quality.check_counts(_t(spark, sf_dir, "orders"), ORDER_CHECKS)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderpriority <> '5-LOW' AND o_totalprice BETWEEN 1000 AND 400000")
def dq_passed(spark, sf_dir):
    return quality.apply_checks(_t(spark, sf_dir, "orders"), ORDER_CHECKS, "run", "orders").passed.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""
    SELECT sha256('orders|' || check_name || '|' || record_json) AS record_id, check_name, reason, record_json FROM (
        SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'priority_known' ELSE 'price_in_range' END AS check_name,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'o_orderpriority <> ''5-LOW''' ELSE 'price out of range' END AS reason,
               '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS record_json
        FROM orders WHERE o_orderpriority = '5-LOW' OR NOT o_totalprice BETWEEN 1000 AND 400000)
""")
def dq_quarantine(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("_raw", F.struct("o_orderkey", "o_orderstatus"))
    q = quality.apply_checks(o, ORDER_CHECKS, "run", "orders", raw="_raw").quarantined
    return q.select(F.col("_dq_record_id").alias("record_id"), F.col("_dq_check_name").alias("check_name"), F.col("_dq_failure_reason").alias("reason"), "record_json")


@query("SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) <> 1")
def dq_grain_unique(spark, sf_dir):
    counts = versioning.grain_counts(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return counts.where(quality.GRAIN_CHECK.failed())


# Merges and versions


@query("""
    WITH delta AS (
        SELECT c_custkey, 'MOVED' AS c_mktsegment FROM customer WHERE c_custkey % 10 = 0
        UNION ALL SELECT c_custkey + 1000000, c_mktsegment FROM customer WHERE c_custkey % 100 = 1)
    SELECT coalesce(c.c_custkey, d.c_custkey) AS c_custkey, c.c_name, coalesce(d.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
           CASE WHEN c.c_custkey IS NULL THEN '2024-02-01' ELSE '2024-01-01' END AS first_seen, CASE WHEN d.c_custkey IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS last_seen,
           CASE WHEN d.c_custkey IS NULL THEN 'unchanged' WHEN c.c_custkey IS NULL THEN 'inserted' ELSE 'updated' END AS op
    FROM customer c FULL JOIN delta d ON c.c_custkey IS NOT DISTINCT FROM d.c_custkey
""")
def scd1_upsert(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    seen = F.lit("2024-01-01").cast("timestamp")
    target = c.withColumns({versioning.FIRST_SEEN: seen, versioning.LAST_SEEN: seen})
    moved = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("MOVED").alias("c_mktsegment"))
    added = c.where("c_custkey % 100 = 1").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_mktsegment")
    out = versioning.scd1(target, moved.unionByName(added), ["c_custkey"], processing_ts="2024-02-01")
    return out.select("c_custkey", "c_name", "c_mktsegment", _day(versioning.FIRST_SEEN).alias("first_seen"), _day(versioning.LAST_SEEN).alias("last_seen"), F.col(versioning.OP).alias("op"))


def _daily_state(spark, sf_dir, day=None) -> DataFrame:
    """Last event type of each user and day, or another span that begins on a day."""
    e = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts") if day is None else day)
    return e.groupBy("user_id", "day").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))


def _versions(spark, sf_dir) -> DataFrame:
    return versioning.history_from(_daily_state(spark, sf_dir), ["user_id"], ["event_type"], "day")


_STATE = """state AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1, 2),
    changes AS (SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before FROM state) WHERE before IS DISTINCT FROM event_type),
    versions AS (SELECT user_id, event_type, row_number() OVER w AS version_number, day AS valid_from, lead(day) OVER w - 1 AS valid_to, lead(day) OVER w IS NULL AS is_current FROM changes WINDOW w AS (PARTITION BY user_id ORDER BY day))"""
_SHOW = "user_id, event_type, CAST(version_number AS INTEGER) AS version_number, strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to, is_current"


def _shown(v: DataFrame) -> DataFrame:
    return v.select("user_id", "event_type", "version_number", _day("valid_from").alias("valid_from"), _day("valid_to").alias("valid_to"), "is_current")


@query(f"WITH {_STATE} SELECT {_SHOW} FROM versions")
def scd2_history(spark, sf_dir):
    return _shown(_versions(spark, sf_dir))


@query(f"WITH {_STATE.replace('CAST(ts AS DATE) AS day', "CAST(date_trunc('week', ts) AS DATE) AS day")} SELECT {_SHOW} FROM versions")
def merge_scd2_table(spark, sf_dir):
    """Every week of the events, one after the other, merged into a versioned table."""
    state, folder = _daily_state(spark, sf_dir, F.to_date(F.date_trunc("week", "ts"))), scratch(spark)
    state.write.parquet(f"{folder}/state")
    state = spark.read.schema(state.schema).parquet(f"{folder}/state")
    table = SnapshotTable(spark, folder, "states").create(_schema("user_id long, event_type string, version_number int, valid_from date, valid_to date, is_current boolean, _hash_diff string, _first_seen_ts timestamp, _last_seen_ts timestamp"))
    for r in state.select("day").distinct().orderBy("day").collect():
        versioning.merge_scd2(table, state.where(F.col("day") == F.lit(r.day)).drop("day"), ["user_id"], ["event_type"], str(r.day), buckets=4)
    return _shown(table.read())


@query("""
    WITH delta AS (
        SELECT c_custkey, 'MOVED' AS c_mktsegment FROM customer WHERE c_custkey % 10 = 0
        UNION ALL SELECT c_custkey + 1000000, c_mktsegment FROM customer WHERE c_custkey % 100 = 1)
    SELECT coalesce(c.c_custkey, d.c_custkey) AS c_custkey, c.c_name, coalesce(d.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
           CASE WHEN c.c_custkey IS NULL THEN '2024-02-01' ELSE '2024-01-01' END AS first_seen, CASE WHEN d.c_custkey IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS last_seen
    FROM customer c FULL JOIN delta d ON c.c_custkey IS NOT DISTINCT FROM d.c_custkey
""")
def merge_scd1_table(spark, sf_dir):
    """All customers, then a delta, merged into a versioned table in buckets."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    table = SnapshotTable(spark, scratch(spark), "customers").create(StructType([*c.schema.fields, *_schema("_first_seen_ts timestamp, _last_seen_ts timestamp").fields]))
    versioning.merge_scd1(table, c, ["c_custkey"], processing_ts="2024-01-01", buckets=8)
    moved = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("MOVED").alias("c_mktsegment"))
    added = c.where("c_custkey % 100 = 1").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_mktsegment")
    versioning.merge_scd1(table, moved.unionByName(added), ["c_custkey"], processing_ts="2024-02-01")
    return table.read().select("c_custkey", "c_name", "c_mktsegment", _day(versioning.FIRST_SEEN).alias("first_seen"), _day(versioning.LAST_SEEN).alias("last_seen"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE CAST(2 + c_custkey % 5 AS INTEGER) END AS version_number FROM customer")
def version_after_closed_rows(spark, sf_dir):
    """Keys that have closed rows but no current one go on where these ended."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    none = spark.createDataFrame([], "c_custkey long, c_name string, version_number int, valid_from date, valid_to date, is_current boolean, _hash_diff string, _first_seen_ts timestamp, _last_seen_ts timestamp")
    closed = c.where("c_custkey % 2 = 1").select("c_custkey", (1 + F.col("c_custkey") % 5).cast("int").alias("max_version"))
    return versioning.scd2(none, c, ["c_custkey"], ["c_name"], "2024-01-01", closed_versions=closed).select("c_custkey", "version_number")


@query(f"""
    WITH {_STATE} SELECT user_id, count(*) FILTER (WHERE is_current) AS current_count, 0::BIGINT AS overlap_count, count(*) AS version_count,
        CAST(min(version_number) AS INTEGER) AS min_version, CAST(max(version_number) AS INTEGER) AS max_version, CAST(max(version_number) FILTER (WHERE is_current) AS INTEGER) AS current_version FROM versions GROUP BY user_id
""")
def scd2_invariants(spark, sf_dir):
    return versioning.scd2_invariants(_versions(spark, sf_dir), ["user_id"])


@query(f"""
    WITH {_STATE} SELECT e.event_id, e.user_id, v.event_type AS state, CAST(v.version_number AS INTEGER) AS version_number
    FROM events e LEFT JOIN versions v ON e.user_id = v.user_id AND CAST(e.ts AS DATE) BETWEEN v.valid_from AND coalesce(v.valid_to, DATE '9999-12-31')
""")
def point_in_time_join(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    v = _versions(spark, sf_dir).withColumnRenamed("event_type", "state")
    return versioning.point_in_time(e, v, ["user_id"], "day").select("event_id", "user_id", "state", "version_number")


@query(f"WITH {_STATE} SELECT {_SHOW}, lag(event_type) OVER (PARTITION BY user_id ORDER BY version_number) AS previous_event_type FROM versions")
def entity_timeline(spark, sf_dir):
    v = marts.timeline(_versions(spark, sf_dir), ["user_id"], ["event_type"])
    return v.select("user_id", "event_type", "version_number", _day("valid_from").alias("valid_from"), _day("valid_to").alias("valid_to"), "is_current", "previous_event_type")


@query(f"WITH {_STATE} SELECT {_SHOW} FROM versions WHERE is_current")
def current_view(spark, sf_dir):
    return _shown(marts.current_rows(_versions(spark, sf_dir)))


@query(f"WITH {_STATE} SELECT {_SHOW} FROM versions QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY valid_from DESC) = 1")
def latest_view(spark, sf_dir):
    return _shown(marts.latest_by_period(_versions(spark, sf_dir), ["user_id", "event_type"], "valid_from"))


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"""
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER w AS INTEGER) AS assertion_version, CAST(lead(l_orderkey) OVER w AS VARCHAR) AS superseded_by, lead(l_orderkey) OVER w IS NULL AS is_current
    FROM lineitem WINDOW w AS (PARTITION BY l_partkey, l_suppkey ORDER BY {', '.join(_LINE_ORDER)})
""")
def assertion_versions(spark, sf_dir):
    a = versioning.order_assertions(_t(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], _LINE_ORDER, accession="l_orderkey")
    return a.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "assertion_version", F.col("superseded_by_accession").cast("string").alias("superseded_by"), F.col("is_current_assertion").alias("is_current"))


# Facts and tolerances

_CASES = " ".join(f"WHEN {k} THEN '{c[2]}'" for k, c in enumerate(concepts.CONCEPTS))


@query(f"""
    SELECT event_id, tag, CASE {' '.join(f"WHEN tag = '{g}' AND taxonomy = '{t}' THEN '{c}'" for c, t, g, *_ in concepts.CONCEPTS)} END AS canonical,
           CASE {' '.join(f"WHEN tag = '{g}' AND taxonomy = '{t}' THEN {p}" for _, t, g, p, _ in concepts.CONCEPTS)} ELSE 9999 END AS preference
    FROM (SELECT event_id, CASE event_id % 20 {_CASES} ELSE 'Other' || event_id % 20 END AS tag, CASE WHEN event_id % 20 = 15 THEN 'dei' ELSE 'us-gaap' END AS taxonomy FROM events)
""")
def canonical_mapping(spark, sf_dir):
    k = F.col("event_id") % 20
    tag = F.coalesce(concepts.lookup({n: c[2] for n, c in enumerate(concepts.CONCEPTS)}, k.cast("int")), F.concat(F.lit("Other"), k))
    e = _t(spark, sf_dir, "events").select("event_id", tag.alias("tag"), F.when(k == 15, "dei").otherwise("us-gaap").alias("taxonomy"))
    return e.select("event_id", "tag", concepts.canonical_concept(F.col("taxonomy"), F.col("tag")).alias("canonical"), concepts.tag_preference(F.col("taxonomy"), F.col("tag")).alias("preference"))


def _scale_sql(v: str, decimals: str = "NULL") -> str:
    """reporting_scale() of a DECIMAL(38,6) expression, with the ladder tried power by power."""
    ladder = " ".join(f"WHEN {v} % CAST(1{'0' * k} AS DECIMAL(38,6)) = 0 THEN 1e{k}" for k in range(12, 0, -1))
    return f"coalesce(pow(10.0, -CAST({decimals} AS DOUBLE)), least(CASE {ladder} ELSE 1e0 END, greatest(abs(CAST({v} AS DOUBLE)) * 1e-3, 1e-6)))"


@query(f"SELECT o_orderkey, round({_scale_sql('v')}, 6) AS scale, round({_scale_sql('v', '-3')}, 6) AS given FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(round(o_totalprice) * 1000 AS DECIMAL(38,6)) ELSE CAST(o_totalprice AS DECIMAL(38,6)) END AS v FROM orders)")
def reporting_scales(spark, sf_dir):
    v = F.when(F.col("o_orderkey") % 2 == 0, (F.round("o_totalprice") * 1000).cast(MONEY)).otherwise(F.col("o_totalprice").cast(MONEY))
    return _t(spark, sf_dir, "orders").select("o_orderkey", _num(reporting_scale(v, F.lit(None).cast("int"))).alias("scale"), _num(reporting_scale(v, F.lit(-3))).alias("given"))


EVENT_SHAPE = marts.FactShape(["user_id", "event_type", "day"], "event_id", "ts", "value", "decimals", "kind", None)


def _event_facts(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select("user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "ts", F.col("value").cast(MONEY).alias("value"), F.lit(None).cast("int").alias("decimals"), F.col("event_type").alias("kind"))


def _events_of_change(spark, sf_dir) -> DataFrame:
    return marts.change_events(_event_facts(spark, sf_dir), shape=EVENT_SHAPE)


_CHANGES = f"""pairs AS (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, ts, CAST(value AS DECIMAL(38,6)) AS v, lag(CAST(value AS DECIMAL(38,6))) OVER w AS pv, lag(event_id) OVER w AS pid, lag(ts) OVER w AS pts
        FROM events WINDOW w AS (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id)),
    changed AS (
        SELECT *, CASE WHEN pv <> 0 THEN (CAST(v AS DOUBLE) - CAST(pv AS DOUBLE)) / abs(CAST(pv AS DOUBLE)) END AS pct FROM pairs
        WHERE pv IS NOT NULL AND abs(CAST(v AS DOUBLE) - CAST(pv AS DOUBLE)) > greatest(abs(CAST(pv AS DOUBLE)) * 1e-6, 1e-6, greatest({_scale_sql('pv')}, {_scale_sql('v')}))),
    change_events AS (
        SELECT sha256(concat_ws('|', user_id, event_type, strftime(day, '%Y-%m-%d'), pid, event_id)) AS restatement_id, user_id, event_type, day, pid AS original_event_id, event_id AS restated_event_id,
            CAST(pv AS DOUBLE) AS original_value, CAST(v AS DOUBLE) AS restated_value, CAST(abs(v - pv) AS DOUBLE) AS delta_abs, pct AS delta_pct, datediff('day', pts, ts) AS days,
            CASE WHEN pct IS NULL OR abs(pct) > 0.05 THEN 'material' WHEN abs(pct) >= 0.01 THEN 'notable' ELSE 'immaterial' END AS band FROM changed)"""


@query(f"""
    WITH {_CHANGES} SELECT restatement_id, user_id, event_type, strftime(day, '%Y-%m-%d') AS day, original_event_id, restated_event_id, round(original_value, 6) AS original_value, round(restated_value, 6) AS restated_value,
        round(delta_abs, 6) AS delta_abs, round(delta_pct, 6) AS delta_pct, CAST(days AS INTEGER) AS days, band FROM change_events
""")
def change_events(spark, sf_dir):
    c = _events_of_change(spark, sf_dir)
    return c.select("restatement_id", "user_id", "event_type", _day("day").alias("day"), "original_event_id", "restated_event_id", _num("original_value").alias("original_value"), _num("restated_value").alias("restated_value"), _num("delta_abs").alias("delta_abs"), _num("delta_pct").alias("delta_pct"), F.col("days_to_restatement").alias("days"), F.col("materiality_band").alias("band"))


def _order_assertions(spark, sf_dir) -> DataFrame:
    """Each order's total in cents, and a later assertion of it: cut to thousands, unchanged, or two percent up."""
    k, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("decimal(38,0)")
    later = F.when(k % 3 == 0, cents - cents % 1000).when(k % 3 == 1, cents).otherwise(cents + F.floor(cents / 50).cast("decimal(38,0)"))
    return _t(spark, sf_dir, "orders").where("o_totalprice is not null").select("o_orderkey", F.inline(F.array(F.struct(F.lit(1).alias("n"), cents.cast(MONEY).alias("value")), F.struct(F.lit(2).alias("n"), later.cast(MONEY).alias("value")))))


@query(f"""
    WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS DECIMAL(38,0)) AS c FROM orders WHERE o_totalprice IS NOT NULL),
    p AS (SELECT o_orderkey, CAST(c AS DECIMAL(38,6)) AS pv, CAST(CASE o_orderkey % 3 WHEN 0 THEN c - c % 1000 WHEN 1 THEN c ELSE c + floor(c / 50) END AS DECIMAL(38,6)) AS v FROM o)
    SELECT o_orderkey, round(CAST(abs(v - pv) AS DOUBLE), 6) AS delta_abs, CASE WHEN pv = 0 OR abs(CAST(v AS DOUBLE) - CAST(pv AS DOUBLE)) / CAST(pv AS DOUBLE) > 0.05 THEN 'material' WHEN abs(CAST(v AS DOUBLE) - CAST(pv AS DOUBLE)) / CAST(pv AS DOUBLE) >= 0.01 THEN 'notable' ELSE 'immaterial' END AS band FROM p
    WHERE abs(CAST(v AS DOUBLE) - CAST(pv AS DOUBLE)) > greatest(abs(CAST(pv AS DOUBLE)) * 1e-6, 1e-6, greatest({_scale_sql('pv')}, {_scale_sql('v')}))
""")
def rounding_only_changes(spark, sf_dir):
    facts = _order_assertions(spark, sf_dir).withColumns({"decimals": F.lit(None).cast("int"), "form": F.lit("x"), "day": F.date_add(F.lit("2024-01-01").cast("date"), F.col("n"))})
    c = marts.change_events(facts, shape=marts.FactShape(["o_orderkey"], "n", "day", "value", "decimals", "form", None))
    return c.select("o_orderkey", _num("delta_abs").alias("delta_abs"), F.col("materiality_band").alias("band"))


@query(f"WITH {_CHANGES} SELECT band, count(*) AS n, count(DISTINCT user_id) AS users FROM change_events GROUP BY band")
def materiality_summary(spark, sf_dir):
    return _events_of_change(spark, sf_dir).groupBy(F.col("materiality_band").alias("band")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query(f"""
    WITH {_CHANGES}, ranked AS (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, value, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn,
            count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS n FROM events)
    SELECT r.user_id, r.event_type, strftime(r.day, '%Y-%m-%d') AS day, r.event_id, round(r.value, 6) AS value, CAST(r.n AS INTEGER) AS assertion_count,
        EXISTS (SELECT 1 FROM change_events c WHERE c.user_id = r.user_id AND c.event_type = r.event_type AND c.day = r.day) AS was_restated, c_name AS company_name
    FROM ranked r LEFT JOIN customer ON c_custkey = r.user_id WHERE rn = 1
""")
def current_assertion(spark, sf_dir):
    names = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("company_name"))
    facts = _event_facts(spark, sf_dir)
    c = marts.current_assertion(facts, _events_of_change(spark, sf_dir), EVENT_SHAPE, keep=["event_id", "value"], names=names)
    return c.select("user_id", "event_type", _day("day").alias("day"), "event_id", _num("value").alias("value"), "assertion_count", "was_restated", "company_name")


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS kind, CAST(count(*) AS INTEGER) AS filing_count, CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS amendment_count,
        CAST(count(DISTINCT o_custkey) AS INTEGER) AS distinct_cik_count FROM orders GROUP BY 1, 2
""")
def daily_activity(spark, sf_dir):
    a = marts.daily_activity(_t(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus", F.col("o_orderpriority") == "1-URGENT", "o_custkey")
    return a.select(_day("o_orderdate").alias("day"), F.col("o_orderstatus").alias("kind"), "filing_count", "amendment_count", "distinct_cik_count")


@query(f"""
    WITH {_CHANGES}, o AS (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1), e AS (SELECT user_id, count(*) AS n FROM change_events GROUP BY 1)
    SELECT c_custkey AS cik, c_name, CAST(coalesce(o.n, 0) AS INTEGER) AS filing_count, strftime(o.a, '%Y-%m-%d') AS first_filed, strftime(o.b, '%Y-%m-%d') AS last_filed, CAST(coalesce(e.n, 0) AS INTEGER) AS restatement_count
    FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN e ON e.user_id = c_custkey
""")
def entity_profile(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik"), "c_name")
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.col("o_orderdate").alias("filed_date"))
    p = marts.entity_profile(c, o, _events_of_change(spark, sf_dir).select(F.col("user_id").alias("cik")))
    return p.select("cik", "c_name", "filing_count", _day("first_filed_date").alias("first_filed"), _day("last_filed_date").alias("last_filed"), "restatement_count")


@query(f"""
    WITH {_CHANGES} SELECT h.user_id, h.event_type, strftime(h.day, '%Y-%m-%d') AS day, h.original_event_id, h.restated_event_id, count(*) OVER (PARTITION BY user_id, event_type, day) AS changes_of_fact FROM change_events h
""")
def history_view(spark, sf_dir):
    c = _events_of_change(spark, sf_dir)
    return c.select("user_id", "event_type", _day("day").alias("day"), "original_event_id", "restated_event_id", F.count("*").over(Window.partitionBy("user_id", "event_type", "day")).alias("changes_of_fact"))


@query("""
    SELECT 'events' AS table_name, count(*) AS row_count, strftime(max(ts), '%Y-%m-%d') AS newest FROM events
    UNION ALL SELECT 'lineitem', count(*), strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem UNION ALL SELECT 'orders', count(*), strftime(max(o_orderdate), '%Y-%m-%d') FROM orders
""")
def pipeline_health(spark, sf_dir):
    h = marts.pipeline_health({n: (_t(spark, sf_dir, n), c) for n, c in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))})
    return h.select("table_name", "row_count", _day("newest").alias("newest"))


@query(f"WITH {_CHANGES} SELECT restatement_id, user_id, round(delta_abs, 6) AS delta_abs FROM change_events ORDER BY round(delta_abs, 6) DESC, restatement_id LIMIT 10")
def top_changes(spark, sf_dir):
    """The ten largest changes; the limit is the feature."""
    return marts.top_changes(_events_of_change(spark, sf_dir)).select("restatement_id", "user_id", _num("delta_abs").alias("delta_abs"))


@query("SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS max_filed_date FROM orders")
def freshness(spark, sf_dir):
    return _t(spark, sf_dir, "orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("max_filed_date"))


# Sources and sinks


@query("""
    SELECT CAST(event_id AS VARCHAR) AS resource_id, strftime(ts, '%Y-%m-%d') AS logical_date, event_type AS form_type, CAST(user_id AS VARCHAR) AS cik FROM events
""")
def stream_ingest_available_now(spark, sf_dir):
    """Events landed as envelopes, streamed into a bronze table twice: the second run finds nothing new."""
    root = scratch(spark)
    e = _t(spark, sf_dir, "events")
    payload = F.to_json(F.struct(F.col("event_type").alias("form_type"), F.col("user_id").cast("string").alias("cik")))
    landed = e.select(F.lit("1").alias("envelope_version"), F.lit("fixture").alias("source_system"), F.lit("filing_index").alias("stream"), F.col("event_id").cast("string").alias("resource_id"), _day("ts").alias("logical_date"), F.lit("b").alias("batch_id"), F.lit("2024-01-01T00:00:00Z").alias("fetched_at"), F.lit(200).alias("http_status"), payload.alias("payload_json"))
    landing.write_envelopes(landed, landing.landing_path(f"{root}/landing", "filing_index"), compressed=True)
    table = SnapshotTable(spark, f"{root}/tables", "bronze.filing_index_raw").create(schema_of("bronze.filing_index_raw"))
    for _ in range(2):
        ingest_stream(spark, f"{root}/landing", "filing_index", table, f"{root}/state")
    return table.read().select("resource_id", _day("logical_date").alias("logical_date"), "form_type", "cik")


@query(f"""
    WITH {_CHANGES} SELECT 'change_events' AS table_name, count(*) AS row_count FROM change_events
    UNION ALL SELECT 'daily_activity', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderdate, o_orderstatus)
""")
def export_manifest(spark, sf_dir):
    """Two marts as single objects; their row counts as exported."""
    root = scratch(spark)
    frames = {"change_events": change_events(spark, sf_dir), "daily_activity": daily_activity(spark, sf_dir)}
    done = [export_table(spark, df, n, root) for n, df in frames.items()]
    return spark.createDataFrame([(e.table, e.row_count) for e in done], "table_name string, row_count long")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def snapshot_restore(spark, sf_dir):
    """A table overwritten by a mistake, and restored."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    t = SnapshotTable(spark, scratch(spark), "customer").create(c.schema)
    odd = F.coalesce(F.col("c_custkey") % 2 == 1, F.lit(False))
    t.append(c.where(odd))
    t.append(c.where(~odd))
    t.overwrite(c.limit(0))
    t.restore(2)
    return t.read()


# Silver runs over bronze made from the tables


def _bronze(df: DataFrame, name: str, **columns) -> DataFrame:
    """df as rows of a bronze table of one logical day; columns that are not given are NULL."""
    fixed = {"logical_date": F.lit("2030-01-01").cast("date"), "_ingest_batch_id": F.lit("b"), "_source_file": F.lit("f"), "_envelope_version": F.lit("1")}
    return align(df.select(*[c.alias(n) for n, c in {**fixed, **columns}.items()]), schema_of(name))


def _bronze_filings(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    form = F.when(k % 3 == 0, "10-k/a").when(k % 3 == 1, " 8-K").when(k % 97 != 0, "10-Q").otherwise(" ")
    filed = F.when(k % 50 == 0, "20240231").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return _bronze(_t(spark, sf_dir, "orders"), "bronze.filing_index_raw", resource_id=k.cast("string"), form_type=form, company_name=F.col("o_orderpriority"), cik=F.col("o_custkey").cast("string"), date_filed=filed, accession_number=F.lpad(k.cast("string"), 18, "0"), file_name=F.concat(F.lit("x/"), k.cast("string")))


_FILINGS = """filings AS (
        SELECT substr(n, 1, 10) || '-' || substr(n, 11, 2) || '-' || substr(n, 13) AS accession_number, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, o_orderpriority AS company_name,
            CASE WHEN o_orderkey % 3 = 0 THEN '10-K/A' WHEN o_orderkey % 3 = 1 THEN '8-K' WHEN o_orderkey % 97 <> 0 THEN '10-Q' END AS form_type,
            CASE WHEN o_orderkey % 3 = 0 THEN '10-K' WHEN o_orderkey % 3 = 1 THEN '8-K' WHEN o_orderkey % 97 <> 0 THEN '10-Q' END AS base_form_type, CASE WHEN o_orderkey % 50 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS filed_date
        FROM (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS n FROM orders))"""


@query(f"WITH {_FILINGS} SELECT *, coalesce(form_type, '') LIKE '%/A' AS is_amendment FROM filings")
def typed_filings(spark, sf_dir):
    f = filings.build_filings(_bronze_filings(spark, sf_dir))
    return f.select("accession_number", "cik", "company_name", "form_type", "base_form_type", _day("filed_date").alias("filed_date"), "is_amendment")


def _run_filings(spark, sf_dir) -> str:
    """Two runs of one day over all filings: the second finds nothing new, and no record is quarantined twice."""
    root = scratch(spark)
    for name in ("bronze.filing_index_raw", "silver.filing", "silver.filing_quarantine"):
        SnapshotTable(spark, root, name).create(schema_of(name))
    SnapshotTable(spark, root, "bronze.filing_index_raw").append(_bronze_filings(spark, sf_dir))
    for run in ("first", "second"):
        filings.run_filings(spark, root, "2030-01-01", run, Report("silver", run))
    return root


@query(f"WITH {_FILINGS} SELECT accession_number, cik, form_type, filed_date, 1 AS version_number, '2030-01-01' AS valid_from, true AS is_current FROM filings WHERE form_type IS NOT NULL AND filed_date IS NOT NULL")
def filings_run_table(spark, sf_dir):
    t = SnapshotTable(spark, _run_filings(spark, sf_dir), "silver.filing").read()
    return t.select("accession_number", "cik", "form_type", _day("filed_date").alias("filed_date"), "version_number", _day("valid_from").alias("valid_from"), "is_current")


@query(f"""
    WITH {_FILINGS} SELECT CASE WHEN form_type IS NULL THEN 'filing_form_type_present' ELSE 'filing_filed_date_present' END AS check_name, accession_number, 'second' AS run_id
    FROM filings WHERE form_type IS NULL OR filed_date IS NULL
""")
def quarantine_run_table(spark, sf_dir):
    t = SnapshotTable(spark, _run_filings(spark, sf_dir), "silver.filing_quarantine").read()
    return t.select(F.col("_dq_check_name").alias("check_name"), normalise.accession(F.get_json_object("record_json", "$.accession_number")).alias("accession_number"), F.col("_dq_run_id").alias("run_id"))


def _bronze_companies(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    doc = F.struct(k.cast("string").alias("cik"), F.col("c_name").alias("name"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("sic"), F.when(k % 2 == 0, F.array("c_mktsegment")).alias("tickers"), F.array(F.struct(F.lit("Old").alias("name"))).alias("formerNames"))
    return _bronze(_t(spark, sf_dir, "customer"), "bronze.company_submissions_raw", resource_id=k.cast("string"), cik=k.cast("string"), payload_json=F.to_json(doc))


_COMPANIES = """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS company_name, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS sic,
        CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS tickers, 'Old' AS former_names FROM customer
"""


def _companies(df: DataFrame) -> DataFrame:
    return df.select("cik", "company_name", "sic", F.array_join("tickers", ",").alias("tickers"), F.array_join("former_names", ",").alias("former_names"))


@query(_COMPANIES)
def typed_companies(spark, sf_dir):
    return _companies(filings.build_companies(_bronze_companies(spark, sf_dir)))


@query(_COMPANIES)
def companies_run_table(spark, sf_dir):
    root = scratch(spark)
    for name in ("bronze.company_submissions_raw", "silver.company", "silver.company_quarantine"):
        SnapshotTable(spark, root, name).create(schema_of(name))
    SnapshotTable(spark, root, "bronze.company_submissions_raw").append(_bronze_companies(spark, sf_dir))
    filings.run_companies(spark, root, "2030-01-01", "run", Report("silver", "run"))
    return _companies(SnapshotTable(spark, root, "silver.company").read().where("is_current and version_number = 1"))


def _bronze_facts(spark, sf_dir) -> DataFrame:
    """A document for each customer and one of two tags of a concept: its orders' totals, a fact each day, an assertion each order."""
    k = F.col("o_orderkey")
    fact = F.struct(
        F.when(k % 2 == 0, F.date_format(F.date_sub("o_orderdate", 90), "yyyy-MM-dd")).alias("start"), _day("o_orderdate").alias("end"), F.col("o_totalprice").cast("decimal(38,2)").alias("val"),
        F.lpad(k.cast("string"), 18, "0").alias("accn"), F.year("o_orderdate").alias("fy"), F.lit("FY").alias("fp"), F.lit("10-K").alias("form"), _day("o_orderdate").alias("filed"),
    )
    tag = F.when(k % 3 == 0, "ProfitLoss").otherwise("NetIncomeLoss")
    docs = _t(spark, sf_dir, "orders").groupBy("o_custkey", tag.alias("tag")).agg(F.collect_list(fact).alias("facts"))
    payload = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("cik"), F.lit("us-gaap").alias("taxonomy"), "tag", F.create_map(F.lit("USD"), F.col("facts")).alias("units")))
    return _bronze(docs, "bronze.company_concept_raw", resource_id=F.concat_ws("/", "o_custkey", F.lit("us-gaap"), "tag"), cik=F.col("o_custkey").cast("string"), taxonomy=F.lit("us-gaap"), tag=F.col("tag"), payload_json=payload)


_FACTS = """facts AS (
        SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN o_orderkey % 3 = 0 THEN 'ProfitLoss' ELSE 'NetIncomeLoss' END AS concept_tag, 'net_income' AS concept_canonical, 'USD' AS unit,
            CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE) - 90, '%Y-%m-%d') END AS period_start, strftime(o_orderdate, '%Y-%m-%d') AS period_end, CASE WHEN o_orderkey % 2 = 0 THEN 'duration' ELSE 'instant' END AS period_type,
            substr(n, 1, 10) || '-' || substr(n, 11, 2) || '-' || substr(n, 13) AS accession_number, round(CAST(CAST(o_totalprice AS DECIMAL(38,2)) AS DOUBLE), 6) AS value
        FROM (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 18, '0') AS n FROM orders))"""


def _facts(df: DataFrame, *more) -> DataFrame:
    return df.select("cik", "concept_tag", "concept_canonical", "unit", _day("period_start").alias("period_start"), _day("period_end").alias("period_end"), "period_type", "accession_number", _num("value").alias("value"), *more)


@query(f"WITH {_FACTS} SELECT * FROM facts")
def typed_facts(spark, sf_dir):
    return _facts(filings.build_facts(_bronze_facts(spark, sf_dir)))


@query(f"""
    WITH {_FACTS} SELECT *, CAST(row_number() OVER w AS INTEGER) AS assertion_version, lead(accession_number) OVER w AS superseded_by, lead(accession_number) OVER w IS NULL AS is_current
    FROM facts WINDOW w AS (PARTITION BY cik, unit, period_start, period_end, period_type ORDER BY accession_number)
""")
def facts_run_table(spark, sf_dir):
    root = scratch(spark)
    for name in ("bronze.company_concept_raw", "silver.financial_fact", "silver.financial_fact_quarantine"):
        SnapshotTable(spark, root, name).create(schema_of(name))
    SnapshotTable(spark, root, "bronze.company_concept_raw").append(_bronze_facts(spark, sf_dir))
    for run in ("first", "second"):
        filings.run_facts(spark, root, "2030-01-01", run, Report("silver", run))
    return _facts(SnapshotTable(spark, root, "silver.financial_fact").read(), "assertion_version", F.col("superseded_by_accession").alias("superseded_by"), F.col("is_current_assertion").alias("is_current"))


@query("""
    WITH f AS (SELECT o_custkey, o_orderkey, unnest([0, 1, 2]) AS t, o_totalprice FROM orders),
    tagged AS (SELECT *, CASE t WHEN 0 THEN 'ProfitLoss' WHEN 1 THEN 'NetIncomeLoss' ELSE 'NetIncomeLoss' END AS tag, CASE t WHEN 2 THEN 'own' ELSE 'us-gaap' END AS taxonomy FROM f)
    SELECT o_custkey, o_orderkey, tag AS concept_tag, taxonomy FROM tagged WHERE t = 1
""")
def preferred_tags(spark, sf_dir):
    """Each order asserted under three tags, one of them a company's own: the registry's preference decides."""
    f = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast(MONEY).alias("value"), F.explode(F.array(*[F.struct(F.lit(g).alias("concept_tag"), F.lit(t).alias("taxonomy")) for t, g in (("us-gaap", "ProfitLoss"), ("us-gaap", "NetIncomeLoss"), ("own", "NetIncomeLoss"))])).alias("x"))
    return marts._preferred(f.select("*", "x.*").drop("x"), marts.FactShape(["o_custkey"], "o_orderkey")).select("o_custkey", "o_orderkey", "concept_tag", "taxonomy")


@query("SELECT CAST(c_custkey AS VARCHAR) AS resource_id, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS name, '2030-01-01' AS logical_date, 'b-9' AS batch_id FROM customer")
def batch_ingest_with_ledger(spark, sf_dir):
    """Customers landed as envelopes of one day, read twice by a ledger: the second run finds nothing new; only that day's folder is read."""
    root, name = scratch(spark), "company_submissions"
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    landed = c.select(F.lit("1").alias("envelope_version"), k.alias("resource_id"), F.lit("2030-01-01").alias("logical_date"), F.to_json(F.struct(k.alias("cik"), F.col("c_name").alias("name"))).alias("payload_json"))
    for day in ("2030-01-01", "2030-01-02"):
        landing.write_envelopes(landed, landing.landing_path(f"{root}/landing", name, day), compressed=True)
    table = SnapshotTable(spark, f"{root}/tables", "bronze.company_submissions_raw").create(schema_of("bronze.company_submissions_raw"))
    for _ in range(2):
        ingest_batch(spark, f"{root}/landing", name, table, f"{root}/state", "2030-01-01", batch_id="b-9")
    doc = F.from_json("payload_json", "name string")
    return table.read().select("resource_id", normalise.cik(F.col("cik")).alias("cik"), doc["name"].alias("name"), _day("logical_date").alias("logical_date"), F.col("_ingest_batch_id").alias("batch_id"))


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS kind, CAST(count(*) AS INTEGER) AS filing_count, 'run-7' AS run_id, CAST(3 AS BIGINT) AS source_version, '2030-01-01' AS generated FROM orders GROUP BY 1, 2
""")
def stamped_mart(spark, sf_dir):
    """A rebuilt mart, stamped with its run and source version."""
    name = "gold.filing_activity_daily"
    a = marts.daily_activity(_t(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus", F.lit(False), "o_custkey").withColumnsRenamed({"o_orderdate": "filed_date", "o_orderstatus": "base_form_type"})
    t = SnapshotTable(spark, scratch(spark), name).create(schema_of(name))
    for _ in range(2):
        write_mart(t, a, "run-7", 3, "2030-01-01")
    return t.read().select(_day("filed_date").alias("day"), F.col("base_form_type").alias("kind"), "filing_count", F.col("_run_id").alias("run_id"), F.col("_source_version").alias("source_version"), _day("_generated_at").alias("generated"))


@query("""
    SELECT '10-K' AS form_type, c_name AS company_name, CAST(c_custkey AS VARCHAR) AS cik, '20300101' AS date_filed, 'x/' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-30-000001.txt' AS file_name,
        lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-30-000001' AS accession_number FROM customer
""")
def index_lines(spark, sf_dir):
    """Customers as lines of a daily index, with a heading and a rule between them, read back."""
    k = F.col("c_custkey").cast("string")
    line = F.concat(F.rpad(F.lit("10-K"), 12, " "), F.rpad("c_name", 40, " "), F.rpad(k, 12, " "), F.lit("20300101    x/"), F.lpad(k, 10, "0"), F.lit("-30-000001.txt  "))
    lines = _t(spark, sf_dir, "customer").select(F.explode(F.array(line, F.lit("-" * 60), F.lit("Form Type   Company Name      CIK     Date Filed  File Name"))).alias("value"))
    return landing.parse_index(lines)


# Joins by time


@query("""
    WITH v AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT p.event_id, CASE WHEN floor(epoch(p.ts)) - floor(epoch(v.ts)) <= 172800 THEN v.view_id END AS view_id
    FROM events p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts WHERE p.event_type = 'purchase'
""")
def asof_previous_view(spark, sf_dir):
    """Each purchase with the user's last view in the two days before it; users' rows are dealt by week."""
    e = _t(spark, sf_dir, "events")
    views = e.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    found = joins.asof(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", tolerance=172_800, width=7 * 86_400, prefix="v_")
    return found.select("event_id", F.col("v_view_id").alias("view_id"))


_BAND = "CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'mid' ELSE 'high' END"


@query(f"""
    WITH {_STATE}, b AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max({_BAND}, (ts, event_id)) AS band FROM events GROUP BY 1, 2),
    bc AS (SELECT * FROM (SELECT *, lag(band) OVER (PARTITION BY user_id ORDER BY day) AS before FROM b) WHERE before IS DISTINCT FROM band),
    bands AS (SELECT user_id, band, row_number() OVER w AS n, day AS a, lead(day) OVER w - 1 AS z FROM bc WINDOW w AS (PARTITION BY user_id ORDER BY day))
    SELECT v.user_id, v.event_type, CAST(v.version_number AS INTEGER) AS version_number, band, CAST(n AS INTEGER) AS band_version FROM versions v JOIN bands ON v.user_id = bands.user_id
        AND v.valid_from <= coalesce(z, DATE '9999-12-31') AND a <= coalesce(v.valid_to, DATE '9999-12-31')
""")
def overlapping_versions(spark, sf_dir):
    """Pairs of versions of two histories of one user, of the last event's type and of its value's band, that share a day."""
    e = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    bands = e.groupBy("user_id", "day").agg(F.max_by(F.expr(_BAND), F.struct("ts", "event_id")).alias("band"))
    bands = versioning.history_from(bands, ["user_id"], ["band"], "day").select("user_id", "band", "version_number", "valid_from", "valid_to")
    pairs = joins.overlaps(_versions(spark, sf_dir), bands, ["user_id"], ("valid_from", "valid_to"), width=5 * 86_400, prefix="b_")
    return pairs.select("user_id", "event_type", "version_number", F.col("b_band").alias("band"), F.col("b_version_number").alias("band_version"))


# Changes between versions, and a mart that they keep


_ORDERS_MOVED = """now AS (
        SELECT o_orderkey, o_custkey AS cik, CASE WHEN o_orderkey % 100 = 1 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS day, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS kind, o_orderpriority = '1-URGENT' AS amended FROM orders
        UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderdate, o_orderstatus, false FROM orders WHERE o_orderkey % 1000 = 5)"""


def _moved_orders(spark, sf_dir, root: str, after=lambda table: None) -> SnapshotTable:
    """Orders merged into a table in three steps: all, those whose kind changes, and those of another day with some new ones."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("filed_date"), F.col("o_orderstatus").alias("base_form_type"), F.col("o_custkey").alias("cik"), (F.col("o_orderpriority") == "1-URGENT").alias("is_amendment"))
    table = SnapshotTable(spark, root, "orders").create(StructType([*o.schema.fields, *_schema("_first_seen_ts timestamp, _last_seen_ts timestamp").fields]), buckets=8)
    k = F.col("o_orderkey")
    moved = o.where(k % 100 == 1).withColumn("filed_date", F.date_add("filed_date", 1))
    added = o.where(k % 1000 == 5).withColumns({"o_orderkey": k + 100000000, "is_amendment": F.lit(False)})
    for step in (o, o.where(k % 10 == 0).withColumn("base_form_type", F.lit("X")), moved.unionByName(added)):
        versioning.merge_scd1(table, step, ["o_orderkey"])
        after(table)
    return table


@query(f"""
    WITH {_ORDERS_MOVED} SELECT strftime(day, '%Y-%m-%d') AS day, kind, CAST(count(*) AS INTEGER) AS filing_count, CAST(count(*) FILTER (WHERE amended) AS INTEGER) AS amendment_count,
        CAST(count(DISTINCT cik) AS INTEGER) AS distinct_cik_count, CAST(3 AS BIGINT) AS source_version FROM now GROUP BY ALL
""")
def activity_incremental(spark, sf_dir):
    """Daily activity kept by the changes of three merges; it equals a rebuild."""
    root, name, group = scratch(spark), "gold.filing_activity_daily", ["filed_date", "base_form_type"]
    mart = SnapshotTable(spark, root, name).create(schema_of(name))

    def follow(table: SnapshotTable) -> None:
        support = SnapshotTable(spark, root, "support").create(incremental.support_schema(table.schema, group, "cik"), buckets=8)
        incremental.update_activity(table, support, mart, "run", where=None)

    _moved_orders(spark, sf_dir, root, follow)
    return mart.read().select(_day("filed_date").alias("day"), F.col("base_form_type").alias("kind"), "filing_count", "amendment_count", "distinct_cik_count", F.col("_source_version").alias("source_version"))


_ARRIVED = "arrived AS (SELECT * REPLACE (CASE WHEN user_id % 100 = 3 AND event_id % 10 = 3 THEN value * 2 ELSE value END AS value) FROM events WHERE user_id % 100 = 3 OR event_id % 10 <> 3)"


def _kept_by_bucket(spark, sf_dir) -> tuple[SnapshotTable, SnapshotTable]:
    """Assertions in two merges, of which the second brings some users' late ones, each at twice its value; (change events, current assertions) kept by bucket."""
    root, grain, facts = scratch(spark), EVENT_SHAPE.grain, _event_facts(spark, sf_dir)
    table = SnapshotTable(spark, root, "facts").create(StructType([*facts.schema.fields, *_schema("_first_seen_ts timestamp, _last_seen_ts timestamp").fields]), buckets=32)
    events_of = lambda rows, _=None: marts.change_events(rows, shape=EVENT_SHAPE)
    make = lambda name, df: SnapshotTable(spark, root, name).create(stamp(df, "", None).schema)
    events = make("events", events_of(facts))
    current_of = lambda rows, hit: marts.current_assertion(rows, incremental.in_buckets(events, hit), EVENT_SHAPE, keep=["event_id", "value"])
    current = make("current", current_of(facts, None))
    late = F.col("event_id") % 10 == 3
    doubled = facts.where(late & (F.col("user_id") % 100 == 3)).withColumn("value", (F.col("value") * 2).cast(MONEY))
    for step in (facts.where(~late), doubled):
        versioning.merge_scd1(table, step, ["event_id", *grain], bucket_by=["user_id"])
        incremental.update_by_bucket(table, events, events_of, ["user_id"], "run")
        incremental.update_by_bucket(table, current, current_of, ["user_id"], "run", inputs={"events": events.version()})
    return events, current


@query(f"""
    WITH {_ARRIVED}, {_CHANGES.replace('FROM events', 'FROM arrived')} SELECT restatement_id, user_id, event_type, strftime(day, '%Y-%m-%d') AS day, original_event_id, restated_event_id, round(delta_abs, 6) AS delta_abs, band FROM change_events
""")
def change_events_by_bucket(spark, sf_dir):
    """Change events of buckets whose assertions differ made anew, all others kept; it equals a rebuild."""
    c = _kept_by_bucket(spark, sf_dir)[0].read()
    return c.select("restatement_id", "user_id", "event_type", _day("day").alias("day"), "original_event_id", "restated_event_id", _num("delta_abs").alias("delta_abs"), F.col("materiality_band").alias("band"))


@query(f"""
    WITH {_ARRIVED}, {_CHANGES.replace('FROM events', 'FROM arrived')}, ranked AS (
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, value, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn,
            count(*) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS n FROM arrived)
    SELECT r.user_id, r.event_type, strftime(r.day, '%Y-%m-%d') AS day, r.event_id, round(r.value, 6) AS value, CAST(r.n AS INTEGER) AS assertion_count,
        EXISTS (SELECT 1 FROM change_events c WHERE c.user_id = r.user_id AND c.event_type = r.event_type AND c.day = r.day) AS was_restated
    FROM ranked r WHERE rn = 1
""")
def current_assertion_by_bucket(spark, sf_dir):
    """Current assertions kept likewise, by the events of the same buckets."""
    c = _kept_by_bucket(spark, sf_dir)[1].read()
    return c.select("user_id", "event_type", _day("day").alias("day"), "event_id", _num("value").alias("value"), "assertion_count", "was_restated")


@query(f"""
    WITH {_ORDERS_MOVED}, old AS (SELECT o_orderkey, o_orderdate AS day, o_orderstatus AS kind FROM orders), new AS (SELECT o_orderkey, day, kind FROM now)
    SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS day, kind, -1 AS change FROM (FROM old EXCEPT ALL FROM new) UNION ALL SELECT o_orderkey, strftime(day, '%Y-%m-%d'), kind, 1 FROM (FROM new EXCEPT ALL FROM old)
""")
def change_feed(spark, sf_dir):
    """Rows that two merges took away and brought, from the parts that differ alone."""
    table = _moved_orders(spark, sf_dir, scratch(spark))
    c = table.changes(1, 3, ignore=incremental.PROCESSING)
    return c.select("o_orderkey", _day("filed_date").alias("day"), F.col("base_form_type").alias("kind"), F.col("_change").alias("change"))


# Streams with state


def _slices(df: DataFrame, slice_, last: int, key: str, folder: str, closing: DataFrame):
    """Lands df slice by slice, every seventh row one slice late, then a closing row that lets all state go; yields after each."""
    late = (slice_ + F.when(F.col(key) % 7 == 0, 1).otherwise(0)).cast("int")
    for k in range(last + 2):
        df.where(F.coalesce(late, F.lit(0)) == k).write.mode("append").parquet(folder)
        if k == last + 1:
            closing.write.mode("append").parquet(folder)
        yield k


@query("""
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS n_events FROM (
        SELECT *, sum(CASE WHEN ts - before < INTERVAL 12 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island
        FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE ts IS NOT NULL)) GROUP BY user_id, island
""")
def stream_sessions(spark, sf_dir):
    """Sessions of users with pauses of twelve hours, from seven runs of one stream whose rows come up to twelve days late."""
    root = scratch(spark)
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    closing = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), F.lit("2034-01-01").cast("timestamp").alias("ts"))
    table = None
    for _ in _slices(e, F.floor((F.dayofmonth("ts") - 1) / 6), 4, "event_id", f"{root}/in", closing):
        found = stateful.sessions(spark.readStream.schema(e.schema).parquet(f"{root}/in"), ["user_id"], "ts", "12 hours", "12 days")
        table = table or SnapshotTable(spark, root, "sessions").create(found.schema)
        stateful.run_to_table(found, table, f"{root}/state")
    second = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return table.read().select("user_id", second("started"), second("ended"), "n_events")


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 90 DAY
""")
def stream_stream_join(spark, sf_dir):
    """Orders as filings and their lines of the next 90 days as facts, two streams in three slices, with late rows on both sides.

    All of the state is live until the end, so it is kept in a table.
    """
    root = scratch(spark)
    time = lambda c: F.col(c).cast("timestamp").alias(c)
    o = _t(spark, sf_dir, "orders").select("o_orderkey", time("o_orderdate"))
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", time("l_shipdate"))
    end = F.lit("2044-01-01").cast("timestamp")
    far = spark.range(1).select(F.lit(-1).cast("long").alias("o_orderkey"), end.alias("o_orderdate"), F.lit(0).alias("l_linenumber"), end.alias("l_shipdate"))
    table, slice_ = SnapshotTable(spark, root, "joined"), lambda c: F.least(F.greatest(F.floor((F.year(c) - 1995) / 3), F.lit(0)), F.lit(2))
    sides = zip(_slices(o, slice_("o_orderdate"), 2, "o_orderkey", f"{root}/filings", far.select(*o.columns)), _slices(lines, slice_("l_shipdate"), 2, "o_orderkey", f"{root}/facts", far.select(*lines.columns)))
    for _ in sides:
        read = lambda df, n: spark.readStream.schema(df.schema).parquet(f"{root}/{n}")  # noqa: E731, B023
        stateful.join_to_table(read(o, "filings"), read(lines, "facts"), ["o_orderkey"], "o_orderdate", "l_shipdate", "90 days", table, f"{root}/state", delay="2200 days")
    closed = F.col("o_orderkey").eqNullSafe(-1) & F.col("o_orderdate").eqNullSafe(end)
    return table.read().where(~closed).select("o_orderkey", _day("o_orderdate").alias("ordered"), "l_linenumber", _day("l_shipdate").alias("shipped"))


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS resource_id, strftime(ts, '%Y-%m-%d') AS content FROM events")
def stream_first_arrivals(spark, sf_dir):
    """Envelopes of a user's day, one for each event: the first alone is kept, over three runs, however they are dealt."""
    root, name = scratch(spark), "filing_index"
    day = _day("ts")
    landed = _t(spark, sf_dir, "events").select(F.lit("1").alias("envelope_version"), F.lit(name).alias("stream"), F.col("user_id").cast("string").alias("resource_id"), day.alias("content_sha256"), F.concat(day, F.lit("T00:00:00Z")).alias("fetched_at"), (F.col("event_id") % 3).alias("part"))
    table = None
    for k in range(3):
        landing.write_envelopes(landed.where(F.coalesce(F.col("part"), F.lit(0)) == k).drop("part"), f"{landing.landing_path(root, name)}/run={k}")
        found = stateful.first_arrivals(read_stream(spark, root, name), delay="60 days").select("resource_id", F.col("content_sha256").alias("content"))
        table = table or SnapshotTable(spark, f"{root}/tables", "firsts").create(found.schema)
        stateful.run_to_table(found, table, f"{root}/state")
    return table.read()


# Checks against a second table, roll-ups, ranges, statements


@query("SELECT DISTINCT l_orderkey, l_linenumber, sha256('lineitem|order_known|{\"l_orderkey\":' || l_orderkey || ',\"l_linenumber\":' || l_linenumber || '}') AS record_id FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def orphan_lines(spark, sf_dir):
    """Lines whose order is not among the final ones, as quarantined twice: a replay adds nothing."""
    lines = _t(spark, sf_dir, "lineitem").withColumn("_raw", F.struct("l_orderkey", "l_linenumber"))
    check = quality.Reference("order_known", {"l_orderkey": "o_orderkey"})
    root = scratch(spark)
    q = quality.apply_reference(lines, check, _t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"), "run", "lineitem", raw="_raw", staged=f"{root}/_staged").quarantined
    table = SnapshotTable(spark, root, "quarantine").create(q.schema)
    for _ in range(2):
        versioning.merge_scd1(table, q, ["_dq_record_id"], operation="quarantine", buckets=4)
    of = lambda k, kind: F.get_json_object("record_json", f"$.{k}").cast(kind).alias(k)
    return table.read().select(of("l_orderkey", "long"), of("l_linenumber", "int"), F.col("_dq_record_id").alias("record_id"))


@query("SELECT 'price_cap' AS check_name, count(*) AS failed, least(count(*), 3) AS samples FROM orders WHERE NOT coalesce(o_totalprice < 100000, false)")
def batch_rejection(spark, sf_dir):
    """What a check that no batch may fail says about a batch that fails it."""
    checks = [quality.Check("price_cap", "o_totalprice < 100000", quality.REJECT_BATCH)]
    try:
        quality.apply_checks(_t(spark, sf_dir, "orders"), checks, "run", "orders")
        said = ("price_cap", 0, 0)
    except quality.BatchRejected as e:
        said = (e.check.name, e.failed, len(e.samples))
    return spark.createDataFrame([said], "check_name string, failed long, samples long")


@query("""
    SELECT 1 AS step, count(*) AS inserted, 0::BIGINT AS updated FROM customer
    UNION ALL SELECT 2, count(*) FILTER (WHERE c_custkey % 100 = 1), count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer UNION ALL SELECT 3, 0, count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer
""")
def merge_counts(spark, sf_dir):
    """Rows that three merges inserted and updated, as their manifests tell."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    table = SnapshotTable(spark, scratch(spark), "customers").create(StructType([*c.schema.fields, *_schema("_first_seen_ts timestamp, _last_seen_ts timestamp").fields]), buckets=8)
    moved = c.where("c_custkey % 10 = 0")
    for step in (c, moved.unionByName(c.where("c_custkey % 100 = 1").withColumn("c_custkey", F.col("c_custkey") + 1000000)), moved):
        versioning.merge_scd1(table, step, ["c_custkey"])
    told = [(m["version"], m["metrics"]["inserted"], m["metrics"]["updated"]) for m in table.history() if m["version"]]
    return spark.createDataFrame(told, "step int, inserted long, updated long")


@query("""
    SELECT o_orderstatus AS kind, o_orderpriority AS priority, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level, count(*) AS row_count, true AS within_bound FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
""")
def activity_rollup(spark, sf_dir):
    """Orders rolled up from sketches by day, kind and priority; distinct customers are within four standard errors of the exact number."""
    o, groups = _t(spark, sf_dir, "orders"), ["kind", "priority"]
    rows = o.select(F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("day"), "o_custkey")
    rolled = marts.rolled_up(marts.distinct_sketches(rows, [*groups, "day"], "o_custkey"), groups)
    exact = rows.rollup(*groups).agg(F.grouping_id().alias("level"), F.count_distinct("o_custkey").alias("n"))
    same = versioning.null_safe("r", "x", [*groups, "level"])
    off = F.abs(F.col("about_distinct") - F.col("n")) <= 4 * marts.SKETCH_ERROR * F.col("n") + 1
    return rolled.alias("r").join(exact.alias("x"), same).select("r.kind", "r.priority", "r.level", "row_count", off.alias("within_bound"))


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND CURRENT ROW) - 1 AS recent_count FROM orders")
def recent_orders(spark, sf_dir):
    """Orders of a customer in the 365 days before each of them, those of the same moment too."""
    return marts.recent_before(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", 365).select("o_orderkey", "recent_count")


@query("""
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS unit, round(min(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS final, round(min(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS open
    FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice IS NOT NULL GROUP BY 1, 2, 3
""")
def statement_pivot(spark, sf_dir):
    """Orders of a day as a statement, statuses as concepts, in two units that are kept apart."""
    facts = _t(spark, sf_dir, "orders").select("o_custkey", _day("o_orderdate").alias("day"), F.when(F.col("o_orderkey") % 2 == 0, "USD").otherwise("EUR").alias("unit"), F.col("o_orderstatus").alias("concept_canonical"), F.col("o_totalprice").alias("value"))
    s = marts.statements(facts, ["F", "O"], ["o_custkey", "day"])
    return s.select("o_custkey", "day", "unit", _num("F").alias("final"), _num("O").alias("open"))


@query("""
    SELECT o_custkey, array_to_string(list_sort(list(CAST(o_orderkey AS VARCHAR)))[1:3], ',') AS accessions, 0 AS files, 'kept' AS other FROM orders GROUP BY o_custkey
""")
def trimmed_payloads(spark, sf_dir):
    """A document for each customer with parallel arrays of its orders, cut to three entries each."""
    key = F.col("o_orderkey").cast("string")
    docs = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(key)).alias("accessionNumber"))
    recent = F.struct("accessionNumber", F.transform("accessionNumber", lambda _: F.lit("10-K")).alias("form"))
    payload = F.to_json(F.struct(F.lit("kept").alias("other"), F.struct(recent.alias("recent"), F.array(F.lit("more.json")).alias("files")).alias("filings")))
    cut = docs.select("o_custkey", F.from_json(landing.trim_recent(payload, 3), "other string, filings struct<recent:struct<accessionNumber:array<string>,form:array<string>>,files:array<string>>").alias("d"))
    return cut.select("o_custkey", F.array_join("d.filings.recent.accessionNumber", ",").alias("accessions"), F.size("d.filings.files").alias("files"), "d.other")


@query("""
    SELECT form_type, cik FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN '10-K' WHEN c_custkey % 3 = 1 THEN '8-K' ELSE 'S-1' END AS form_type, CAST(c_custkey AS VARCHAR) AS cik, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS n FROM customer)
    WHERE form_type <> 'S-1' OR n IN ('0000000005', '0000000008') ORDER BY n NOT IN ('0000000005', '0000000008'), CASE form_type WHEN '8-K' THEN 1 WHEN '10-K' THEN 2 ELSE 9 END, n LIMIT 20
""")
def selected_filings(spark, sf_dir):
    """Twenty rows of an index, the limit being the feature: two forced companies of another form, then by the rank of forms."""
    k = F.col("c_custkey")
    index = _t(spark, sf_dir, "customer").select(F.when(k % 3 == 0, "10-K").when(k % 3 == 1, "8-K").otherwise("S-1").alias("form_type"), k.cast("string").alias("cik"), F.lpad(k.cast("string"), 10, "0").alias("accession_number"))
    return landing.select_filings(index, 20, ["5", "8"], {"8-K": 1, "10-K": 2}).select("form_type", "cik")


@query("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(user_id AS VARCHAR) END AS cik, CASE WHEN event_id % 3 > 1 THEN 'us-gaap' END AS taxonomy, CASE WHEN event_id % 3 > 1 THEN event_type END AS tag, strftime(ts, '%Y-%m-%d') AS logical_date FROM events")
def concept_projection(spark, sf_dir):
    """Bronze rows of concept documents whose ids have all, one or none of their parts."""
    user, k = F.col("user_id").cast("string"), F.col("event_id") % 3
    e = _t(spark, sf_dir, "events").withColumns({c: F.lit(None).cast("string") for c in ("batch_id", "source_system", "envelope_version", "_source_file", landing.RESCUED, "fetched_at", "payload_json")})
    e = e.withColumns({"resource_id": F.when(k == 2, F.concat_ws("/", user, F.lit("us-gaap"), "event_type")).when(k == 1, user), "logical_date": _day("ts")})
    return landing.project_company_concept(landing.with_metadata(e), "event_id").select("event_id", "cik", "taxonomy", "tag", _day("logical_date").alias("logical_date"))


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY date_trunc('year', l_shipdate) DESC NULLS LAST, l_returnflag, l_orderkey, l_linenumber) = 1")
def latest_of_tied_periods(spark, sf_dir):
    """The newest year of each part, where many rows end together: the first by all other columns in their order."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", F.date_trunc("year", "l_shipdate").alias("period_end"), "l_returnflag", "l_orderkey", "l_linenumber")
    return marts.latest_by_period(rows, ["l_partkey"], "period_end").select("l_partkey", "l_orderkey", "l_linenumber")
