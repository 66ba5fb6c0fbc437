"""Landed newline-delimited JSON envelopes: paths, batch reads with a ledger, and rescue of unknown fields."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..runtime.files import Store

_TEXT = "envelope_version source_system stream resource_id logical_date batch_id fetched_at request_url http_status content_sha256 payload_json".split()
ENVELOPE = StructType([StructField(c, IntegerType() if c == "http_status" else StringType()) for c in _TEXT])
SUPPORTED_VERSIONS = ("1",)
RESCUED, MALFORMED = "_rescued_data", "_malformed"


@dataclass(frozen=True)
class Stream:
    name: str
    table: str
    mode: str = "opaque_json"

    def __post_init__(self):
        if self.mode not in ("passthrough", "opaque_json"):
            raise ValueError(f"{self.name}: unknown mode {self.mode}")


STREAMS = {s.name: s for s in (Stream("filing_index", "filing_index_raw", "passthrough"), Stream("company_submissions", "company_submissions_raw"), Stream("company_concept", "company_concept_raw"))}


def stream(name: str) -> Stream:
    if name not in STREAMS:
        raise KeyError(f"unknown stream {name}; known are {', '.join(sorted(STREAMS))}")
    return STREAMS[name]


def landing_path(root: str, name: str, logical_date: str | None = None) -> str:
    return f"{root.rstrip('/')}/{stream(name).name}" + (f"/logical_date={logical_date}" if logical_date else "")


def checkpoint_path(root: str, name: str) -> str:
    """Own checkpoint of each stream, never shared."""
    return f"{root.rstrip('/')}/_checkpoints/{stream(name).name}"


def parse_envelopes(lines: DataFrame, schema: StructType = ENVELOPE, value: str = "value") -> DataFrame:
    """Envelope columns of JSON lines.

    _rescued_data holds, as JSON, every unknown field and every known one whose value does not fit its type; NULL if there
    is none.  A line that is no JSON object has NULL columns and is kept whole in _malformed.  The same code serves batch
    and stream.
    """
    raw = F.from_json(F.col(value), "map<string,string>")
    rows = lines.where(F.length(F.trim(F.col(value))) > 0).withColumn("_raw", raw)
    typed = {f.name: F.expr(f"try_cast(_raw['{f.name}'] as {f.dataType.simpleString()})") for f in schema.fields}
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    misfits = [F.when(typed[f.name].isNull() & F.col("_raw")[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields if not isinstance(f.dataType, StringType)]
    misfit = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    rescued = F.map_filter("_raw", lambda k, v: ~F.array_contains(known, k) | F.array_contains(misfit, k))
    others = [c for c in lines.columns if c != value]
    return rows.select(*[typed[f.name].alias(f.name) for f in schema.fields], F.when(F.size(rescued) > 0, F.to_json(rescued)).alias(RESCUED), F.when(F.col("_raw").isNull(), F.col(value)).alias(MALFORMED), *others)


def unsupported_versions(envelopes: DataFrame, supported=SUPPORTED_VERSIONS, malformed: str = MALFORMED) -> DataFrame:
    """Distinct envelope versions that are not supported; a malformed line has none and is not one."""
    rows = envelopes.where(F.col(malformed).isNull()) if malformed in envelopes.columns else envelopes
    return rows.select("envelope_version").distinct().where(F.col("envelope_version").isNull() | ~F.col("envelope_version").isin(*supported))


def require_versions(envelopes: DataFrame, supported=SUPPORTED_VERSIONS) -> None:
    if found := [r[0] for r in unsupported_versions(envelopes, supported).limit(5).collect()]:
        raise ValueError(f"envelope versions {found} are not among {list(supported)}; nothing was ingested")


def rescued_rows(df: DataFrame) -> Column:
    """Aggregate: rows with rescued data."""
    return F.count_if(F.col(RESCUED).isNotNull())


@dataclass
class LandingBatch:
    """Envelopes of files that are not in the ledger, or of a batch that was begun there and not finished.

    begin() notes files and number, before rows are written; commit() after it that they are.  Of two drivers that begin one
    number one wins, and the other has to read again.
    """

    frame: DataFrame
    files: list[str]
    number: int
    resumed: bool
    place: str
    _store: Store = field(repr=False)
    _folder: str = ""

    @property
    def is_empty(self) -> bool:
        return not self.files

    def begin(self) -> bool:
        return self.resumed or self._store.create(f"{self._folder}/{self.number:08d}.json", json.dumps(self.files).encode())

    def commit(self) -> None:
        if self.files:
            self.begin()
            self._store.write(f"{self._folder}/{self.number:08d}.done", b"")


#: Ledger of runs over all days.
ALL_DAYS = "all"


def _entries(store: Store, folder: str) -> dict[int, tuple[list[str], bool]]:
    """Batches of a ledger folder: files, and whether they are done."""
    names = set(store.names(folder))
    return {int(n[:8]): (json.loads(store.read(f"{folder}/{n}")), f"{n[:8]}.done" in names) for n in names if n.endswith(".json")}


def landing_files(spark: SparkSession, root: str, name: str, logical_date: str | None = None) -> list[str]:
    """Sorted NDJSON files, compressed ones too; none if the folder is not there."""
    return [p for p, _ in Store(spark).list(landing_path(root, name, logical_date)) if p.rsplit("/", 1)[-1].endswith((".json", ".json.gz"))]


def read_landing_batch(spark: SparkSession, root: str, name: str, ledger_root: str, logical_date: str | None = None, file_filter=None) -> LandingBatch:
    """Envelopes of new files; with logical_date, of that day's folder alone, by that day's part of the ledger.

    A batch that was begun and is not done comes first, as it was.
    """
    store, top, place = Store(spark), f"{checkpoint_path(ledger_root, name)}/ledger", logical_date or ALL_DAYS
    read = {d: _entries(store, f"{top}/{d}") for d in ({place, ALL_DAYS} if logical_date else {ALL_DAYS, *store.names(top)})}
    own = read[place]
    if open_ := sorted(n for n, (_, done) in own.items() if not done):
        number, files = open_[0], own[open_[0]][0]
    else:
        seen = {f for entries in read.values() for files, _ in entries.values() for f in files}
        number = max(own, default=0) + 1
        files = [p for p in landing_files(spark, root, name, logical_date) if p not in seen and (file_filter is None or file_filter(p))]
    if files:
        frame = parse_envelopes(spark.read.text(files).select("value", F.col("_metadata.file_path").alias("_source_file")))
    else:
        extra = [StructField(c, StringType()) for c in (RESCUED, MALFORMED, "_source_file")]
        frame = spark.createDataFrame([], StructType([*ENVELOPE.fields, *extra]))
    return LandingBatch(frame, files, number, bool(open_), place, store, f"{top}/{place}")


# Bronze projections

INDEX_PAYLOAD = "form_type string, company_name string, cik string, date_filed string, accession_number string, file_name string"


def with_metadata(df: DataFrame, source_system: str = "unknown", batch_id: str = "unknown", ingest_ts: str | None = None) -> DataFrame:
    """Six metadata columns: the envelope's values, else given ones."""
    at = F.current_timestamp() if ingest_ts is None else F.to_timestamp(F.lit(ingest_ts))
    return df.withColumns({"_ingest_batch_id": F.coalesce("batch_id", F.lit(batch_id)), "_ingest_ts": at, "_source_system": F.coalesce("source_system", F.lit(source_system)), "_envelope_version": F.col("envelope_version")})


METADATA = ["_ingest_batch_id", "_ingest_ts", "_source_file", "_source_system", "_envelope_version", RESCUED]


def _common() -> list[Column]:
    return [F.try_to_date("logical_date", "yyyy-MM-dd").alias("logical_date"), "resource_id", F.try_to_timestamp("fetched_at").alias("fetched_at")]


def project_filing_index(df: DataFrame, *more: str) -> DataFrame:
    return df.withColumn("p", F.from_json("payload_json", INDEX_PAYLOAD)).select(*_common(), "p.*", *METADATA, *more)


def project_company_submissions(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*_common(), F.col("resource_id").alias("cik"), "payload_json", *METADATA, *more)


def project_company_concept(df: DataFrame, *more: str) -> DataFrame:
    """cik, taxonomy and tag from the resource id; parts that are not there are NULL."""
    part = F.split("resource_id", "/")
    return df.select(*_common(), F.get(part, 0).alias("cik"), F.get(part, 1).alias("taxonomy"), F.get(part, 2).alias("tag"), "payload_json", *METADATA, *more)


PROJECTIONS = {"filing_index": project_filing_index, "company_submissions": project_company_submissions, "company_concept": project_company_concept}


# Index files and fixtures

def parse_index(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rows of a daily index; headers and other lines do not fit and go.

    A line ends in three words without blanks inside: company number, day and file.  The form is what stands before the first run of
    two or more blanks, and the company is all between, blanks inside it included.
    """
    line = r"^(\S+(?:\s\S+)*)\s{2,}(\S.*?)\s+([0-9]{1,10})\s+([0-9]{8}|[0-9]{4}-[0-9]{2}-[0-9]{2})\s+(\S+)$"
    names = ("form_type", "company_name", "cik", "date_filed", "file_name")
    text = F.trim(F.col(value))
    rows = lines.select(text.alias("t")).where(F.col("t").rlike(line))
    rows = rows.select(*[F.regexp_extract("t", line, k).alias(n) for k, n in enumerate(names, 1)])
    return rows.withColumn("accession_number", F.regexp_extract("file_name", r"([0-9]{10}-[0-9]{2}-[0-9]{6})", 1))


def select_filings(index: DataFrame, limit: int, forced: list[str] = (), ranks: dict[str, int] | None = None) -> DataFrame:
    """At most `limit` rows, the same ones each time: forced ids first, then by form rank, then by accession.

    With ranks only forms among them are taken, and forced ids whatever their form.  Ids are compared with leading zeros.
    """
    padded = [str(c).zfill(10) for c in forced]
    is_forced = F.lpad("cik", 10, "0").isin(*padded) if padded else F.lit(False)
    rank = F.try_element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col("form_type")) if ranks else F.lit(0)
    rows = index.where(is_forced | rank.isNotNull()) if ranks else index
    return rows.orderBy((~is_forced).cast("int"), F.coalesce(rank, F.lit(2**31 - 1)), "accession_number", *(c for c in ("file_name", "form_type", "company_name") if c in index.columns)).limit(limit)


def trim_recent(payload: Column, n: int) -> Column:
    """The payload with its parallel arrays of recent filings cut to n entries each and its list of further files emptied.

    All other keys stay.  JSON without recent filings stays as it is, but for blanks and the order of keys; other text is NULL.
    """
    opened = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    changed = lambda m, new: F.map_concat(F.map_filter(m, lambda k, _: ~k.isin(*new)), F.create_map(*[x for k, v in new.items() for x in (F.lit(k), v)]))
    whole = F.try_parse_json(payload)
    top, filings, recent = (opened(F.try_variant_get(whole, p, "variant")) for p in ("$", "$.filings", "$.filings.recent"))
    cut = F.transform_values(recent, lambda _, v: F.coalesce(F.to_variant_object(F.slice(F.try_variant_get(v, "$", "array<variant>"), 1, n)), v))
    files = F.try_parse_json(F.lit("[]"))
    trimmed = changed(top, {"filings": F.to_variant_object(changed(filings, {"recent": F.to_variant_object(cut), "files": files}))})
    return F.when(recent.isNotNull(), F.to_json(F.to_variant_object(trimmed))).otherwise(F.to_json(whole))


def write_envelopes(df: DataFrame, path: str, compressed: bool = False) -> None:
    """NDJSON(.gz) files, for fixtures."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip" if compressed else "none").json(path)
