import pytest
from pyspark.sql import functions as F

from factloom.operators import quality
from factloom.operators.quality import BatchRejected, Check, apply_checks
from factloom.plans import inspect

ROWS = [(1, "ok", "f"), (2, None, "f"), (3, "ok", "f"), (-4, "ok", "f"), (None, "ok", "f")]
SCHEMA = "id int, label string, _source_file string"
POSITIVE, LABELLED = Check("positive", "id > 0", description="ids are positive"), Check("labelled", "label is not null", quality.WARN)


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_reject_takes_rows_out_and_null_fails(df):
    got = apply_checks(df, [POSITIVE], "r", "t")
    assert sorted(r.id for r in got.passed.collect()) == [1, 2, 3]
    q = got.quarantined.collect()
    assert {r._dq_check_name for r in q} == {"positive"} and {r._dq_failure_reason for r in q} == {"ids are positive"} and len(q) == 2
    assert got.passed.columns == df.columns


def test_warn_never_drops(df):
    got = apply_checks(df, [LABELLED], "r", "t")
    assert got.passed.count() == 5 and got.quarantined.count() == 0 and got.has_warnings
    assert got.metrics["dq.labelled.warn"] == 1


def test_each_check_has_a_metric_even_at_zero(df):
    got = apply_checks(df.where("id > 0"), [POSITIVE, LABELLED], "r", "t").metrics
    assert got["dq.positive.failed"] == 0 and got["dq.rows_in"] == 3 and got["dq.rows_passed"] == 3 and got["dq.rows_quarantined"] == 0


def test_a_row_that_fails_twice_counts_once_under_the_first(spark):
    df = spark.createDataFrame([(-1, None, "f")], SCHEMA)
    got = apply_checks(df, [POSITIVE, Check("named", "label is not null")], "r", "t")
    assert got.metrics["dq.rows_quarantined"] == 1 and [r._dq_check_name for r in got.quarantined.collect()] == ["positive"]


def test_reject_batch_raises_with_samples(df):
    with pytest.raises(BatchRejected) as e:
        apply_checks(df, [Check("all_positive", "id > 0", quality.REJECT_BATCH)], "r", "t")
    assert e.value.failed == 2 and len(e.value.samples) == 2


def test_no_checks(df):
    got = apply_checks(df, [], "r", "t")
    assert got.passed.count() == 5 and got.quarantined.count() == 0 and "_dq_record_id" in got.quarantined.columns


def test_record_id_does_not_depend_on_the_run_or_on_derived_columns(spark):
    def ids(run, day):
        df = spark.createDataFrame([(-1, "x", "f")], SCHEMA).withColumns({"valid_from": F.lit(day), "_raw": F.struct("id", "label")})
        return [(r._dq_record_id, r.record_json) for r in apply_checks(df, [POSITIVE], run, "t", raw="_raw").quarantined.collect()]

    assert ids("a", "2024-01-01") == ids("b", "2024-01-02")


def test_empty_table(spark):
    got = apply_checks(spark.createDataFrame([], SCHEMA), [POSITIVE], "r", "t")
    assert got.metrics["dq.rows_in"] == 0 and got.passed.count() == 0


def test_registry():
    assert [len(quality.CHECKS[t]) for t in ("filing", "company", "financial_fact")] == [6, 3, 11]
    names = [c.name for checks in quality.CHECKS.values() for c in checks]
    assert len(names) == len(set(names))
    with pytest.raises(ValueError):
        Check("x", "true", "maybe")


def test_references(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "z")], "n int, k string")
    others = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3)], "key string, n int")
    check = quality.Reference("known", {"k": "key"})
    got = quality.apply_reference(rows, check, others, "run", "t")
    # A repeated key of the other table repeats no row; NULL names nothing.
    assert sorted(r.n for r in got.passed.collect()) == [1, 2, 2] and got.quarantined.count() == 2
    assert (got.metrics["dq.known.failed"], got.metrics["dq.rows_passed"], got.metrics["dq.rows_quarantined"]) == (2, 3, 2)
    again = quality.apply_reference(rows, check, others, "another", "t").quarantined
    assert {r._dq_record_id for r in again.collect()} == {r._dq_record_id for r in got.quarantined.collect()}
    warned = quality.apply_reference(rows, quality.Reference("known", {"k": "key"}, quality.WARN), others, "run", "t")
    assert warned.has_warnings and warned.passed.count() == 5 and warned.quarantined.count() == 0
    with pytest.raises(quality.BatchRejected) as e:
        quality.apply_reference(rows, quality.Reference("known", {"k": "key", "n": "n"}, quality.REJECT_BATCH), others, "run", "t")
    assert e.value.failed == 2 and len(e.value.samples) == 2
    none = quality.apply_reference(rows.limit(0), check, others, "run", "t")
    assert none.passed.count() == none.quarantined.count() == 0
    with pytest.raises(ValueError):
        quality.Reference("x", {})


def test_reference_quarantine_can_be_staged_once(spark, tmp_path):
    """counts and quarantine come from the staged rows, and the two tables meet no more for them."""
    rows, others = spark.sql("SELECT id k, id % 3 n FROM range(20) UNION ALL SELECT null, 1"), spark.range(5, 12).withColumnRenamed("id", "key")
    check, folder = quality.Reference("known", {"k": "key"}), str(tmp_path / "staged")
    got, plain = (quality.apply_reference(rows, check, others, "run", "t", staged=s) for s in (folder, None))
    assert "Join" not in inspect.physical(got.quarantined) and "Join" in inspect.physical(plain.quarantined)
    ids = lambda c: sorted(r["_dq_record_id"] for r in c.quarantined.collect())
    assert ids(got) == ids(plain) and len(ids(got)) == 14 and got.metrics == plain.metrics and got.passed.count() == 7
