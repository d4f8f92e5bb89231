"""Quality gate and the fault fixture."""

import pytest
from pyspark.sql import functions as F

from tripstats.operators.quality import QualityGateError, enforce_gate, gate_report, quarantine
from tripstats.plans import trip_carrier as T

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    return T.carrier_silver(spark, SF_SMALL)


def _report(df):
    return {r["check_name"]: (r["observed"], r["passed"]) for r in gate_report(df).collect()}


def test_clean_silver_passes(silver):
    rep = _report(silver)
    assert all(ok for _, ok in rep.values())
    assert enforce_gate(gate_report(silver)) == silver.count()


def test_empty_table_fails_first_check(spark, silver):
    with pytest.raises(QualityGateError, match="row_count_positive"):
        enforce_gate(gate_report(silver.limit(0)))


@pytest.mark.parametrize(
    "i,check",
    [(0, "passenger_count_positive"), (1, "pu_location_not_null"), (2, "passenger_count_positive")],
)
def test_each_fault_row_fails_its_check(spark, silver, i, check):
    one = T.fault_rows(spark).limit(3).collect()[i]
    bad = T.with_faults(silver, spark.createDataFrame([one], T.fault_rows(spark).schema))
    with pytest.raises(QualityGateError, match=check):
        enforce_gate(gate_report(bad))


def test_all_faults_report_pu_first(spark, silver):
    bad = T.with_faults(silver, T.fault_rows(spark))
    with pytest.raises(QualityGateError, match="pu_location_not_null"):
        enforce_gate(gate_report(bad))
    rep = _report(bad)
    assert rep["passenger_count_positive"] == (2, False)
    assert rep["pu_location_not_null"] == (1, False)


def test_null_passenger_is_not_a_violation(spark, silver):
    extra = silver.limit(1).withColumn("passenger_count", F.lit(None).cast("double"))
    assert _report(silver.unionByName(extra))["passenger_count_positive"] == (0, True)


def test_write_quarantine_is_one_write(spark, silver, tmp_dir):
    from tripstats.plans.pipeline import write_quarantine

    bad = T.with_faults(silver, T.fault_rows(spark))
    clean, rejects = write_quarantine(bad, tmp_dir + "/split")
    want_clean, want_rejects = quarantine(bad)
    assert clean.columns == want_clean.columns and rejects.columns == want_rejects.columns
    assert clean.exceptAll(want_clean).isEmpty() and clean.count() == want_clean.count()
    assert rejects.exceptAll(want_rejects).isEmpty() and rejects.count() == 3


def test_quarantine_split(spark, silver):
    bad = T.with_faults(silver, T.fault_rows(spark))
    clean, rejects = quarantine(bad)
    assert clean.count() == silver.count()
    reasons = sorted(r["reject_reason"] for r in rejects.collect())
    assert reasons == ["passenger_count_not_positive", "passenger_count_not_positive", "pu_location_null"]
