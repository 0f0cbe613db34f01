"""Invariants that follow from the code and the published counts (sf0.01)."""

import pytest
from pyspark.sql import functions as F

from peerlens.plans.layers import Layers
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF_SMALL)


def test_fixture_counts(layers):
    assert layers.raw_a.count() == 25946
    assert layers.medicaid.count() == 4301
    assert layers.overlap.count() == 2371


def test_silver_a_is_bronze_minus_null_keys(layers):
    nulls = layers.raw_a.filter(F.col("Rndrng_NPI").isNull() | F.col("HCPCS_Cd").isNull()).count()
    assert layers.medicare.count() == layers.raw_a.count() - nulls


def test_risk_rows_equal_overlap_rows(layers):
    assert layers.risk.count() == layers.overlap.count()


def test_spending_rows_equal_distinct_a_providers(layers):
    assert layers.spending.count() == layers.medicare.select("provider_npi").distinct().count()


def test_score_is_sum_of_flags(layers):
    bad = layers.risk.filter(
        (F.col("risk_score")
         != F.col("high_volume_flag").cast("int") + F.col("high_charge_flag").cast("int")
         + F.col("high_medicaid_spend_flag").cast("int"))
        | ~F.col("risk_score").between(0, 3)
    ).count()
    assert bad == 0
    dist = {r.risk_score: r["count"] for r in layers.risk.groupBy("risk_score").count().collect()}
    assert dist == {0: 894, 1: 1281, 2: 192, 3: 4}  # FIXTURES.md, sf0.01


def test_b_paid_preserved_by_rollups(layers):
    lo, hi = "1998-01", "1998-12"
    raw = layers.raw_b.filter(F.col("CLAIM_FROM_MONTH").between(lo, hi)).agg(F.sum("TOTAL_PAID")).first()[0]
    monthly = layers.medicaid.agg(F.sum("total_paid")).first()[0]
    code = layers.b_code.agg(F.sum("medicaid_total_paid")).first()[0]
    assert raw == pytest.approx(monthly, rel=1e-12) == pytest.approx(code, rel=1e-12)


def test_charge_gap_true_provider_count(layers):
    from peerlens.plans.reports import report_charge_gap

    rows = report_charge_gap(layers.utilization, medicare=layers.medicare).collect()
    truth = {
        r.provider_specialty: r.n
        for r in layers.medicare.groupBy("provider_specialty").agg(F.count_distinct("provider_npi").alias("n")).collect()
    }
    assert rows and all(r.distinct_provider_count == truth[r.provider_specialty] for r in rows)
