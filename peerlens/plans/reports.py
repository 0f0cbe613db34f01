"""The five ranked reports over the gold marts.

Each top-k sorts on the report's measure and then on the full group key,
so ties at the cut keep the same rows on every run.  ``orderBy().limit(k)``
plans as TakeOrderedAndProject: every task keeps its own top k and only
those k rows per task meet in the final merge — no full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions import safe_ratio, stable_round

# --- fixed values: default cut-offs of the reports ---------------------------
TOP_RISK_ROWS = 50
TOP_SPECIALTIES = 30
TOP_CODES = 30
MIN_PROVIDERS = 100
MAX_SCORE = 3


def _dual(col: str = "bills_both_programs") -> F.Column:
    return F.when(F.col(col), F.lit(1)).otherwise(F.lit(0))


def report_highest_risk(risk: DataFrame, score: int = MAX_SCORE, limit: int = TOP_RISK_ROWS) -> DataFrame:
    """Rows with the given score, most over-charging first."""
    return (
        risk.filter(F.col("risk_score") == score)
        .select(
            "provider_npi",
            "provider_specialty",
            "provider_state",
            "hcpcs_code",
            "hcpcs_description",
            "medicare_total_services",
            "specialty_p95_services",
            stable_round(safe_ratio("medicare_total_services", "specialty_p95_services"), 2).alias(
                "volume_ratio_vs_p95"
            ),
            "medicare_avg_submitted_charge",
            "specialty_avg_submitted_charge",
            "charge_ratio_vs_specialty",
            "medicaid_total_paid",
            "medicaid_months_billed",
            "risk_score",
        )
        .orderBy(
            F.col("charge_ratio_vs_specialty").desc_nulls_last(),
            "provider_npi",
            "hcpcs_code",
            "hcpcs_description",
        )
        .limit(limit)
    )


def report_charge_gap(
    utilization: DataFrame, limit: int = TOP_SPECIALTIES, medicare: DataFrame | None = None
) -> DataFrame:
    """Charge-to-payment gap per specialty (averages over the utilisation rows).

    ``provider_count`` here is the number of distinct *values* of the
    utilisation mart's provider count, kept as the original report has it.
    Given the silver ``medicare`` table, a ``distinct_provider_count`` column
    (distinct providers per specialty) is added next to it.
    """
    avg_gap = F.avg("avg_charge_to_payment_gap")
    avg_pay = F.avg("avg_medicare_payment_amt")
    report = (
        utilization.filter(F.col("provider_specialty").isNotNull())
        .groupBy("provider_specialty")
        .agg(
            F.count_distinct("hcpcs_code").alias("distinct_hcpcs_count"),
            F.count_distinct("provider_count").alias("provider_count"),
            stable_round(F.avg("avg_submitted_charge"), 2).alias("avg_submitted_charge"),
            stable_round(avg_pay, 2).alias("avg_medicare_payment_amt"),
            stable_round(avg_gap, 2).alias("avg_charge_to_payment_gap"),
            stable_round(safe_ratio(avg_gap, avg_pay) * 100, 1).alias("gap_pct_of_payment"),
        )
        .orderBy(F.col("avg_charge_to_payment_gap").desc_nulls_last(), "provider_specialty")
        .limit(limit)
    )
    if medicare is None:
        return report
    providers = (
        medicare.filter(F.col("provider_specialty").isNotNull() & F.col("hcpcs_code").isNotNull())
        .groupBy("provider_specialty")
        .agg(F.count_distinct("provider_npi").alias("distinct_provider_count"))
    )
    return report.join(providers, "provider_specialty", "left").orderBy(
        F.col("avg_charge_to_payment_gap").desc_nulls_last(), "provider_specialty"
    )


def report_dual_billing(
    spending: DataFrame, min_providers: int = MIN_PROVIDERS, limit: int = TOP_SPECIALTIES
) -> DataFrame:
    """Share of providers billing both programs, and their program B spend, per specialty."""
    total = F.count_distinct("provider_npi")
    dual = F.sum(_dual())
    return (
        spending.filter(F.col("provider_specialty").isNotNull())
        .groupBy("provider_specialty")
        .agg(
            total.alias("total_providers"),
            dual.alias("dual_billing_providers"),
            stable_round(dual / total * 100, 1).alias("dual_billing_pct"),
            stable_round(
                F.sum(F.when(F.col("bills_both_programs"), F.col("medicaid_total_paid")).otherwise(F.lit(0))), 2
            ).alias("total_medicaid_paid"),
            stable_round(F.avg(F.when(F.col("bills_both_programs"), F.col("medicaid_total_paid"))), 2).alias(
                "avg_medicaid_paid_per_dual_biller"
            ),
        )
        .filter(F.col("total_providers") >= min_providers)
        .orderBy(F.col("dual_billing_pct").desc_nulls_last(), "provider_specialty")
        .limit(limit)
    )


def report_state_reimbursement(spending: DataFrame) -> DataFrame:
    """Average payment and charge per state, all states, highest payment first."""
    avg_pay = F.avg("medicare_avg_payment_amt")
    avg_charge = F.avg("medicare_avg_submitted_charge")
    return (
        spending.filter(F.col("provider_state").isNotNull())
        .groupBy("provider_state")
        .agg(
            F.count_distinct("provider_npi").alias("provider_count"),
            stable_round(avg_pay, 2).alias("avg_medicare_payment"),
            stable_round(avg_charge, 2).alias("avg_submitted_charge"),
            stable_round(avg_charge - avg_pay, 2).alias("avg_charge_payment_gap"),
            F.sum("medicare_total_beneficiaries").alias("total_beneficiaries"),
            F.sum(_dual()).alias("dual_billing_providers"),
        )
        .orderBy(F.col("avg_medicare_payment").desc_nulls_last(), "provider_state")
    )


def report_top_codes(risk: DataFrame, score: int = MAX_SCORE, limit: int = TOP_CODES) -> DataFrame:
    """Codes most often seen among rows with the given score."""
    return (
        risk.filter(F.col("risk_score") == score)
        .groupBy("hcpcs_code", "hcpcs_description")
        .agg(
            F.count_distinct("provider_npi").alias("provider_count"),
            F.count_distinct("provider_specialty").alias("specialty_count"),
            stable_round(F.avg("charge_ratio_vs_specialty"), 2).alias("avg_charge_ratio"),
            stable_round(F.avg("medicaid_total_paid"), 2).alias("avg_medicaid_paid"),
            F.sum("medicare_total_services").alias("total_medicare_services"),
        )
        .orderBy(F.col("provider_count").desc(), "hcpcs_code", "hcpcs_description")
        .limit(limit)
    )
