"""The five reports as views, for users who query the catalog with SQL.

``register_reports(spark)`` builds the DataFrame reports over the registered gold tables and gives each
a temporary view of its name, so that there is one definition of a report::

    register_reports(spark, gold="gold")
    spark.sql("SELECT * FROM report_state_reimbursement WHERE provider_count > 1000")

A view is a plan, not a copy: it reads the gold tables as they are when it is queried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerlens.plans import reports

#: Report -> (gold table it reads, function).
SOURCES: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "report_highest_risk": ("fraud_risk_indicators", reports.report_highest_risk),
    "report_charge_gap": ("agg_specialty_utilization", reports.report_charge_gap),
    "report_dual_billing": ("agg_provider_spending", reports.report_dual_billing),
    "report_state_reimbursement": ("agg_provider_spending", reports.report_state_reimbursement),
    "report_top_codes": ("fraud_risk_indicators", reports.report_top_codes),
}


def register_reports(spark: SparkSession, gold: str = "gold", prefix: str = "", **settings: dict) -> list[str]:
    """Register every report as a temporary view ``<prefix><report>``; returns the names.

    ``settings`` maps a report to arguments of its function, e.g. ``report_dual_billing={"min_providers": 10}``.
    """
    names = []
    for report, (table, build) in SOURCES.items():
        build(spark.table(f"{gold}.{table}"), **settings.get(report, {})).createOrReplaceTempView(prefix + report)
        names.append(prefix + report)
    return names
