"""Data-quality gate: named checks, blocking or reported only.

A check is ``(label, condition, critical)``; a row violates it when the
condition is false.  By default a null condition is *not* a violation
(``NOT NULL`` is null and a filter drops it) — a null measure passes a
``>= 0`` check.  Such rows are counted separately as ``unknown_count``;
``nulls="fail"`` turns them into violations.

All checks of a table run in **one** aggregation pass (one ``count_if``
per check plus the row count), instead of one filter-count job per check.
The report has one row per check; :func:`enforce` reads that small report
(bounded by the number of checks, never by the data) and raises
``ValueError`` naming every failed critical check, after all checks ran.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    label: str
    condition: Column
    critical: bool = True


def not_null(col: str) -> Column:
    return F.col(col).isNotNull()


def at_least(col: str, bound: float) -> Column:
    return F.col(col) >= F.lit(bound)


def equals(col: str, value) -> Column:
    return F.col(col) == F.lit(value)


def text_length(col: str, n: int) -> Column:
    return F.length(F.col(col)) == F.lit(n)


def matches(col: str, pattern: str) -> Column:
    return F.col(col).rlike(pattern)


def run_checks(df: DataFrame, checks: Sequence[Check], table_name: str, nulls: str = "pass") -> DataFrame:
    """Evaluate every check in one pass; one output row per check.

    Columns: ``table_name``, ``check_name``, ``critical``, ``row_count``,
    ``violations``, ``unknown_count``, ``status`` (``PASS``/``FAIL``).
    """
    aggs = check_metrics(checks, nulls)
    rows = F.array(
        *[
            F.struct(
                F.lit(chk.label).alias("check_name"),
                F.lit(chk.critical).alias("critical"),
                F.col(f"_v{i}").alias("violations"),
                F.col(f"_u{i}").alias("unknown_count"),
            )
            for i, chk in enumerate(checks)
        ]
    )
    return (
        df.agg(*aggs)
        .select(F.col("_rows").alias("row_count"), F.inline(rows))
        .select(
            F.lit(table_name).alias("table_name"),
            "check_name",
            "critical",
            "row_count",
            "violations",
            "unknown_count",
            F.when(F.col("violations") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        )
    )


def check_metrics(checks: Sequence[Check], nulls: str = "pass") -> list[Column]:
    """The aggregates behind :func:`run_checks`, for an ``Observation``.

    Attached to a write with ``df.observe(obs, *check_metrics(checks))``
    they count violations in the same pass that writes the table.
    """
    if nulls not in ("pass", "fail"):
        raise ValueError("nulls must be 'pass' or 'fail'")
    cols = [F.count(F.lit(1)).alias("_rows")]
    for i, chk in enumerate(checks):
        bad = ~chk.condition if nulls == "pass" else ~F.coalesce(chk.condition, F.lit(False))
        cols.append(F.count_if(bad).alias(f"_v{i}"))
        cols.append(F.count_if(chk.condition.isNull()).alias(f"_u{i}"))
    return cols


def report_from_metrics(metrics: dict, checks: Sequence[Check], table_name: str) -> list[dict]:
    """Rows shaped like :func:`run_checks` output, from observed metrics."""
    return [
        {
            "table_name": table_name,
            "check_name": chk.label,
            "critical": chk.critical,
            "row_count": int(metrics["_rows"]),
            "violations": int(metrics[f"_v{i}"]),
            "unknown_count": int(metrics[f"_u{i}"]),
            "status": "PASS" if int(metrics[f"_v{i}"]) == 0 else "FAIL",
        }
        for i, chk in enumerate(checks)
    ]


def enforce(report: DataFrame | list[dict], echo: bool = True) -> list[dict]:
    """Print PASS/FAIL per check; raise ``ValueError`` if a critical one failed.

    ``report`` is a :func:`run_checks` DataFrame (one row per check) or the
    same rows as dicts (:func:`report_from_metrics`).
    """
    rows = report if isinstance(report, list) else [r.asDict() for r in report.collect()]
    failures: dict[str, list[str]] = {}
    for r in rows:
        if echo:
            print(f"{r['table_name']:28s} {r['check_name']:34s} {r['status']:4s} of {r['row_count']} rows: {r['violations']} violate, {r['unknown_count']} unknown")
        if r["violations"] > 0 and r["critical"]:
            failures.setdefault(r["table_name"], []).append(r["check_name"])
    if failures:
        detail = "; ".join(f"{t}: {names}" for t, names in failures.items())
        raise ValueError(f"the quality gate stopped the run ({detail})")
    return rows


# --- fixed values: the check labels, conditions and criticality per table ---
def checks_program_a(snapshot_year: int = 2022) -> list[Check]:
    return [
        Check("provider_npi not null", not_null("provider_npi"), True),
        Check("hcpcs_code not null", not_null("hcpcs_code"), True),
        Check("total_services >= 0", at_least("total_services", 0), True),
        Check("avg_medicare_payment_amt >= 0", at_least("avg_medicare_payment_amt", 0), True),
        Check("avg_submitted_charge >= 0", at_least("avg_submitted_charge", 0), True),
        Check(f"snapshot_year = {snapshot_year}", equals("snapshot_year", snapshot_year), True),
        Check("provider_npi is 10 digits", text_length("provider_npi", 10), True),
    ]


MONTH_PATTERN = r"^\d{4}-\d{2}$"


def checks_program_b(snapshot_year: int = 2022) -> list[Check]:
    return [
        Check("provider_npi not null", not_null("provider_npi"), True),
        Check("hcpcs_code not null", not_null("hcpcs_code"), True),
        Check("total_paid >= 0", at_least("total_paid", 0), False),  # reversals are legitimate
        Check("total_patients >= 0", at_least("total_patients", 0), True),
        Check(f"claim_year = {snapshot_year}", equals("claim_year", snapshot_year), True),
        Check("claim_month format valid", matches("claim_month", MONTH_PATTERN), False),
    ]


def checks_overlap(snapshot_year: int = 2022) -> list[Check]:
    return [
        Check("provider_npi not null", not_null("provider_npi"), True),
        Check("hcpcs_code not null", not_null("hcpcs_code"), True),
        Check("medicare_total_services >= 0", at_least("medicare_total_services", 0), True),
        Check("medicaid_total_paid >= 0", at_least("medicaid_total_paid", 0), False),  # reversals
        Check("medicare_avg_payment_amt >= 0", at_least("medicare_avg_payment_amt", 0), True),
        Check(f"snapshot_year = {snapshot_year}", equals("snapshot_year", snapshot_year), True),
    ]


def quality_report_a(medicare: DataFrame, snapshot_year: int = 2022, nulls: str = "pass") -> DataFrame:
    return run_checks(medicare, checks_program_a(snapshot_year), "silver/medicare", nulls)


def quality_report_b(medicaid: DataFrame, snapshot_year: int = 2022, nulls: str = "pass") -> DataFrame:
    return run_checks(medicaid, checks_program_b(snapshot_year), "silver/medicaid", nulls)


def quality_report_overlap(overlap: DataFrame, snapshot_year: int = 2022, nulls: str = "pass") -> DataFrame:
    return run_checks(overlap, checks_overlap(snapshot_year), "silver/provider_overlap", nulls)
