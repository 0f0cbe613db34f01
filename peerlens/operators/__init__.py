"""DataFrame -> DataFrame operators: cleaning, rollups, overlap, quality, marts."""

from peerlens.operators.clean import cast_failures, rename_cast, require_keys
from peerlens.operators.marts import peer_benchmarks, provider_spending, risk_indicators, specialty_utilization
from peerlens.operators.overlap import provider_overlap
from peerlens.operators.quality import Check, enforce, run_checks
from peerlens.operators.rollup import rollup_a_code, rollup_b_code, rollup_b_monthly

__all__ = [
    "Check",
    "cast_failures",
    "enforce",
    "peer_benchmarks",
    "provider_overlap",
    "provider_spending",
    "rename_cast",
    "require_keys",
    "risk_indicators",
    "rollup_a_code",
    "rollup_b_code",
    "rollup_b_monthly",
    "run_checks",
    "specialty_utilization",
]
