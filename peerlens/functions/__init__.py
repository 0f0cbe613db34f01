"""Column-level helpers (all built-in Spark expressions, codegen-friendly)."""

from peerlens.functions.columns import (
    flag,
    flag_count,
    in_text_range,
    representative,
    safe_ratio,
    stable_round,
    year_of_month,
)

__all__ = [
    "flag",
    "flag_count",
    "in_text_range",
    "representative",
    "safe_ratio",
    "stable_round",
    "year_of_month",
]
