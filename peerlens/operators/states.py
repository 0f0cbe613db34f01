"""Rollups kept as states that can be aggregated again.

An average cannot be averaged and a distinct count cannot be added up.  A *state* can: sums stay sums, a mean is kept as a sum and
a count, a distinct count as a theta sketch (bounded bytes; unions of sketches are sketches of the union).  A table of states
at a fine grain (per month, per code) gives any coarser rollup by merging its rows, without the rows behind them.

Means from merged states weigh every input row alike: they equal the mean over the rows, exactly but for the order of double
sums.  Distinct counts are exact up to ``2 ** lg_k`` different values and beyond that within about ``3 / sqrt(2 ** lg_k)`` of
the true count (three standard errors; 0.6 % for the default).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 18


@dataclass(frozen=True)
class MergeableRollup:
    """What is measured: ``sums``, ``means`` and ``distinct`` map output names to input columns."""

    sums: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    lg_k: int = LG_K

    def error(self) -> float:
        """Three relative standard errors of a distinct count beyond ``2 ** lg_k`` values."""
        return 3 / (2**self.lg_k - 1) ** 0.5

    def states(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """One state per group of ``keys``: ``sum_*``, ``total_*`` and ``n_*`` (means), ``sketch_*``, and the number of ``rows``."""
        aggs = [F.count(F.lit(1)).alias("rows")]
        aggs += [F.sum(c).alias(f"sum_{name}") for name, c in self.sums.items()]
        for name, c in self.means.items():
            aggs += [F.sum(F.col(c).cast("double")).alias(f"total_{name}"), F.count(c).alias(f"n_{name}")]
        # an empty sketch for a group without values, so that every state can be merged
        aggs += [F.theta_sketch_agg(F.col(c), self.lg_k).alias(f"sketch_{name}") for name, c in self.distinct.items()]
        return rows.groupBy(*keys).agg(*aggs)

    def merged(self, states: DataFrame, keys: Sequence[str]) -> DataFrame:
        """States of a coarser grain; merging merged states again gives the same as merging all at once."""
        aggs = [F.sum("rows").alias("rows"), *(F.sum(f"sum_{name}").alias(f"sum_{name}") for name in self.sums)]
        for name in self.means:
            aggs += [F.sum(f"total_{name}").alias(f"total_{name}"), F.sum(f"n_{name}").alias(f"n_{name}")]
        aggs += [F.theta_union_agg(F.col(f"sketch_{name}"), self.lg_k).alias(f"sketch_{name}") for name in self.distinct]
        return states.groupBy(*keys).agg(*aggs)

    def values(self, states: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The measures that states stand for, under their own names."""
        out = [F.col(f"sum_{name}").alias(name) for name in self.sums]
        out += [F.try_divide(F.col(f"total_{name}"), F.col(f"n_{name}")).alias(name) for name in self.means]
        out += [F.theta_sketch_estimate(f"sketch_{name}").alias(name) for name in self.distinct]
        return states.select(*keys, "rows", *out)


#: Program A rows: volume, charges and who billed.
SERVICE_STATES = MergeableRollup(
    sums={"total_beneficiaries": "total_beneficiaries", "total_services": "total_services"},
    means={"avg_submitted_charge": "avg_submitted_charge", "avg_medicare_payment_amt": "avg_medicare_payment_amt"},
    distinct={"provider_count": "provider_npi", "code_count": "hcpcs_code"},
)
#: Program B rows: amounts and who billed.
CLAIM_STATES = MergeableRollup(
    sums={"total_patients": "total_patients", "total_claim_lines": "total_claim_lines", "total_paid": "total_paid"},
    means={"mean_paid": "total_paid"},
    distinct={"provider_count": "provider_npi", "month_count": "claim_month"},
)
