"""Gold marts: provider spending, specialty utilisation, peer outliers.

Shape of the plans at scale:

* every mart aggregates *before* it joins, so each join is 1:1 (or n:1
  against a benchmark) on its keys and moves pre-reduced rows only;
* the peer benchmark is one row per specialty x code.  It is joined back
  with an ordinary left join; AQE broadcasts it when its measured size is
  under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a
  sort-merge join otherwise (``salt_buckets`` then spreads a hot peer
  group deterministically over several tasks).  A
  window ``avg() over (partition by specialty, code)`` would put a whole
  peer group in one task and would also give null specialties a benchmark,
  which the join does not;
* the 95th percentile uses ``percentile_approx`` (a mergeable sketch of
  bounded size), never an exact percentile that buffers a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens import schemas as S
from peerlens.functions import flag, flag_count, safe_ratio, stable_round
from peerlens.operators.hot_keys import spread_join
from peerlens.operators.joins import salted_join
from peerlens.operators.quantile import exact_group_quantile
from peerlens.operators.rollup import Rollup

PEER_KEYS = ["provider_specialty", "hcpcs_code"]

# --- fixed values: default thresholds of the risk flags ---------------------
DEFAULT_QUANTILE = 0.95
DEFAULT_CHARGE_FACTOR = 2
DEFAULT_SPEND_THRESHOLD = 50000
DEFAULT_PERCENTILE_ACCURACY = 10000


PROVIDER_A = Rollup(
    keys={"provider_npi": "provider_npi"},
    carried=("provider_specialty", "provider_state"),
    sums={"medicare_total_services": "total_services", "medicare_total_beneficiaries": "total_beneficiaries"},
    means={"medicare_avg_payment_amt": "avg_medicare_payment_amt", "medicare_avg_submitted_charge": "avg_submitted_charge"},
    distinct={"medicare_distinct_hcpcs_count": "hcpcs_code"},
)
PROVIDER_B = Rollup(
    keys={"_b_npi": "provider_npi"},
    sums={f"medicaid_{m}": m for m in ("total_paid", "total_patients", "total_claim_lines")},
    distinct={"medicaid_distinct_hcpcs_count": "hcpcs_code", "medicaid_months_active": "claim_month"},
)
UTILIZATION = Rollup(
    keys={k: k for k in ("provider_specialty", "hcpcs_code", "hcpcs_description")},
    sums={"total_beneficiaries": "total_beneficiaries", "total_services": "total_services"},
    means={"avg_medicare_payment_amt": "avg_medicare_payment_amt", "avg_submitted_charge": "avg_submitted_charge"},
    distinct={"provider_count": "provider_npi"},
    required=("provider_specialty", "hcpcs_code"),
    order=("provider_specialty", "hcpcs_code", "hcpcs_description", "provider_count", "total_beneficiaries", "total_services",
           "avg_medicare_payment_amt", "avg_submitted_charge"),
)


def provider_spending(
    medicare: DataFrame, medicaid: DataFrame | None, snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR, b_totals: DataFrame | None = None
) -> DataFrame:
    """One row per program A provider, program B totals attached when present.

    ``b_totals``: program B per provider where it is kept up to date already
    (:meth:`~peerlens.operators.incremental.MonthlyTotals.provider_rollup`); ``medicaid`` is not read then.

    ``medicare_avg_*`` are unweighted averages over the provider's rows
    (an average of averages).  ``bills_both_programs`` is true exactly when
    the left join found the provider in program B.
    """
    a = PROVIDER_A.over(medicare)
    b = PROVIDER_B.over(medicaid) if b_totals is None else b_totals.withColumnRenamed("provider_npi", "_b_npi")
    joined = a.join(b, a.provider_npi == b._b_npi, "left")
    return joined.select(
        "provider_npi",
        "provider_specialty",
        "provider_state",
        "medicare_total_services",
        "medicare_total_beneficiaries",
        "medicare_avg_payment_amt",
        "medicare_avg_submitted_charge",
        "medicare_distinct_hcpcs_count",
        "medicaid_total_paid",
        "medicaid_total_patients",
        "medicaid_total_claim_lines",
        "medicaid_distinct_hcpcs_count",
        "medicaid_months_active",
        F.col("_b_npi").isNotNull().alias("bills_both_programs"),
        F.lit(snapshot_year).alias("snapshot_year"),
    )


def specialty_utilization(medicare: DataFrame, snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR) -> DataFrame:
    """Specialty x code x description: providers, volume, average charge/payment and their gap."""
    gap = F.col("avg_submitted_charge") - F.col("avg_medicare_payment_amt")
    return UTILIZATION.over(medicare).withColumns({"avg_charge_to_payment_gap": gap, "snapshot_year": F.lit(snapshot_year)})


def peer_benchmarks(
    overlap: DataFrame,
    quantile: float = DEFAULT_QUANTILE,
    accuracy: int = DEFAULT_PERCENTILE_ACCURACY,
    exact: bool = False,
) -> DataFrame:
    """Per peer group (specialty x code): mean/stddev of charge, mean and p95 of services.

    The stddev is the sample one (null for a one-row group).  The p95 is
    ``percentile_approx`` at the given accuracy: exact for groups below
    ``accuracy`` rows, within ``1/accuracy`` in rank above.  A null
    specialty forms its own group here but never matches in the join.
    ``exact=True`` makes the p95 exact for groups of any size
    (:func:`~peerlens.operators.quantile.exact_group_quantile`; reads ``overlap`` twice, so give a written one).
    """
    if exact:
        means = peer_benchmarks(overlap, quantile, accuracy).drop("specialty_p95_services")
        p95 = exact_group_quantile(overlap, PEER_KEYS, "medicare_total_services", quantile, accuracy)
        p95 = p95.select(*(F.col(k).alias(f"_{k}") for k in PEER_KEYS), F.col("quantile").alias("specialty_p95_services"))
        return means.join(p95, [means[k].eqNullSafe(F.col(f"_{k}")) for k in PEER_KEYS]).drop(*(f"_{k}" for k in PEER_KEYS))
    return overlap.groupBy(*PEER_KEYS).agg(
        F.avg("medicare_avg_submitted_charge").alias("specialty_avg_submitted_charge"),
        F.stddev_samp("medicare_avg_submitted_charge").alias("specialty_stddev_submitted_charge"),
        F.avg("medicare_total_services").alias("specialty_avg_services"),
        F.percentile_approx("medicare_total_services", quantile, accuracy).alias("specialty_p95_services"),
    )


def risk_indicators(
    overlap: DataFrame,
    benchmarks: DataFrame | None = None,
    charge_factor: float = DEFAULT_CHARGE_FACTOR,
    spend_threshold: float = DEFAULT_SPEND_THRESHOLD,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
    quantile: float = DEFAULT_QUANTILE,
    salt_buckets: int = 1,
    hot: dict[int, float] | None = None,
) -> DataFrame:
    """Overlap rows scored against their peer group: three flags and a 0-3 score.

    * ``high_volume_flag``: services > peer p95;
    * ``high_charge_flag``: charge > ``charge_factor`` x peer mean charge;
    * ``high_medicaid_spend_flag``: program B paid > ``spend_threshold``.

    A comparison with a null side is false (rows without a benchmark keep
    only the spend flag).  ``charge_ratio_vs_specialty`` is null when the
    peer mean is 0 or missing.

    ``salt_buckets > 1`` spreads each peer group over that many join tasks
    (:func:`~peerlens.operators.joins.salted_join`).  With the default 1 the
    benchmark is broadcast whenever AQE measures it small (one row per peer
    group), and then no join task holds a whole group; when it is too big to
    broadcast, AQE's skew split is not guaranteed for this left join, so a
    hot peer group should be salted.  ``hot`` (:func:`~peerlens.operators.hot_keys.hot_keys`) spreads the peer
    groups that were measured to be heavy, and those alone, in place of ``salt_buckets``.
    """
    bench = benchmarks if benchmarks is not None else peer_benchmarks(overlap, quantile)
    bench = bench.select(*PEER_KEYS, "specialty_avg_submitted_charge", "specialty_avg_services", "specialty_p95_services")
    o = overlap.select(
        "provider_npi",
        "hcpcs_code",
        "hcpcs_description",
        "provider_specialty",
        "provider_state",
        "medicare_total_services",
        "medicare_avg_submitted_charge",
        "medicare_avg_payment_amt",
        "medicaid_total_paid",
        "medicaid_total_patients",
        "medicaid_months_billed",
    )
    if hot is not None:
        j = spread_join(o, bench, PEER_KEYS, "left", hot, spread_from=["provider_npi", "hcpcs_code"])
    else:
        j = salted_join(o, bench, PEER_KEYS, "left", salt_buckets, salt_from=["provider_npi", "hcpcs_code"])
    volume = flag(F.col("medicare_total_services") > F.col("specialty_p95_services"))
    charge = flag(F.col("medicare_avg_submitted_charge") > F.lit(charge_factor) * F.col("specialty_avg_submitted_charge"))
    spend = flag(F.col("medicaid_total_paid") > F.lit(spend_threshold))
    return j.select(
        "provider_npi",
        "hcpcs_code",
        "hcpcs_description",
        "provider_specialty",
        "provider_state",
        "medicare_total_services",
        "medicare_avg_submitted_charge",
        "medicare_avg_payment_amt",
        "medicaid_total_paid",
        "medicaid_total_patients",
        "medicaid_months_billed",
        "specialty_avg_submitted_charge",
        "specialty_avg_services",
        "specialty_p95_services",
        stable_round(
            safe_ratio("medicare_avg_submitted_charge", "specialty_avg_submitted_charge"), 2
        ).alias("charge_ratio_vs_specialty"),
        volume.alias("high_volume_flag"),
        charge.alias("high_charge_flag"),
        spend.alias("high_medicaid_spend_flag"),
        flag_count(volume, charge, spend).alias("risk_score"),
        F.lit(snapshot_year).alias("snapshot_year"),
    )
