"""Providers seen in both programs for the same code (inner join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens import schemas as S

JOIN_KEYS = ["provider_npi", "hcpcs_code"]


def provider_overlap(
    a_code: DataFrame,
    b_code: DataFrame,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
) -> DataFrame:
    """Inner join of the two provider x code rollups on provider and code.

    Both sides are pre-aggregated, so the join is 1:1 on its keys (1:n when
    program A keeps several descriptions for one code: the program B totals
    then repeat on each description row).  No row of either side is
    duplicated by the join, so a hot provider cannot blow it up; AQE's
    skew-join split still applies to oversized partitions.
    """
    return (
        a_code.join(b_code, on=JOIN_KEYS, how="inner")
        .withColumn(S.TRANSFORMED_AT, F.current_timestamp())
        .withColumn("snapshot_year", F.lit(snapshot_year))
    )
