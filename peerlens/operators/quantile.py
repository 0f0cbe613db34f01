"""Exact quantiles per group by distributed selection; no group is ever gathered.

Groups of fewer rows than the accuracy of ``percentile_approx`` are exact in one aggregation.  For larger ones the value of the wanted rank is
closed in on, in rounds over all large groups together:

1. a bounded, mergeable sketch gives each group some cut points (its smallest and largest value among them);
2. rows are counted per group and bin, where every cut point is a bin of its own and so is each stretch between two
   (partially aggregated counts; the cut points reach the rows by a salted join, so a hot group is many tasks);
3. the running count names the bin that holds the rank.  A cut point is the answer; of a stretch between two cut points only
   its rows go on to the next round, with the rank less the rows before them.

How good the sketch is decides only how fast the rows get fewer (about ``CUTS``-fold a round), never the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.operators.joins import salted_join
from peerlens.session import checkpoint_dir

CUTS = 32
GROUP = "_group"


def _written(df: DataFrame, what: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/peerlens-{what}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_group_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantile: float = 0.95,
    accuracy: int = 10_000,
    buckets: int = 16,
) -> DataFrame:
    """``keys``, ``rows`` and ``quantile``: per group the non-null rows and the value at rank ceil(quantile x rows), exactly.

    That is the smallest value that at least this share of the group's values does not exceed (``quantile_disc``).  A group without a value has
    the quantile null; null keys form a group.  NaN counts as the largest value.  ``accuracy``: groups of fewer rows are
    done in one aggregation.  ``buckets``: tasks that each large group is spread over.
    """
    if not 0 < quantile <= 1:
        raise ValueError(f"the quantile must be above 0 and at most 1, not {quantile}")
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias(GROUP)
    rows = df.select(group, *keys, F.col(value).alias("_value"))
    n = F.count("_value")
    guess = F.percentile_approx("_value", quantile, accuracy)
    # one row more than the rank needs would already be within the sketch's error, so half the accuracy is the limit
    groups = _written(rows.groupBy(GROUP, *keys).agg(n.alias("rows"), guess.alias("_guess")), "group-sizes")
    large = groups.where(F.col("rows") >= accuracy // 2)
    rank = F.ceil(F.lit(Decimal(str(quantile))) * F.col("rows").cast("decimal(20,0)")).cast("bigint")
    ranks = _written(large.select(GROUP, rank.alias("_rank")), "group-ranks")
    left, found, rounds = None, [], 0
    while not ranks.isEmpty():
        if left is None:
            valued = rows.where("_value IS NOT NULL").select(GROUP, "_value")
            left = _written(salted_join(valued, ranks.select(GROUP), [GROUP], "inner", buckets), "group-values")
        rounds += 1
        if rounds > 64:
            raise RuntimeError("the selection did not end")
        shares = [i / CUTS for i in range(CUTS + 1)]
        cuts = left.groupBy(GROUP).agg(F.percentile_approx("_value", shares, 100 * CUTS).alias("_cuts"))
        cuts = cuts.select(GROUP, F.array_sort(F.array_distinct("_cuts")).alias("_cuts"))
        below = F.size(F.filter("_cuts", lambda c: c < F.col("_value")))
        own = F.get("_cuts", below) == F.col("_value")
        placed = salted_join(left, cuts, [GROUP], "inner", buckets).select(
            GROUP, "_value", (2 * below + F.coalesce(own, F.lit(False)).cast("int")).alias("_bin")
        )
        placed = _written(placed, "placed-values")
        counts = placed.groupBy(GROUP, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_least"))
        upto = Window.partitionBy(GROUP).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)  # at most 2 CUTS + 3 bins
        held = counts.withColumn("_upto", F.sum("_n").over(upto)).join(ranks, GROUP)
        held = held.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
        held = _written(held.withColumn("_rank", F.col("_rank") - F.col("_upto") + F.col("_n")), "chosen-bins")
        found.append(held.where("_bin % 2 = 1").select(GROUP, F.col("_least").alias("_exact")))
        open_ = held.where("_bin % 2 = 0").select(GROUP, "_bin", "_rank")
        left = _written(salted_join(placed, open_.select(GROUP, "_bin"), [GROUP, "_bin"], "inner", buckets).drop("_bin"), "group-values")
        ranks = open_.select(GROUP, "_rank")
    out = groups
    if found:
        exact = found[0]
        for f in found[1:]:
            exact = exact.unionByName(f)
        out = groups.join(exact, GROUP, "left").withColumn("_guess", F.coalesce("_exact", "_guess"))
    return out.select(*keys, "rows", F.col("_guess").alias("quantile"))
