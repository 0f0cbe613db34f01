"""Heavy keys found by measuring, and joins that spread only those.

One pass with a frequent-items sketch (``approx_top_k``: bounded memory, merged from the tasks' sketches) names the keys that hold more
than a share of the rows; there are at most 1 / share of them.  :func:`spread_join` deals the rows of a heavy key over as many
sub-keys as its share asks for and copies the small side's row for that key alone; all other keys are joined as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this share of the rows on.
SHARE = 0.005
#: ... and of so many rows: fewer are no load for any task.
LEAST = 1000
#: Entries that the sketch tracks; an estimate is off by less than the rows over a third of these.
TRACKED = 10_000
#: Sub-keys per task's worth of rows: many small parts level out better than few large ones.
SPREAD = 8
KEY_HASH = "__key_hash"
PART = "__part"


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = SHARE, tracked: int = TRACKED, least: int = LEAST
) -> dict[int, float]:
    """Hash of each key that holds at least ``share`` of the rows, and ``least`` of them, with the share it holds (by the sketch's estimate).

    Rows with a null in a key are not counted: they join with nothing.
    """
    if not 3 / tracked <= share <= 1:
        raise ValueError(f"a share of {share} needs a sketch of {math.ceil(3 / share)} entries at least")
    rows = df.select(F.xxhash64(*keys).alias(KEY_HASH), *keys).dropna(subset=list(keys)).select(KEY_HASH)
    most = math.ceil(1 / share)
    top = rows.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({KEY_HASH}, {most}, {tracked})").alias("top")).first()
    return {t["item"]: t["count"] / top["rows"] for t in top["top"] or () if t["count"] >= max(least, share * top["rows"])}


def spread_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: dict[int, float] | None = None,
    spread_from: Sequence[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """``large.join(small, keys, how)`` with the rows of heavy keys spread over several join tasks.

    ``how`` is ``inner`` or ``left``; ``small`` has at most one row per key.  ``hot``: the heavy keys (default: measured by
    :func:`hot_keys`).  A heavy key is dealt, by a hash of ``spread_from`` (default: all columns of ``large``), into ``SPREAD`` parts for every
    task's worth of rows that it holds of ``tasks`` (default: the shuffle partitions).
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join supports 'inner' and 'left'")
    hot = hot_keys(large, keys) if hot is None else hot
    if not hot:
        return large.join(small, list(keys), how)
    spark = large.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = spark.createDataFrame(
        [(h, max(2, math.ceil(share * tasks * SPREAD))) for h, share in hot.items()], f"{KEY_HASH} bigint, __parts int"
    )  # at most 1 / share rows
    one = F.coalesce("__parts", F.lit(1))
    tagged = lambda df: df.withColumn(KEY_HASH, F.xxhash64(*keys)).join(F.broadcast(parts), KEY_HASH, "left").drop(KEY_HASH)
    dealt = tagged(large).withColumn(PART, F.pmod(F.xxhash64(*(spread_from or large.columns)), one)).drop("__parts")
    copied = tagged(small).withColumn(PART, F.explode(F.sequence(F.lit(0).cast("bigint"), (one - 1).cast("bigint")))).drop("__parts")
    return dealt.join(copied, [*keys, PART], how).drop(PART)
