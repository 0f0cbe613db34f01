"""Loading a part again: whole partitions are replaced, so a repeated or corrected load gives every row once.

* :func:`replace_partitions` replaces the named partitions of a table (a month, say) by dynamic partition overwrite and leaves
  the others alone.  It can be repeated: the second time it writes the same partitions again.
* :func:`replacing_months` is the same inside ``foreachBatch``: a micro-batch holds whole months, which replace the ones of before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerlens.sources.files import DEFAULT_FORMAT, Files


def _folders(spark: SparkSession, path: str, by: str, values: Sequence[str], fmt: str) -> list[str]:
    """Folders of the partitions ``values`` of a table partitioned by ``by`` first."""
    if not Files(spark, path).exists(path):
        return []
    found = spark.read.format(fmt).schema(f"`{by}` string").load(path).where(F.col(by).isin(list(values)))
    files = found.select(F.col("_metadata.file_path").alias("file")).distinct()
    # one row per folder of the values asked for
    top = files.select(F.regexp_extract("file", f"^(.*/{by}=[^/]*)/", 1).alias("folder")).distinct()
    return [unquote(r.folder) for r in top.collect()]


def replace_partitions(
    df: DataFrame, path: str, by: str, values: Sequence[str], fmt: str = DEFAULT_FORMAT, then_by: Sequence[str] = ()
) -> int:
    """Replace the partitions ``values`` of the text column ``by`` of the table at ``path`` by the rows of ``df``; returns the rows written.

    A partition of which ``df`` has no row is emptied.  A row of any other partition stops the load before a file is changed.
    ``df`` may read the table itself: files are exchanged when all tasks are done.
    """
    spark = df.sparkSession
    other = F.raise_error(F.concat(F.lit(f"{by} of no partition that is replaced: "), F.coalesce(by, F.lit("null"))))
    checked = df.withColumn(by, F.when(F.col(by).isin(list(values)), F.col(by)).otherwise(other))
    # counted behind the exchange, in the tasks that write; at most one entry per value
    seen = Observation(f"reload_{uuid.uuid4().hex[:8]}")
    dealt = checked.hint("rebalance", by).observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(by).alias("values"))
    dealt.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, *then_by).save(path)
    gone = sorted(set(values) - set(seen.get["values"]))
    files = Files(spark, path)
    for folder in _folders(spark, path, by, gone, fmt) if gone else []:
        files.delete(folder)
    spark.catalog.refreshByPath(path)
    return int(seen.get["rows"])


def replacing_months(path: str, by: str, fmt: str = DEFAULT_FORMAT) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: every value of ``by`` in a micro-batch replaces its partition at ``path``.

    A batch that is taken again after a failure replaces the same partitions by the same rows.
    """

    def take(batch: DataFrame, number: int) -> None:
        values = [r[by] for r in batch.select(by).distinct().collect()]  # partitions of one batch
        if values:
            replace_partitions(batch, path, by, values, fmt)

    return take
