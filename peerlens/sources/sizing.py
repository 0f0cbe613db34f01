"""How many tasks a step is dealt to, by the rows it takes.

The session's shuffle partitions may be a fixed number, and then every task of a shuffle grows with the input.
The steps that carry whole rows name their own number where the session's is too small for their rows: then a task's memory does not grow, only the number of tasks.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from peerlens.session import checkpoint_dir

#: Lines of a task of the joins and rollups over ``lineitem`` (narrow rows).
LINES_PER_TASK = 500_000
#: Feed rows of a task that puts pages together (21 texts each).
FEED_ROWS_PER_TASK = 100_000


def parts_for(spark: SparkSession, rows: int, each: int) -> int | None:
    """Tasks for ``rows`` at ``each`` rows; None where the session's shuffle partitions are enough."""
    parts = math.ceil(rows / each)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` tasks; as it is where ``parts`` is None (the plan's own exchanges do)."""
    return df.repartition(parts, *keys) if parts else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one step's rows, where driver and executors both see it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/peerlens-{name}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what reads it several times computes it once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
