"""Session settings that matter at scale.

The library never builds a session on its own; callers pass one in.
``build_session`` is for tests, the bench and local runs.  On a cluster
the same keys belong in the job's configuration.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run should carry.  AQE re-plans at stage boundaries:
# it turns a sort-merge join into a broadcast join only when the
# *measured* size of a finished shuffle stage is under the threshold
# (the size check behind every broadcast in this package), splits
# skewed join partitions, and coalesces small shuffle partitions.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast is decided on file-size estimates, which undercount
    # decompressed rows: keep it for genuinely tiny files only.  Everything
    # else is broadcast only when AQE has *measured* a finished shuffle
    # stage under the adaptive threshold; otherwise it stays a sort-merge
    # join (with skew splitting).
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python call-site capture for DataFrame error messages costs a stack
    # inspection on every Column/DataFrame call (about half of the driver
    # time spent building a plan); errors still carry the SQL context.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def sized_settings(
    largest_shuffle_bytes: int,
    total_cores: int,
    partition_bytes: int = 128 * 1024 * 1024,
) -> dict[str, str]:
    """Partition sizing for a run whose biggest shuffle moves ``largest_shuffle_bytes``.

    Shuffle partitions start at ~``partition_bytes`` each (so a reducer's
    share fits in execution memory and spills little) and never below two
    waves of cores; AQE then coalesces the small stages down.  Scan splits
    use the same size.  A partition over 4x the target (and 5x the median)
    counts as skewed and is split by AQE in joins.  Example: 100 TB of
    input whose largest shuffle carries ~8 TB after pruning and partial
    aggregation, on 8,000 cores -> 65,536 initial shuffle partitions.
    """
    n = max(2 * total_cores, math.ceil(largest_shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "peerlens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session.  Sets ``spark.checkpoint.dir`` only if unset."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PEERLENS_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    # Catalog folders (schemas created for registered tables) go to a temp
    # folder, not the caller's working directory, unless configured.
    warehouse = os.environ.get("PEERLENS_WAREHOUSE") or os.path.join(tempfile.gettempdir(), "peerlens-warehouse")
    builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def session_for_job(app_name: str = "peerlens") -> SparkSession:
    """The session for a job: the launcher's cluster session if there is one.

    Under ``spark-submit`` (or with a session already active) the master, memory,
    warehouse and checkpoint folders come from the cluster's configuration;
    only the runtime SQL settings of :data:`SCALE_CONF` are applied, and
    only where the job did not set them.  Without a launcher it falls back
    to :func:`build_session` (local).
    """
    launched = "PYSPARK_GATEWAY_PORT" in os.environ  # started by spark-submit / a notebook JVM
    if SparkSession.getActiveSession() is None and not launched:
        return build_session(app_name=app_name)
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    configured = spark.sparkContext.getConf()
    for key, value in SCALE_CONF.items():
        if not configured.contains(key) and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when nothing is configured in a local session (tests)
    a scratch folder is created and registered.  On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="peerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
