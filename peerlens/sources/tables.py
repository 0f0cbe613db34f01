"""Batch sources and sinks: scans, audit columns, overwrite/append, replace by name.

Tables are plain parquet folders (Delta when its jar is on the class
path); ``write_table`` optionally registers the folder in the catalog so
that later steps can read it by name.  Row counts come from an
``Observation`` on the write itself, so counting costs no second scan.

A registered name is a view over one external table per registered folder
(its *version*).  Registering again builds the new version completely,
partitions included, and then replaces the view: one catalog change, so
whoever reads by name finds the old rows or the new ones, never a missing or an
empty table.  :func:`replace_table` also writes every version to a folder of its own.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.sources.compaction import compact_table  # noqa: F401  (a sink operation, kept with the others)
from peerlens.sources.files import DEFAULT_FORMAT


def read_source(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema: T.StructType | None = None
) -> DataFrame:
    """Scan a file source (parquet by default) with an optional declared schema."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_table(
    spark: SparkSession, path_or_name: str, fmt: str = DEFAULT_FORMAT, schema: T.StructType | None = None
) -> DataFrame:
    """Read a table by path, or by catalog name when it has no slash.

    With ``schema`` (e.g. the schema a table was just written with) no job
    is spent reading file footers to infer it.
    """
    if "/" not in path_or_name and ":" not in path_or_name:
        return spark.table(path_or_name)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path_or_name)


def from_records(spark: SparkSession, records: list[dict], schema: T.StructType) -> DataFrame:
    """Rows from in-memory objects (one fetched page, a test case) with a declared schema.

    Fields are matched by name; missing ones are null and unknown ones are
    ignored, so a page whose column is null throughout still gets its type.
    Meant for small batches only: anything large should land as files.
    """
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a ``limit``: no full scan behind it)."""
    return df.limit(n)


def with_audit(df: DataFrame, source_tag: str) -> DataFrame:
    """Add ``_ingested_at`` (ingest time) and ``_source`` (literal tag)."""
    return df.withColumn(S.INGESTED_AT, F.current_timestamp()).withColumn(S.SOURCE_TAG, F.lit(source_tag))


def with_transformed_at(df: DataFrame) -> DataFrame:
    return df.withColumn(S.TRANSFORMED_AT, F.current_timestamp())


#: Versions of a registered name that stay in the catalog: the one it shows, and the one before it for running readers.
KEPT_VERSIONS = 2


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The version tables of a registered name, oldest first."""
    place, _, short = name.rpartition(".")
    shown = spark.sql(f"SHOW TABLES{f' IN {place}' if place else ''}")
    own = re.compile(re.escape(f"{short.lower()}__v") + r"\d{20}_[0-9a-f]{6}")
    found = sorted(r.tableName for r in shown.collect() if own.fullmatch(r.tableName.lower()))
    return [f"{place}.{t}" if place else t for t in found]


def register_table(
    spark: SparkSession,
    path: str,
    name: str,
    schema: T.StructType,
    fmt: str = DEFAULT_FORMAT,
    partition_by: list[str] | None = None,
) -> None:
    """Point the catalog name ``name`` at the written folder ``path`` (columns and types as in ``schema``).

    Values of partition columns get the declared type, not one guessed from the folder names.  The columns may
    differ from those of the folder that the name showed before.  A plain table of that name is given up for the view the first time.
    """
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    by = list(partition_by or [])
    # partition columns stand last, as they do when the folder is read
    fields = [f for f in schema.fields if f.name not in by] + [schema[c] for c in by]
    columns = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]).toDDL()
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    spark.sql(f"CREATE TABLE {version} ({columns}) USING {fmt}{parts} LOCATION '{quoted}'")
    if by and fmt != "delta":
        spark.sql(f"ALTER TABLE {version} RECOVER PARTITIONS")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in _versions(spark, name)[:-KEPT_VERSIONS]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")  # external: its files stay


def replace_table(
    df: DataFrame,
    name: str,
    root: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: list[str] | None = None,
    **kwargs,
) -> int | None:
    """Create or replace the table ``name`` as the rows of ``df``; readers by name never find it missing or empty.

    The rows go to a new folder under ``root``; the name is pointed at it when all of them are there (:func:`register_table`).
    ``df`` may read the table it replaces.  A write that fails leaves the name as it was.  Folders of earlier versions stay, to be
    expired by the folder's retention policy.  Returns the row count.
    """
    path = f"{root.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    return write_table(df, path, name=name, fmt=fmt, partition_by=partition_by, **kwargs)


def write_table(
    df: DataFrame,
    path: str,
    name: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    observe_rows: bool = True,
    observe: Observation | None = None,
    observe_cols: list | None = None,
) -> int | None:
    """Write ``df`` to ``path`` (overwrite by default) and return its row count.

    The count is taken by an ``Observation`` during the write: one pass.
    ``observe``/``observe_cols`` attach further metrics (e.g. quality-check
    counts) to the same pass; read them from ``observe.get`` afterwards.
    With ``name`` the folder is also registered in the catalog
    (:func:`register_table`).  Never point ``path`` at a folder
    that ``df`` itself reads; use :func:`~peerlens.sources.compaction.compact_table` for that.
    """
    spark = df.sparkSession
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}") if observe_rows else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    if observe is not None:
        out = out.observe(observe, *observe_cols)
    writer = out.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true" if mode == "overwrite" else "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    # Tables or DataFrames of this session that read ``path`` drop their
    # cached file listing (an overwrite replaced the files).
    spark.catalog.refreshByPath(path)
    if name:
        register_table(spark, path, name, df.schema, fmt, partition_by)
    return int(obs.get["rows"]) if obs else None


def write_bucketed(
    df: DataFrame,
    path: str,
    name: str,
    by: list[str],
    buckets: int,
    fmt: str = DEFAULT_FORMAT,
    observe: Observation | None = None,
    observe_cols: list | None = None,
) -> int:
    """Write ``df`` as a catalog table at ``path``, bucketed by ``by`` into ``buckets``.

    Readers of ``spark.table(name)`` then know the data is hash-partitioned
    by the columns ``by``: aggregations keyed by them, and joins with another table bucketed
    the same way, need no shuffle.  The data is first hash-partitioned into
    exactly ``buckets`` tasks, so every bucket is one file (not one file per
    task and bucket).  Returns the row count (``Observation``).  Metrics are observed behind the
    exchange, in the stage that writes: a map task that runs again after an executor was lost cannot count twice.
    ``buckets`` must be from 1 to 100,000 (Spark's limit).
    """
    if not 1 <= buckets <= 100_000:
        raise ValueError(f"buckets must be between 1 and 100000, not {buckets}")
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    out = df.repartition(buckets, *by).observe(obs, F.count(F.lit(1)).alias("rows"))
    if observe is not None:
        out = out.observe(observe, *observe_cols)
    (
        out.write.format(fmt)
        .mode("overwrite")
        .bucketBy(buckets, *by)
        .option("path", path)
        .saveAsTable(name)
    )
    spark.catalog.refreshByPath(path)
    return int(obs.get["rows"])


def write_and_read(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, **kwargs) -> tuple[DataFrame, int | None]:
    """Write ``df`` (see :func:`write_table`) and return the written table, read back, and its row count."""
    rows = write_table(df, path, fmt=fmt, **kwargs)
    return read_table(df.sparkSession, path, fmt, schema=df.schema), rows


def append_table(df: DataFrame, path: str, first: bool, fmt: str = DEFAULT_FORMAT) -> int | None:
    """First batch overwrites (schema replaced), later batches append."""
    return write_table(df, path, fmt=fmt, mode="overwrite" if first else "append")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count (``table_name``, ``row_count``)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
