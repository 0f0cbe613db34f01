"""Rows with faults, kept apart with the list of their faults.

A count of violations says that rows are bad, not which.  :func:`with_faults` puts the reasons on every row, in the same pass that
types it: casts that failed (``cast: total_services``), keys that are missing (``key: provider_npi``), checks that
a row violates (``check: total_services >= 0``).  :func:`split_rows` writes all rows once, clean ones and
quarantined ones in partitions of their own, so that none is lost: clean plus quarantined is the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.operators.quality import Check, checks_program_a

FAULTS = "_faults"
RAW = "_raw"
QUARANTINED = "_quarantined"
CORRUPT = "_corrupt_record"


def faults(
    columns: Sequence[tuple[str, str, str]], keys: Sequence[str], checks: Sequence[Check], nulls: str = "pass"
) -> Column:
    """The reasons against a row, in this order: casts, keys, checks; empty for a clean row.

    Works on rows that hold the clean columns and a struct ``_raw`` of the raw ones.  A check that cannot be told (null) is no fault unless ``nulls="fail"``, as in the gate.
    """
    if nulls not in ("pass", "fail"):
        raise ValueError("nulls must be 'pass' or 'fail'")
    told = [
        F.when(F.col(f"{RAW}.{raw}").isNotNull() & F.col(clean).isNull(), F.lit(f"cast: {clean}"))
        for raw, clean, kind in columns if kind != "string"
    ]
    told += [F.when(F.col(k).isNull(), F.lit(f"key: {k}")) for k in keys]
    for chk in checks:
        holds = chk.condition if nulls == "pass" else F.coalesce(chk.condition, F.lit(False))
        told.append(F.when(~holds, F.lit(f"check: {chk.label}")))
    return F.array_compact(F.array(*told))


def with_faults(
    raw: DataFrame,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
    columns: Sequence[tuple[str, str, str]] = S.PROGRAM_A_COLUMNS,
    keys: Sequence[str] = ("provider_npi", "hcpcs_code"),
    checks: Sequence[Check] | None = None,
    nulls: str = "pass",
) -> DataFrame:
    """Program A raw rows, typed, with ``_faults``; no row is left out, and the raw texts of faulty rows stay in ``_raw``.

    A row that a permissive reader could not parse (``_corrupt_record`` is set) has the one fault ``page: malformed``.
    """
    checks = checks_program_a(snapshot_year) if checks is None else checks
    checks = [c for c in checks if c.label not in {f"{k} not null" for k in keys}]  # told as keys
    corrupt = [F.col(CORRUPT)] if CORRUPT in raw.columns else []
    wide = raw.select(
        *(F.col(name).cast("string").alias(clean) if kind == "string" else F.col(name).try_cast(kind).alias(clean) for name, clean, kind in columns),
        *(F.col(a) for a in (S.INGESTED_AT, S.SOURCE_TAG) if a in raw.columns),
        F.lit(snapshot_year).alias("snapshot_year"),
        F.struct(*(name for name, _, _ in columns), *corrupt).alias(RAW),
    )
    reasons = faults(columns, keys, checks, nulls)
    if corrupt:
        reasons = F.when(F.col(f"{RAW}.{CORRUPT}").isNotNull(), F.array(F.lit("page: malformed"))).otherwise(reasons)
    return wide.withColumn(FAULTS, reasons).withColumn(RAW, F.when(F.size(FAULTS) > 0, F.col(RAW)))


def split_rows(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write rows with ``_faults`` once, split by whether they have any: (clean, quarantined, counts of both).

    Clean rows come back without the columns ``_faults`` and ``_raw``.
    """
    spark = rows.sparkSession
    seen = Observation(f"quarantine_{uuid.uuid4().hex[:8]}")
    bad = F.size(FAULTS) > 0
    told = rows.withColumn(QUARANTINED, bad).observe(
        seen, F.count_if(~bad).alias("clean"), F.count_if(bad).alias("quarantined"), F.count(F.lit(1)).alias("rows")
    )
    told.write.mode("overwrite").partitionBy(QUARANTINED).parquet(path)
    counts = {k: int(seen.get[k]) for k in ("clean", "quarantined", "rows")}
    all_rows = spark.read.schema(told.schema).parquet(path)
    clean = all_rows.where(~F.col(QUARANTINED)).drop(FAULTS, RAW, QUARANTINED)
    return clean, all_rows.where(QUARANTINED).drop(QUARANTINED), counts


def fault_counts(rows: DataFrame) -> DataFrame:
    """Rows per reason (``fault``, ``rows``); a row with several faults counts under each."""
    return rows.select(F.explode(FAULTS).alias("fault")).groupBy("fault").agg(F.count(F.lit(1)).alias("rows"))


def read_pages_permissively(spark: SparkSession, landing_dir: str, schema: T.StructType = S.PROGRAM_A_RAW) -> DataFrame:
    """Landed pages of which malformed lines become rows with ``_corrupt_record``, for :func:`with_faults`."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(landing_dir)
