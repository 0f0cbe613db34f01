"""Silver cleaning of program A: rename, type, drop rows without keys.

Casts use ``try_cast``: under ANSI mode a plain cast of ``'*'`` or
``'12.0'`` to int raises; the paged feed does contain such values, and the
intended behaviour is "unparseable -> null, and count it"
(:func:`cast_failures`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlens import schemas as S


def _typed(raw: str, kind: str) -> Column:
    col = F.col(raw)
    return col.cast("string") if kind == "string" else col.try_cast(kind)


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows where any key is null (pushed to the scan as IsNotNull)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def rename_cast(
    raw: DataFrame,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
    columns: Sequence[tuple[str, str, str]] = S.PROGRAM_A_COLUMNS,
    keys: Sequence[str] = ("provider_npi", "hcpcs_code"),
) -> DataFrame:
    """Program A raw -> silver ``medicare``.

    Renames the 21 source columns to their clean names and types, keeps
    the audit columns when present, drops rows with a null provider or
    code, and adds ``_transformed_at`` and the literal ``snapshot_year``.
    """
    cols = [_typed(raw_name, kind).alias(clean) for raw_name, clean, kind in columns]
    cols += [F.col(a) for a in (S.INGESTED_AT, S.SOURCE_TAG) if a in raw.columns]
    return (
        require_keys(raw.select(*cols), *keys)
        .withColumn(S.TRANSFORMED_AT, F.current_timestamp())
        .withColumn("snapshot_year", F.lit(snapshot_year))
    )


def _typed_columns(columns: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return [c for c in columns if c[2] != "string"]


def cast_metrics(columns: Sequence[tuple[str, str, str]] = S.PROGRAM_A_COLUMNS) -> list[Column]:
    """Aggregates that count, per typed column, non-null inputs (``n0``, ...) and those a cast makes null (``f0``, ...)."""
    aggs = []
    for i, (raw_name, _, kind) in enumerate(_typed_columns(columns)):
        aggs.append(F.count(F.col(raw_name)).alias(f"n{i}"))
        aggs.append(
            F.count_if(F.col(raw_name).isNotNull() & F.col(raw_name).try_cast(kind).isNull()).alias(f"f{i}")
        )
    return aggs


def cast_rows(counts: dict, columns: Sequence[tuple[str, str, str]] = S.PROGRAM_A_COLUMNS) -> list[dict]:
    """The rows of :func:`cast_failures` from counted metrics (an ``Observation`` on a write)."""
    return [
        {"column_name": clean, "target_type": kind, "non_null_inputs": counts[f"n{i}"], "failed_casts": counts[f"f{i}"]}
        for i, (_, clean, kind) in enumerate(_typed_columns(columns))
    ]


def cast_failures(
    raw: DataFrame, columns: Sequence[tuple[str, str, str]] = S.PROGRAM_A_COLUMNS
) -> DataFrame:
    """Per typed column: non-null inputs, and how many of them became null.

    One aggregation pass over the raw table; one output row per column
    (``column_name``, ``target_type``, ``non_null_inputs``, ``failed_casts``).
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(clean).alias("column_name"),
                F.lit(kind).alias("target_type"),
                F.col(f"n{i}").alias("non_null_inputs"),
                F.col(f"f{i}").alias("failed_casts"),
            )
            for i, (_, clean, kind) in enumerate(_typed_columns(columns))
        ]
    )
    return raw.agg(*cast_metrics(columns)).select(F.inline(rows))
