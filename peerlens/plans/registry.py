"""Named queries: one per operator/table/report, each ``(spark, sf_dir) -> DataFrame``.

Outputs leave out the wall-clock audit columns (``_ingested_at``,
``_transformed_at``) and settle every double at 4 decimals with
:func:`~peerlens.functions.stable_round` (values the reports already round
keep their own precision), so that two engines that sum in a different
order print the same numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.functions import stable_round
from peerlens.operators.clean import cast_failures, rename_cast
from peerlens.operators.quality import quality_report_a, quality_report_b, quality_report_overlap
from peerlens.plans import mechanisms as M
from peerlens.plans import reports
from peerlens.plans.layers import FIXTURE_SNAPSHOT_YEAR, Layers
from peerlens.plans.stages import run_stages
from peerlens.sources.pages import PAGE_COL, page_audit, page_audit_summary
from peerlens.sources.sizing import dealt
from peerlens.sources.tables import append_table, compact_table, read_table, replace_table, write_table
from peerlens.streaming.pages import stream_page_files

VOLATILE = (S.INGESTED_AT, S.TRANSFORMED_AT)
SETTLE_DIGITS = 4

Query = Callable[[SparkSession, str], DataFrame]


def settle(df: DataFrame, digits: int = SETTLE_DIGITS) -> DataFrame:
    """Drop wall-clock columns; settle doubles at ``digits`` decimals."""
    cols = []
    for field in df.schema.fields:
        if field.name in VOLATILE:
            continue
        if isinstance(field.dataType, T.DoubleType):
            cols.append(stable_round(F.col(field.name), digits).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def _layer(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle(getattr(Layers(spark, sf_dir), attr))

    run.__name__ = attr
    return run


def _on_layers(fn: Callable[[Layers], DataFrame], bronze_written: bool = False, soiled: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle(fn(Layers(spark, sf_dir, bronze_written=bronze_written, soiled=soiled)))

    return run


def layer_row_counts(layers: Layers) -> DataFrame:
    """Rows per layer: every layer is written once, from the written one below, and counted while it is written."""
    names = ["bronze/program_a", "bronze/program_b", *(f"silver/{t}" for t in ("medicare", "medicaid", "provider_overlap")),
             *(f"gold/{t}" for t in ("agg_provider_spending", "agg_specialty_utilization", "fraud_risk_indicators"))]
    run = run_stages(
        layers.spark, layers.raw_a, layers.raw_b, snapshot_year=layers.year, root=layers.scratch("run"),
        stages=("bronze", "silver", "gold"), silver_buckets=layers.parts or 8,  # a bucket is sorted by the task that writes it
    )
    return layers.spark.createDataFrame([(n, run.row_counts[n]) for n in names], "table_name string, row_count bigint")


def stream_ingest_a(layers: Layers) -> DataFrame:
    """Landed pages -> availableNow stream -> bronze folder -> silver."""
    bronze = layers.scratch("bronze_program_a_stream")
    stream_page_files(layers.spark, layers.landing_a, bronze, layers.scratch("stream_checkpoint"))
    return rename_cast(read_table(layers.spark, bronze), snapshot_year=layers.year)


def faulty_feed_audit(layers: Layers) -> DataFrame:
    """Audit of a feed that lost every third page (the first among them) and ten rows of each page of odd number."""
    page = F.col(PAGE_COL) / S.PAGE_SIZE
    numbered = dealt(layers.pages_a, layers.parts, PAGE_COL).withColumn("_page", page.cast("bigint"))
    place = F.row_number().over(Window.partitionBy(PAGE_COL).orderBy(*S.PROGRAM_A_RAW.fieldNames()))
    cut = numbered.where("_page % 3 != 0").withColumn("_place", place).where("_page % 2 = 0 OR _place > 10")
    return page_audit_summary(page_audit(cut))


def _catalog(layers: Layers, name: str) -> tuple[str, str]:
    return layers.scratch(name), f"peerlens_check_{uuid.uuid4().hex[:12]}.{name}"


def write_register_read(layers: Layers) -> DataFrame:
    """Overwrite sink, schema creation, registration and read by name."""
    path, name = _catalog(layers, "medicaid")
    write_table(layers.medicaid, path, name=name)
    return read_table(layers.spark, name)


def _by_month_text(layers: Layers) -> DataFrame:
    """Silver ``medicaid`` with the month of the year alone, as text of two digits."""
    return layers.medicaid.withColumn("claim_month", F.substring("claim_month", 6, 2))


def register_partitioned(layers: Layers) -> DataFrame:
    """A partitioned table read by its name: all rows, months as the text they are."""
    path, name = _catalog(layers, "months")
    write_table(_by_month_text(layers), path, name=name, partition_by=["claim_month"])
    return read_table(layers.spark, name).select(*layers.medicaid.columns)


def replace_by_name(layers: Layers) -> DataFrame:
    """A name replaced by other rows, columns and partitions, made of the rows that it showed before."""
    root, name = _catalog(layers, "replaced")
    replace_table(layers.medicaid.drop("claim_year"), name, root)
    replace_table(layers.spark.table(name).where("total_paid > 20000"), name, root)
    kept = read_table(layers.spark, name).withColumn("claim_year", F.lit(YEAR))
    replace_table(kept, name, root, partition_by=["claim_month"])
    return read_table(layers.spark, name).select(*layers.medicaid.columns)


def compact_text_partitions(layers: Layers) -> DataFrame:
    """Packing the small files of a table whose partition values look like numbers: no schema given, no value changed."""
    path = layers.scratch("text_partitions")
    months = _by_month_text(layers)
    write_table(months.repartition(12), path, partition_by=["claim_month"])
    compact_table(layers.spark, path)
    return read_table(layers.spark, path, schema=months.schema).select(*months.columns)


def append_batches(layers: Layers) -> DataFrame:
    """First-overwrite/append sink: one batch per month of the year, then the table by path."""
    path, batches = layers.scratch("batches"), layers._written("medicaid", layers.medicaid)
    for month in range(1, 13):
        append_table(batches.where(F.col("claim_month") == f"{YEAR}-{month:02d}"), path, first=month == 1)
    return read_table(layers.spark, path, schema=batches.schema)


def compact_small_files(layers: Layers) -> DataFrame:
    """Compaction of a partitioned table of many small files: the same rows, month folders kept."""
    path = layers.scratch("small_files")
    write_table(layers.medicaid.repartition(16), path, partition_by=["claim_month"])
    schema = read_table(layers.spark, path).schema
    compact_table(layers.spark, path, partition_by=["claim_month"], schema=schema)
    return read_table(layers.spark, path, schema=schema).withColumn("claim_month", F.col("claim_month").cast("string"))


YEAR = FIXTURE_SNAPSHOT_YEAR

QUERIES: dict[str, Query] = {
    # silver
    "clean_program_a": _layer("medicare"),
    "cast_report_a": _on_layers(lambda L: cast_failures(L.raw_a)),
    "clean_program_b_monthly": _layer("medicaid"),
    "rollup_a_code": _layer("a_code"),
    "rollup_b_code": _layer("b_code"),
    "provider_overlap": _layer("overlap"),
    # quality gate
    "quality_report_a": _on_layers(lambda L: quality_report_a(L.medicare, YEAR)),
    "quality_report_b": _on_layers(lambda L: quality_report_b(L.medicaid, YEAR)),
    "quality_report_overlap": _on_layers(lambda L: quality_report_overlap(L.overlap, YEAR)),
    # gold
    "provider_spending": _layer("spending"),
    "specialty_utilization": _layer("utilization"),
    "peer_benchmarks": _layer("benchmarks"),
    "risk_indicators": _layer("risk"),
    # reports
    "report_highest_risk": _on_layers(lambda L: reports.report_highest_risk(L.risk)),
    "report_charge_gap": _on_layers(lambda L: reports.report_charge_gap(L.utilization)),
    "report_dual_billing": _on_layers(lambda L: reports.report_dual_billing(L.spending)),
    "report_state_reimbursement": _on_layers(lambda L: reports.report_state_reimbursement(L.spending)),
    "report_top_codes": _on_layers(lambda L: reports.report_top_codes(L.risk)),
    # paged feed: batch read of landed pages, page audit, streaming ingest
    "ingest_pages_program_a": _on_layers(lambda L: rename_cast(L.pages_a, snapshot_year=L.year)),
    "page_audit_program_a": _on_layers(lambda L: page_audit_summary(page_audit(L.pages_a))),
    "stream_pages_program_a": _on_layers(stream_ingest_a),
    "page_audit_faulty_feed": _on_layers(faulty_feed_audit),
    # sinks and sources
    "write_register_read": _on_layers(write_register_read),
    "register_partitioned": _on_layers(register_partitioned),
    "replace_by_name": _on_layers(replace_by_name),
    "compact_text_partitions": _on_layers(compact_text_partitions),
    "append_batches": _on_layers(append_batches),
    "compact_small_files": _on_layers(compact_small_files),
    # the same operators on inputs with faults: nulls, bad numbers, violations, ties, zeros
    "clean_program_a_dirty": _on_layers(lambda L: L.medicare, soiled=True),
    "cast_report_a_dirty": _on_layers(lambda L: cast_failures(L.raw_a), soiled=True),
    "clean_program_b_monthly_dirty": _on_layers(lambda L: L.medicaid, soiled=True),
    "quality_report_a_dirty": _on_layers(lambda L: quality_report_a(L.medicare, YEAR), soiled=True),
    "quality_report_b_dirty": _on_layers(lambda L: quality_report_b(L.medicaid, YEAR), soiled=True),
    "quality_report_overlap_dirty": _on_layers(lambda L: quality_report_overlap(L.overlap, YEAR), soiled=True),
    "rollup_a_code_dirty": _on_layers(lambda L: L.a_code, soiled=True),
    "provider_overlap_dirty": _on_layers(lambda L: L.overlap, soiled=True),
    "provider_spending_dirty": _on_layers(lambda L: L.spending, soiled=True),
    "specialty_utilization_dirty": _on_layers(lambda L: L.utilization, soiled=True),
    "peer_benchmarks_dirty": _on_layers(lambda L: L.benchmarks, soiled=True),
    "risk_indicators_dirty": _on_layers(lambda L: L.risk, soiled=True),
    # paged source, envelopes, reloads
    "paged_source_program_a": _on_layers(M.paged_source_program_a),
    "paged_stream_program_a": _on_layers(M.paged_stream_program_a),
    "envelope_audit_program_a": _on_layers(M.envelope_audit_program_a),
    "reload_pages_program_a": _on_layers(M.reload_pages_program_a),
    "reload_months_program_b": _on_layers(M.reload_months_program_b),
    "incremental_rollup_b_code": _on_layers(M.incremental_rollup_b_code),
    "incremental_provider_spending": _on_layers(M.incremental_provider_spending),
    # exact quantiles, states that merge
    "exact_service_quantiles": _on_layers(M.exact_service_quantiles),
    "exact_service_quantiles_dirty": _on_layers(M.exact_service_quantiles, soiled=True),
    "peer_benchmarks_exact": _on_layers(M.peer_benchmarks_exact),
    "peer_benchmarks_exact_dirty": _on_layers(M.peer_benchmarks_exact, soiled=True),
    "specialty_states_merged": _on_layers(M.specialty_states_merged),
    "specialty_states_merged_dirty": _on_layers(M.specialty_states_merged, soiled=True),
    "code_states_merged": _on_layers(M.code_states_merged),
    # faults, heavy keys, drift
    "quarantined_rows_dirty": _on_layers(M.quarantined_rows, soiled=True),
    "quarantine_summary_dirty": _on_layers(M.quarantine_summary, soiled=True),
    "risk_measured_keys": _on_layers(M.risk_measured_keys),
    "risk_measured_keys_dirty": _on_layers(M.risk_measured_keys, soiled=True),
    "drift_report_program_a": _on_layers(M.drift_report_program_a),
    # counts per layer
    "layer_row_counts": _on_layers(layer_row_counts),
}
