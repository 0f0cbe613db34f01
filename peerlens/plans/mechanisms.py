"""Queries of the mechanisms beside the plain run: paged source, reloads, exact quantiles, mergeable states, quarantine, heavy keys, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens import schemas as S
from peerlens.operators.clean import rename_cast
from peerlens.operators.drift import drift_report, read_lines
from peerlens.operators.hot_keys import hot_keys
from peerlens.operators.incremental import MonthlyTotals
from peerlens.operators.marts import PEER_KEYS, peer_benchmarks, provider_spending, risk_indicators
from peerlens.operators.quantile import exact_group_quantile
from peerlens.operators.quarantine import FAULTS, fault_counts, split_rows, with_faults
from peerlens.operators.rollup import rollup_b_monthly
from peerlens.operators.states import CLAIM_STATES, SERVICE_STATES
from peerlens.plans.layers import Layers
from peerlens.sources.paged import landed_fetch, read_paged, stream_paged
from peerlens.sources.pages import envelope_audit, envelope_rows, land_envelopes, page_audit_summary, read_envelopes, write_envelopes
from peerlens.sources.files import Files
from peerlens.sources.reload import replace_partitions
from peerlens.sources.tables import read_table, write_table
from peerlens.streaming.pages import read_taken_envelopes, stream_envelopes


# -- paged feed --------------------------------------------------------------
def paged_source_program_a(layers: Layers) -> DataFrame:
    """The feed through the paged data source (fetched page by page in the tasks), cleaned."""
    pages = read_paged(layers.spark, landed_fetch(layers.landing_a), name="program_a_feed")
    return rename_cast(pages, snapshot_year=layers.year)


def paged_stream_program_a(layers: Layers) -> DataFrame:
    """The same feed taken by the source's stream reader into bronze, cleaned."""
    bronze = layers.scratch("bronze_program_a_feed")
    stream_paged(layers.spark, landed_fetch(layers.landing_a), bronze, layers.scratch("feed_checkpoint"), name="program_a_grown")
    return rename_cast(read_table(layers.spark, bronze), snapshot_year=layers.year)


def _plain_a(layers: Layers) -> DataFrame:
    return layers.raw_a.drop(S.INGESTED_AT, S.SOURCE_TAG)


def envelope_audit_program_a(layers: Layers) -> DataFrame:
    """Pages landed as envelopes in one flat folder, and their audit."""
    landing = layers.scratch("envelopes")
    land_envelopes(_plain_a(layers), landing)
    return page_audit_summary(envelope_audit(read_envelopes(layers.spark, landing)))


def reload_pages_program_a(layers: Layers) -> DataFrame:
    """All pages taken by the stream, first with wrong services in some and one page empty, then those landed again: every row once."""
    landing, bronze, checkpoint = (layers.scratch(n) for n in ("envelopes", "bronze_pages", "pages_checkpoint"))
    right = layers.scratch("right_envelopes")
    land_envelopes(_plain_a(layers), right)
    pages = layers.spark.read.schema(read_envelopes(layers.spark, right).drop("_landed_at", "_page_file").schema).json(right)
    number = F.col("_page_offset") / S.PAGE_SIZE
    wrong = F.transform("rows", lambda r: r.withField("Tot_Srvcs", F.lit("-1")))
    none = F.filter("rows", lambda r: F.lit(False))
    spoiled = pages.withColumn("rows", F.when(number == 0, none).when(number % 3 == 1, wrong).otherwise(F.col("rows")))
    write_envelopes(spoiled, landing)
    stream_envelopes(layers.spark, landing, bronze, checkpoint)
    write_envelopes(pages.where((number == 0) | (number % 3 == 1)), landing, "append")
    Files(layers.spark, right).delete(right)  # landed: no longer read
    stream_envelopes(layers.spark, landing, bronze, checkpoint)
    return rename_cast(envelope_rows(read_taken_envelopes(layers.spark, bronze)), snapshot_year=layers.year)


# -- months ------------------------------------------------------------------
def _february_doubled(raw: DataFrame, year: int) -> DataFrame:
    """Program B with paid amounts of February doubled and without March."""
    month = F.col(S.B_MONTH)
    paid = F.when(month == f"{year}-02", F.col(S.B_PAID) * 2).otherwise(F.col(S.B_PAID))
    return raw.where(month != f"{year}-03").withColumn(S.B_PAID, paid)


def reload_months_program_b(layers: Layers) -> DataFrame:
    """Bronze B loaded with a wrong February and no March; both months loaded again, nothing else touched."""
    bronze, raw = layers.scratch("bronze_b"), layers._written("raw_b", layers.raw_b)
    write_table(_february_doubled(raw, layers.year).hint("rebalance", S.B_MONTH), bronze, partition_by=[S.B_MONTH])
    months = [f"{layers.year}-02", f"{layers.year}-03"]
    replace_partitions(raw.where(F.col(S.B_MONTH).isin(months)), bronze, S.B_MONTH, months)
    return rollup_b_monthly(read_table(layers.spark, bronze, schema=raw.schema), snapshot_year=layers.year)


def monthly_totals(layers: Layers) -> MonthlyTotals:
    """Monthly totals after a first load with a wrong February and no March, a correction and an append."""
    raw = layers._written("raw_b", layers.raw_b)
    totals = MonthlyTotals(layers.spark, layers.scratch("monthly_totals"), layers.year, parts=8)
    totals.load(_february_doubled(raw, layers.year), totals.months)
    for month in ("02", "03"):
        totals.load(raw, [f"{layers.year}-{month}"])
    return totals


def incremental_rollup_b_code(layers: Layers) -> DataFrame:
    """Provider x code totals kept up to date by months."""
    return monthly_totals(layers).code_rollup()


def incremental_provider_spending(layers: Layers) -> DataFrame:
    """The spending mart on program B totals kept up to date by months."""
    return provider_spending(layers._by_provider, None, layers.year, b_totals=monthly_totals(layers).provider_rollup())


# -- quantiles, states -------------------------------------------------------
def exact_service_quantiles(layers: Layers) -> DataFrame:
    """Median and 95th percentile of services per specialty, exact for groups of any size."""
    rows = layers._written("services", layers.medicare.select("provider_specialty", "total_services"))
    # far below the default accuracy, so that the rounds of the selection run on these groups too
    level = lambda q: exact_group_quantile(rows, ["provider_specialty"], "total_services", q, accuracy=400)
    median = level(0.5).select(F.col("provider_specialty").alias("_specialty"), F.col("quantile").alias("median_services"))
    p95 = level(0.95).withColumnRenamed("quantile", "p95_services")
    same = F.col("provider_specialty").eqNullSafe(F.col("_specialty"))
    return p95.join(median, same).select("provider_specialty", F.col("rows").alias("row_count"), "median_services", "p95_services")


def peer_benchmarks_exact(layers: Layers) -> DataFrame:
    """The peer benchmarks with the exact 95th percentile."""
    return peer_benchmarks(layers.overlap_table, exact=True, accuracy=20)


def specialty_states_merged(layers: Layers) -> DataFrame:
    """Per specialty, from states kept per specialty and code: weighted means, distinct providers and codes."""
    states = SERVICE_STATES.states(layers.medicare, ["provider_specialty", "hcpcs_code"])
    kept = layers._written("service_states", states)
    out = SERVICE_STATES.values(SERVICE_STATES.merged(kept, ["provider_specialty"]), ["provider_specialty"])
    return out.withColumnRenamed("rows", "row_count")


def code_states_merged(layers: Layers) -> DataFrame:
    """Program B per code, from states kept per code and month: sums, mean, distinct providers and months."""
    kept = layers._written("claim_states", CLAIM_STATES.states(layers.medicaid, ["hcpcs_code", "claim_month"]))
    out = CLAIM_STATES.values(CLAIM_STATES.merged(kept, ["hcpcs_code"]), ["hcpcs_code"])
    return out.withColumnRenamed("rows", "row_count")


# -- faults, heavy keys, drift -----------------------------------------------
def _split(layers: Layers) -> tuple[DataFrame, DataFrame]:
    clean, bad, counts = split_rows(with_faults(layers.raw_a, layers.year), layers.scratch("quarantine"))
    if counts["clean"] + counts["quarantined"] != counts["rows"]:
        raise RuntimeError(f"rows were lost: {counts}")
    return clean, bad


def quarantined_rows(layers: Layers) -> DataFrame:
    """The rows behind failed casts, missing keys and violated checks, with their reasons."""
    _, bad = _split(layers)
    return bad.select("provider_npi", "hcpcs_code", "place_of_service", F.array_join(FAULTS, "; ").alias("faults"))


def quarantine_summary(layers: Layers) -> DataFrame:
    """Rows per reason, and the clean ones."""
    clean, bad = _split(layers)
    rest = clean.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("clean").alias("fault"), "rows")
    return fault_counts(bad).unionByName(rest).withColumnRenamed("rows", "row_count")


def risk_measured_keys(layers: Layers) -> DataFrame:
    """The risk mart with the heavy peer groups measured and spread."""
    shared = layers.overlap_table
    return risk_indicators(shared, peer_benchmarks(shared), snapshot_year=layers.year, hot=hot_keys(shared, PEER_KEYS, least=10))


def drift_report_program_a(layers: Layers) -> DataFrame:
    """Landed pages against the declared schema: a field gone, one gone and one retyped for even providers, one new."""
    landing, raw = layers.scratch("drifted"), _plain_a(layers).drop("HCPCS_Drug_Ind")
    even = F.col("Rndrng_NPI").cast("bigint") % 2 == 0
    changed = raw.where(even).drop("Rndrng_Prvdr_City").withColumns({"Tot_Benes": F.col("Tot_Benes").cast("int"), "Tot_New": F.lit(1)})
    raw.where(~even).write.json(landing)
    changed.write.mode("append").json(landing)
    return drift_report(read_lines(layers.spark, landing))
