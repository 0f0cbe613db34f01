"""The written pipeline: counts, re-run stability, sinks and compaction."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from peerlens.plans.layers import FIXTURE_SNAPSHOT_YEAR, Layers
from peerlens.plans.stages import run_stages
from peerlens.sources.fixtures import program_a_raw, program_b_raw
from peerlens.sources.tables import append_table, compact_table, read_table, write_table
from tests.conftest import SF_SMOKE

VOLATILE = {"_ingested_at", "_transformed_at"}


def _stable(df):
    """Rows without wall-clock columns, ordered by their non-double columns."""
    cols = [c for c, _ in df.dtypes if c not in VOLATILE]
    doubles = {i for i, c in enumerate(cols) if dict(df.dtypes)[c] == "double"}
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: tuple(repr(v) for i, v in enumerate(r) if i not in doubles)), doubles


def _same(a, b) -> bool:
    """Equal rows; doubles equal up to summation-order noise (relative 1e-12).

    Double sums depend on the order partial sums meet, which differs from
    run to run in the last binary digits; everything else must be identical.
    """
    (ra, da), (rb, _) = _stable(a), _stable(b)
    if len(ra) != len(rb):
        return False
    for x, y in zip(ra, rb):
        for i, (u, v) in enumerate(zip(x, y)):
            if i in da and u is not None and v is not None:
                if not math.isclose(u, v, rel_tol=1e-12, abs_tol=1e-9):
                    return False
            elif u != v:
                return False
    return True


@pytest.fixture(scope="module")
def two_runs(spark):
    import tempfile

    roots = [tempfile.mkdtemp(prefix="peerlens-run-") for _ in range(2)]
    return [
        run_stages(spark, program_a_raw(spark, SF_SMOKE), program_b_raw(spark, SF_SMOKE),
                     snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=r, register=(i == 0))
        for i, r in enumerate(roots)
    ]


def test_counts_match_lazy_layers(spark, two_runs):
    run = two_runs[0]
    L = Layers(spark, SF_SMOKE)
    assert run.row_counts["silver/medicare"] == L.medicare.count() == 2560
    assert run.row_counts["silver/medicaid"] == L.medicaid.count() == 422
    assert run.row_counts["silver/provider_overlap"] == 226
    assert run.row_counts["gold/fraud_risk_indicators"] == 226
    assert run.row_counts["gold/agg_provider_spending"] == 150
    assert len(run.quality) == 19 and all(q["violations"] == 0 for q in run.quality)


def test_rerun_gives_same_tables(spark, two_runs):
    a, b = two_runs
    for table in ("silver/medicare", "silver/medicaid", "silver/provider_overlap",
                  "gold/agg_provider_spending", "gold/agg_specialty_utilization", "gold/fraud_risk_indicators"):
        assert _same(read_table(spark, f"{a.root}/{table}"), read_table(spark, f"{b.root}/{table}"))


def test_registered_gold_tables(spark, two_runs):
    assert spark.table("gold.fraud_risk_indicators").count() == 226


def test_bronze_b_partitioned_by_month(spark, two_runs):
    root = two_runs[0].root
    months = sorted(os.path.basename(p) for p in glob.glob(f"{root}/bronze/program_b/CLAIM_FROM_MONTH=*"))
    assert months and all(m.startswith("CLAIM_FROM_MONTH=") for m in months)
    df = read_table(spark, f"{root}/bronze/program_b").filter(F.col("CLAIM_FROM_MONTH").between("1998-01", "1998-12"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "CLAIM_FROM_MONTH" in plan


def test_append_and_compact(spark, scratch):
    df = spark.range(0, 1000).withColumn("v", F.col("id") * 2)
    path = f"{scratch}/t"
    assert append_table(df.repartition(5), path, first=True) == 1000
    assert append_table(df.repartition(5), path, first=False) == 1000
    assert read_table(spark, path).count() == 2000
    files_before = len(glob.glob(f"{path}/*.parquet"))
    assert compact_table(spark, path) == (10, 1)
    assert files_before == 10 and len(glob.glob(f"{path}/*.parquet")) == 1
    assert read_table(spark, path).count() == 2000
    assert compact_table(spark, path) == (1, 1)  # again: the old copy is replaced
    # overwrite replaces schema and rows
    assert write_table(spark.range(3), path) == 3
    assert read_table(spark, path).columns == ["id"]


def test_compaction_keeps_partition_folders(spark, scratch):
    path = f"{scratch}/parts"
    df = spark.range(0, 600).select((F.col("id") % 3).cast("string").alias("month"), "id")
    write_table(df.repartition(6), path, partition_by=["month"])
    before, after = compact_table(spark, path, partition_by=["month"])
    assert before == 18 and after == 3
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/month=*")) == ["month=0", "month=1", "month=2"]
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(600))


def test_critical_failure_stops_before_gold(spark, scratch):
    from peerlens import schemas as S

    names = [raw for raw, _, _ in S.PROGRAM_A_COLUMNS]
    row = dict.fromkeys(names)
    row.update({"Rndrng_NPI": "123456789", "HCPCS_Cd": "C1", "Tot_Srvcs": "1", "Avg_Sbmtd_Chrg": "1",
                "Avg_Mdcr_Pymt_Amt": "1", "Rndrng_Prvdr_Type": "S"})
    raw_a = spark.createDataFrame([tuple(row[n] for n in names)], S.PROGRAM_A_RAW)
    raw_b = spark.createDataFrame([("123456789", "9", "C1", "2022-03", 1, 1, 10.0)], S.PROGRAM_B_RAW)
    with pytest.raises(ValueError, match="provider_npi is 10 digits"):
        run_stages(spark, raw_a, raw_b, snapshot_year=2022, root=scratch)
    assert os.path.isdir(f"{scratch}/silver/provider_overlap")
    assert not os.path.exists(f"{scratch}/gold")


def test_stages_rerun_one_at_a_time(spark, two_runs):
    """A stage re-run alone reads its inputs from the run root.

    Uses the second run: DataFrames of the first one (read before) keep the
    file listing they were created with, so it must stay untouched.
    """
    root = two_runs[1].root
    gold = run_stages(spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=root, stages=("gold",))
    assert gold.row_counts["gold/fraud_risk_indicators"] == 226
    rep = run_stages(spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=root, stages=("quality", "reports"))
    assert len(rep.quality) == 19 and rep.row_counts["report_state_reimbursement"] == 25
    with pytest.raises(ValueError):
        run_stages(spark, None, None, root=root, stages=("bronze",))


def test_from_records_and_preview(spark):
    from peerlens import schemas as S
    from peerlens.sources.tables import from_records, preview

    page = [{"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1", "Extra": "x"}, {"Rndrng_NPI": "1000000002"}]
    df = from_records(spark, page, S.PROGRAM_A_RAW)
    assert df.schema == S.PROGRAM_A_RAW  # all-null columns keep their declared type
    rows = df.collect()
    assert rows[0].HCPCS_Cd == "C1" and rows[1].HCPCS_Cd is None
    assert preview(spark.range(100)).count() == 5


def test_silver_is_bucketed_and_co_partitioned(spark, two_runs):
    from peerlens.operators.overlap import provider_overlap
    from peerlens.operators.rollup import rollup_a_code, rollup_b_code

    run = two_runs[0]
    m, d = run.tables["silver/medicare"], run.tables["silver/medicaid"]
    plan = provider_overlap(rollup_a_code(m), rollup_b_code(d))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SelectedBucketsCount") == 2
    assert "Exchange hashpartitioning" not in plan  # both rollups and the join ride on the buckets


def test_report_views_equal_dataframe_reports(spark, two_runs):
    from peerlens.plans.report_views import SOURCES, register_reports

    settings = {"report_dual_billing": {"min_providers": 10}, "report_highest_risk": {"score": 1}, "report_top_codes": {"score": 1}}
    assert register_reports(spark, gold="gold", **settings) == list(SOURCES)
    for name, (table, build) in SOURCES.items():
        want = build(spark.table(f"gold.{table}"), **settings.get(name, {}))
        got = spark.sql(f"SELECT * FROM {name}")
        assert got.dtypes == want.dtypes
        rows = [tuple(r) for r in got.collect()]
        assert rows and rows == [tuple(r) for r in want.collect()]


def test_observed_quality_equals_scanned(spark, two_runs):
    """Checks counted during the silver writes equal a separate scan."""
    run = two_runs[0]
    rescan = run_stages(spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=run.root, stages=("quality",))
    assert run.observed_quality and run.quality == rescan.quality


def test_bucket_count_changes_no_gold_and_roots_do_not_mix(spark, scratch, two_runs):
    spark.conf.set("spark.sql.shuffle.partitions", "200000")  # the bucket count must not follow it
    try:
        from peerlens.plans.stages import silver_database

        assert silver_database(f"{scratch}/day1/out") != silver_database(f"{scratch}/day2/out")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    run = run_stages(spark, program_a_raw(spark, SF_SMOKE), program_b_raw(spark, SF_SMOKE),
                     snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=f"{scratch}/plain", silver_buckets=3)
    for table in ("gold/agg_provider_spending", "gold/agg_specialty_utilization", "gold/fraud_risk_indicators"):
        assert _same(run.tables[table], two_runs[0].tables[table])
    assert run.quality == two_runs[0].quality
    with pytest.raises(ValueError, match="buckets"):
        run_stages(spark, None, None, root=run.root, stages=("silver",), silver_buckets=100_001)


def test_provider_is_spread_over_buckets(spark, two_runs):
    """Buckets are by provider and code: a provider with many codes is not one task."""
    from pyspark.sql import functions as F

    silver = two_runs[0].tables["silver/medicare"]
    placed = silver.select("provider_npi", "hcpcs_code", F.input_file_name().alias("file"))
    spread = placed.groupBy("provider_npi").agg(F.count_distinct("file").alias("files"), F.count_distinct("hcpcs_code").alias("codes"))
    assert spread.where("codes > 8 AND files > 1").count() > 0


def test_gold_rerun_reads_the_bucketed_table(spark, two_runs):
    from peerlens.plans.stages import RunResult

    again = RunResult(root=two_runs[0].root)
    plan = again.table(spark, "silver/medicare").groupBy("provider_npi", "hcpcs_code").count()
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_bad_numbers_and_thresholds_reach_the_run(spark, scratch):
    from peerlens.sources.fixtures import soiled_program_a

    dirty = soiled_program_a(program_a_raw(spark, SF_SMOKE))
    run = run_stages(
        spark, dirty, program_b_raw(spark, SF_SMOKE), snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=f"{scratch}/dirty",
        stages=("bronze", "silver"), silver_buckets=4, compact=True,
    )
    with pytest.raises(ValueError, match="10 digits"):
        run_stages(spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=run.root, stages=("quality",))
    from peerlens.operators.clean import cast_failures

    failed = {r.column_name: r.failed_casts for r in cast_failures(run.table(spark, "bronze/program_a")).collect()}
    assert failed["total_services"] > 0 and failed["avg_submitted_charge"] > 0 and failed["total_beneficiaries"] == 0
    gold = run_stages(
        spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=run.root, stages=("gold", "reports"),
        risk={"spend_threshold": 1, "salt_buckets": 3}, report_settings={"report_dual_billing": {"min_providers": 1}},
    )
    flags = gold.tables["gold/fraud_risk_indicators"]
    assert flags.where("medicaid_total_paid > 1 AND NOT high_medicaid_spend_flag").count() == 0
    assert gold.reports["report_dual_billing"].count() > 0


def test_reloaded_months_equal_a_full_run(spark, scratch, two_runs):
    """A run on a wrong February and no March, then both months taken again: the same tables as the full run."""
    from peerlens.plans.mechanisms import _february_doubled
    from peerlens.plans.stages import reload_months

    year = FIXTURE_SNAPSHOT_YEAR
    raw_b = program_b_raw(spark, SF_SMOKE)
    raw_b.write.parquet(f"{scratch}/raw_b")
    raw_b = spark.read.schema(raw_b.schema).parquet(f"{scratch}/raw_b")
    root = f"{scratch}/run"
    run_stages(spark, program_a_raw(spark, SF_SMOKE), _february_doubled(raw_b, year), snapshot_year=year, root=root)
    for months in ([f"{year}-02"], [f"{year}-03", f"{year}-04"]):  # the totals are made first, then kept up to date
        again = reload_months(spark, raw_b, months, root, snapshot_year=year, totals_parts=4)
    full = two_runs[0]
    for table in ("silver/medicaid", "silver/provider_overlap", "gold/agg_provider_spending", "gold/fraud_risk_indicators"):
        assert _same(again.table(spark, table), full.table(spark, table)), table
        assert again.row_counts[table] == full.row_counts[table]
    assert _same(read_table(spark, f"{root}/bronze/program_b").drop("_ingested_at"), read_table(spark, f"{full.root}/bronze/program_b").drop("_ingested_at"))
    assert [q["check_name"] for q in again.quality] == [q["check_name"] for q in full.quality] and len(again.cast_failures) == 7
    assert sorted(again.reports) == sorted(full.reports)


def test_exact_quantile_in_the_run(spark, scratch, two_runs):
    root = two_runs[1].root
    gold = run_stages(spark, None, None, snapshot_year=FIXTURE_SNAPSHOT_YEAR, root=root, stages=("gold",), risk={"exact_quantile": True})
    assert _same(gold.tables["gold/fraud_risk_indicators"], two_runs[0].table(spark, "gold/fraud_risk_indicators"))


def test_buckets_follow_the_bytes(spark, two_runs):
    from peerlens.plans.stages import bucket_count

    root = two_runs[0].root
    assert bucket_count(spark, root) == spark.sparkContext.defaultParallelism
    assert bucket_count(spark, root, file_bytes=1000) > 16
    assert bucket_count(spark, root, file_bytes=1) <= 100_000


def test_casts_counted_on_the_write_equal_a_scan(spark, two_runs):
    from peerlens.operators.clean import cast_failures

    scanned = [r.asDict() for r in cast_failures(two_runs[0].table(spark, "bronze/program_a")).collect()]
    assert two_runs[0].cast_failures == scanned and len(scanned) == 7
