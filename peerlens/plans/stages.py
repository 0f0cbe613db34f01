"""The whole run, in order: bronze -> silver -> quality gate -> gold -> reports.

Each layer is written, then *read back* by the next one: the written
tables cut the lineage (a lost executor recomputes from the last written
layer, not from the raw files), and every source table is scanned once
per consumer instead of re-planning bronze four times.  Row counts come
from ``Observation`` on the writes.  Output goes under the shared
folder the cluster names in ``spark.checkpoint.dir`` unless a root is
given.

Bronze B is written partitioned by month on disk, after a ``rebalance``
on the month: one hash exchange by month, with AQE splitting a month that
holds a large share of the rows into advisory-sized pieces and merging
small ones.  Each write task then writes files of one month only (no
task x month file explosion, no single task for a hot month, and no extra
sampling pass over the input as a range partitioning would need).  The
silver month filter prunes folders.
"""

from __future__ import annotations

import hashlib
import math
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerlens import schemas as S
from peerlens.operators.clean import cast_failures, cast_metrics, cast_rows, rename_cast
from peerlens.operators.hot_keys import hot_keys
from peerlens.operators.incremental import MonthlyTotals
from peerlens.operators.marts import PEER_KEYS, peer_benchmarks, provider_spending, risk_indicators, specialty_utilization
from peerlens.operators.overlap import provider_overlap
from peerlens.operators.quality import (
    check_metrics,
    checks_overlap,
    checks_program_a,
    checks_program_b,
    enforce,
    quality_report_a,
    quality_report_b,
    quality_report_overlap,
    report_from_metrics,
)
from peerlens.operators.rollup import rollup_a_code, rollup_b_code, rollup_b_monthly
from peerlens.plans import reports
from peerlens.session import checkpoint_dir
from peerlens.sources.files import TARGET_FILE_BYTES, folder_bytes
from peerlens.sources.reload import replace_partitions
from peerlens.sources.tables import compact_table, read_table, write_and_read, write_bucketed, write_table


#: Silver tables written as bucketed catalog tables, and the columns that deal them out.
BUCKETED = ("silver/medicare", "silver/medicaid")
BUCKET_KEYS = ["provider_npi", "hcpcs_code"]
MOST_BUCKETS = 100_000


def silver_database(root: str) -> str:
    """Name of the database of a run's silver tables: made from the whole root, so two roots never share one."""
    return f"silver_{hashlib.sha1(root.rstrip('/').encode()).hexdigest()[:16]}"


def bucket_count(spark: SparkSession, root: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Buckets for the silver tables of a run: its larger bronze table over the size of a file, at least one per core."""
    largest = max(folder_bytes(spark, f"{root}/bronze/{name}") for name in ("program_a", "program_b"))
    return min(MOST_BUCKETS, max(spark.sparkContext.defaultParallelism, math.ceil(largest / file_bytes)))


@dataclass
class RunResult:
    root: str
    row_counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    observed_quality: dict[str, list[dict]] = field(default_factory=dict)
    database: str | None = None
    cast_failures: list[dict] = field(default_factory=list)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A layer written by this run, or by an earlier run of the same root."""
        if name not in self.tables:
            catalog = f"{self.database or silver_database(self.root)}.{name.split('/')[-1]}"
            # a bucketed silver table is read by its name, which keeps the bucketing
            known = name in BUCKETED and spark.catalog.tableExists(catalog)
            self.tables[name] = read_table(spark, catalog if known else f"{self.root}/{name}")
        return self.tables[name]


def _concurrently(jobs: dict[str, Callable[[], tuple[DataFrame, int | None]]]) -> dict[str, tuple]:
    """Run independent writes as concurrent Spark jobs (one driver thread each).

    The scheduler interleaves their tasks on the same executors, so a stage
    that leaves cores idle (a small final stage, a single-file scan) does not
    hold the other write back.  The first error is raised after all finished.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def default_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/peerlens-run-{uuid.uuid4().hex[:10]}"


def _compacted(spark: SparkSession, root: str, name: str, result: RunResult, partition_by: list[str] | None = None) -> None:
    """Compact a written layer in place and read it again."""
    schema = result.tables[name].schema
    compact_table(spark, f"{root}/{name}", partition_by, schema=schema)
    result.tables[name] = read_table(spark, f"{root}/{name}", schema=schema)


def run_bronze(
    spark: SparkSession, raw_a: DataFrame, raw_b: DataFrame, root: str, result: RunResult, compact: bool = False
) -> None:
    """Land both sources side by side (two concurrent jobs)."""
    t = time.time()
    b = raw_b.hint("rebalance", S.B_MONTH)
    # casts that will fail are counted while the raw rows are written: no second scan
    casts = Observation(f"casts_{uuid.uuid4().hex[:6]}")
    watch = {"observe": casts, "observe_cols": cast_metrics()}
    done = _concurrently(
        {
            "bronze/program_a": lambda: write_and_read(raw_a, f"{root}/bronze/program_a", **watch),
            "bronze/program_b": lambda: write_and_read(b, f"{root}/bronze/program_b", partition_by=[S.B_MONTH]),
        }
    )
    for name, (table, rows) in done.items():
        result.tables[name], result.row_counts[name] = table, rows
    result.cast_failures = cast_rows(casts.get)
    if compact:
        _compacted(spark, root, "bronze/program_a", result)
        _compacted(spark, root, "bronze/program_b", result, [S.B_MONTH])
    result.seconds["bronze"] = time.time() - t


def run_silver(
    spark: SparkSession, root: str, snapshot_year: int, result: RunResult, buckets: int | None, database: str
) -> None:
    """Clean A and roll B up to months (concurrently), then build the overlap from both.

    Both silver tables are written bucketed by provider and code
    (catalog tables ``<database>.medicare`` / ``.medicaid``): the code
    rollups and the overlap join read co-partitioned data and skip their shuffles; the per-provider rollups of the
    spending mart shuffle pre-combined rows.  No provider sits in one bucket.
    """
    t = time.time()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    medicare = rename_cast(result.table(spark, "bronze/program_a"), snapshot_year=snapshot_year)
    medicaid = rollup_b_monthly(result.table(spark, "bronze/program_b"), snapshot_year=snapshot_year)
    watched = _Checks(snapshot_year)
    silver = {"silver/medicare": medicare, "silver/medicaid": medicaid}
    buckets = buckets or bucket_count(spark, root)
    jobs = {key: (lambda key=key, df=df: _write_silver(spark, root, key, df, buckets, database, watched)) for key, df in silver.items()}
    for name, (table, rows) in _concurrently(jobs).items():
        result.tables[name], result.row_counts[name] = table, rows
    b_code = rollup_b_code(result.tables["silver/medicaid"])
    _write_overlap(spark, root, snapshot_year, result, b_code, watched)
    result.observed_quality = watched.reports()
    result.seconds["silver"] = time.time() - t


class _Checks:
    """The quality checks of the silver tables, riding on their writes (Observation): counted in
    the same pass, so the gate needs no second scan."""

    def __init__(self, snapshot_year: int):
        self.checks = {
            "silver/medicare": checks_program_a(snapshot_year),
            "silver/medicaid": checks_program_b(snapshot_year),
            "silver/provider_overlap": checks_overlap(snapshot_year),
        }
        self.seen: dict[str, Observation] = {}

    def watch(self, key: str) -> dict:
        self.seen[key] = Observation(f"quality_{key.split('/')[1]}_{uuid.uuid4().hex[:6]}")
        return {"observe": self.seen[key], "observe_cols": check_metrics(self.checks[key])}

    def reports(self) -> dict[str, list[dict]]:
        return {key: report_from_metrics(obs.get, self.checks[key], key) for key, obs in self.seen.items()}


def _write_silver(spark: SparkSession, root: str, key: str, df: DataFrame, buckets: int, database: str, watched: _Checks) -> tuple[DataFrame, int]:
    """Write a silver table bucketed by provider and code; the table and its rows."""
    name = f"{database}.{key.split('/')[1]}"
    rows = write_bucketed(df, f"{root}/{key}", name, BUCKET_KEYS, buckets, **watched.watch(key))
    return spark.table(name), rows


def _write_overlap(spark: SparkSession, root: str, snapshot_year: int, result: RunResult, b_code: DataFrame, watched: _Checks) -> None:
    key = "silver/provider_overlap"
    overlap = provider_overlap(rollup_a_code(result.table(spark, "silver/medicare")), b_code, snapshot_year=snapshot_year)
    result.tables[key], result.row_counts[key] = write_and_read(overlap, f"{root}/{key}", **watched.watch(key))


def run_quality(spark: SparkSession, root: str, snapshot_year: int, result: RunResult, echo: bool) -> None:
    t = time.time()
    keys = ("silver/medicare", "silver/medicaid", "silver/provider_overlap")
    scans = dict(zip(keys, (quality_report_a, quality_report_b, quality_report_overlap)))
    report = []
    for key in keys:
        # counted while the table was written: no scan; else (an earlier run) one aggregation pass, one row per check
        seen = result.observed_quality.get(key)
        report += seen if seen is not None else [r.asDict() for r in scans[key](result.table(spark, key), snapshot_year).collect()]
    if not result.cast_failures:  # bronze written by an earlier run
        result.cast_failures = [r.asDict() for r in cast_failures(result.table(spark, "bronze/program_a")).collect()]
    for r in result.cast_failures if echo else ():
        print(f"{'bronze/program_a':28s} {r['column_name']:34s} {r['failed_casts']} of {r['non_null_inputs']} values are no {r['target_type']}")
    result.quality = enforce(report, echo=echo)
    result.seconds["quality"] = time.time() - t


def run_gold(
    spark: SparkSession, root: str, snapshot_year: int, result: RunResult, register: bool,
    risk: dict | None = None, compact: bool = False, b_totals: DataFrame | None = None,
) -> None:
    """The three marts.  Heavy peer groups are measured on the written overlap, and the risk join deals those over several
    tasks (or salts all groups, where ``risk`` names ``salt_buckets``): a hot peer group never is one task, whatever its size."""
    t = time.time()
    risk = dict(risk or {})
    exact = risk.pop("exact_quantile", False)
    quantile = {"quantile": risk["quantile"]} if "quantile" in risk else {}
    medicare, medicaid, overlap = (
        result.table(spark, f"silver/{n}") for n in ("medicare", "medicaid", "provider_overlap")
    )
    if "salt_buckets" not in risk:
        risk.setdefault("hot", hot_keys(overlap, PEER_KEYS))
    if register:  # once, before the concurrent writes register their tables
        spark.sql("CREATE SCHEMA IF NOT EXISTS gold")
    marts = {
        "agg_provider_spending": provider_spending(medicare, medicaid, snapshot_year, b_totals),
        "agg_specialty_utilization": specialty_utilization(medicare, snapshot_year),
        "fraud_risk_indicators": risk_indicators(overlap, peer_benchmarks(overlap, exact=exact, **quantile), snapshot_year=snapshot_year, **risk),
    }
    done = _concurrently(
        {
            f"gold/{name}": (
                lambda df=df, name=name: write_and_read(
                    df, f"{root}/gold/{name}", name=f"gold.{name}" if register else None
                )
            )
            for name, df in marts.items()
        }
    )
    for key, (table, rows) in done.items():
        result.tables[key], result.row_counts[key] = table, rows
        if compact:
            _compacted(spark, root, key, result)
    result.seconds["gold"] = time.time() - t


def run_reports(spark: SparkSession, root: str, result: RunResult, settings: dict[str, dict] | None = None) -> None:
    t = time.time()
    own = lambda name: (settings or {}).get(name, {})
    spending = result.table(spark, "gold/agg_provider_spending")
    utilization = result.table(spark, "gold/agg_specialty_utilization")
    risk = result.table(spark, "gold/fraud_risk_indicators")
    result.reports = {
        "report_highest_risk": reports.report_highest_risk(risk, **own("report_highest_risk")),
        "report_charge_gap": reports.report_charge_gap(utilization, **own("report_charge_gap")),
        "report_dual_billing": reports.report_dual_billing(spending, **own("report_dual_billing")),
        "report_state_reimbursement": reports.report_state_reimbursement(spending, **own("report_state_reimbursement")),
        "report_top_codes": reports.report_top_codes(risk, **own("report_top_codes")),
    }
    # Reports are small by construction (top-k or one row per state).
    done = _concurrently(
        {
            name: (lambda df=df, name=name: (None, write_table(df, f"{root}/reports/{name}")))
            for name, df in result.reports.items()
        }
    )
    for name, (_, rows) in done.items():
        result.row_counts[name] = rows
    result.seconds["reports"] = time.time() - t


STAGES = ("bronze", "silver", "quality", "gold", "reports")


def run_stages(
    spark: SparkSession,
    raw_a: DataFrame | None,
    raw_b: DataFrame | None,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
    root: str | None = None,
    register: bool = False,
    echo: bool = False,
    stages: tuple[str, ...] = STAGES,
    silver_buckets: int | None = None,
    database: str | None = None,
    risk: dict | None = None,
    report_settings: dict[str, dict] | None = None,
    compact: bool = False,
) -> RunResult:
    """Run the given stages in order (all by default).

    Every stage reads its inputs from ``root`` when an earlier stage of this
    call did not produce them, so each stage can be re-run on its own (the
    raw inputs are needed for ``bronze`` only).  The quality stage raises
    ``ValueError`` after all checks ran if a critical one failed, so gold is
    not built on data that failed the gate.

    ``silver_buckets`` is the number of buckets of the two silver tables (1 to 100,000; by default the bytes of the larger bronze
    table over the size of a file, at least one per core: :func:`bucket_count`); they
    are catalog tables of ``database`` (default: a name made from the whole root).

    ``risk``: arguments of ``risk_indicators`` (``charge_factor``, ``spend_threshold``, ``quantile``, ``salt_buckets``), and
    ``exact_quantile=True`` for an exact benchmark quantile in groups of any size;
    ``report_settings``: arguments by report (e.g. ``{"report_dual_billing": {"min_providers": 20}}``);
    ``compact``: rewrite the bronze and gold tables as files of the target size after their writes.
    Casts of program A that fail are counted in ``result.cast_failures``, while bronze is written or else by the quality stage.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; choose from {STAGES}")
    root = root or default_root(spark)
    if silver_buckets is not None and not 1 <= silver_buckets <= MOST_BUCKETS:
        raise ValueError(f"silver_buckets must be between 1 and {MOST_BUCKETS}, not {silver_buckets}")
    result = RunResult(root=root, database=database or silver_database(root))
    if "bronze" in stages:
        if raw_a is None or raw_b is None:
            raise ValueError("the bronze stage needs both raw inputs")
        run_bronze(spark, raw_a, raw_b, root, result, compact)
    if "silver" in stages:
        run_silver(spark, root, snapshot_year, result, silver_buckets, result.database)
    if "quality" in stages:
        run_quality(spark, root, snapshot_year, result, echo)
    if "gold" in stages:
        run_gold(spark, root, snapshot_year, result, register, risk, compact)
    if "reports" in stages:
        run_reports(spark, root, result, report_settings)
    return result


def reload_months(
    spark: SparkSession,
    raw_b: DataFrame,
    months: Sequence[str],
    root: str,
    snapshot_year: int = S.DEFAULT_SNAPSHOT_YEAR,
    register: bool = False,
    echo: bool = False,
    totals_parts: int = 64,
    risk: dict | None = None,
    report_settings: dict[str, dict] | None = None,
) -> RunResult:
    """Take months of program B anew into a finished run at ``root``, and bring everything behind them up to date.

    Only these months' raw rows are read: their bronze partitions are replaced, their rollup enters the monthly totals kept under
    ``silver/medicaid_totals`` (made from all of bronze the first time), and the overlap, the gate, the marts and the reports follow from those.
    Program A and the other months are not read again below silver.  The result equals a full run on the corrected input.
    """
    result = RunResult(root=root, database=silver_database(root))
    t = time.time()
    bronze = f"{root}/bronze/program_b"
    mine = raw_b.where(F.col(S.B_MONTH).isin(list(months)))
    result.row_counts["bronze/program_b"] = replace_partitions(mine, bronze, S.B_MONTH, months)
    result.tables["bronze/program_b"] = read_table(spark, bronze, schema=raw_b.schema)
    result.seconds["bronze"] = time.time() - t

    t = time.time()
    totals = MonthlyTotals(spark, f"{root}/silver/medicaid_totals", snapshot_year, totals_parts)
    totals.load(result.tables["bronze/program_b"], months if totals.loaded() else totals.months)
    watched = _Checks(snapshot_year)
    buckets = bucket_count(spark, root)
    name = "silver/medicaid"
    result.tables[name], result.row_counts[name] = _write_silver(spark, root, name, totals.monthly(), buckets, result.database, watched)
    _write_overlap(spark, root, snapshot_year, result, totals.code_rollup(), watched)
    result.observed_quality = watched.reports()
    result.seconds["silver"] = time.time() - t

    run_quality(spark, root, snapshot_year, result, echo)
    run_gold(spark, root, snapshot_year, result, register, risk, b_totals=totals.provider_rollup())
    run_reports(spark, root, result, report_settings)
    return result
