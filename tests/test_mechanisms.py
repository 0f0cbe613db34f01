"""Exact quantiles, mergeable states, monthly totals, quarantine, heavy keys, schema drift."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from peerlens import schemas as S
from peerlens.operators import quarantine
from peerlens.operators.drift import drift_report, read_lines
from peerlens.operators.hot_keys import hot_keys, spread_join
from peerlens.operators.incremental import MonthlyTotals
from peerlens.operators.marts import PEER_KEYS, peer_benchmarks, risk_indicators
from peerlens.operators.quantile import exact_group_quantile
from peerlens.operators.rollup import rollup_b_code, rollup_b_monthly
from peerlens.operators.states import MergeableRollup
from peerlens.plans.layers import FIXTURE_SNAPSHOT_YEAR, Layers
from peerlens.sources.fixtures import program_a_raw, program_b_raw, soiled_program_a
from tests.conftest import SF_SMOKE


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- exact quantiles --------------------------------------------------------
def _disc(values, q):
    values = sorted(v for v in values if v is not None)
    return values[math.ceil(round(q * len(values), 9)) - 1] if values else None


@pytest.mark.parametrize("q", [0.95, 0.5, 0.001, 1.0])
def test_exact_quantile_equals_sorting(spark, q):
    rng = random.Random(2)
    groups = {
        "uniform": [rng.random() for _ in range(3000)],
        "tied": [float(rng.choice([1, 2, 2, 2, 7])) for _ in range(2500)],
        "one value": [5.0] * 2000,
        "spread": [10.0 ** rng.uniform(-300, 300) for _ in range(2000)],
        "hot end": [0.0] * 1890 + [1.0 + i for i in range(110)],
        "small": [3.0, 1.0, 2.0],
        "single": [4.0],
        "nulls": [None, None],
        None: [float(i) for i in range(700)] + [None] * 50,
        "signs": [(-1) ** i * float(i) for i in range(1200)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: (r["rows"], r.quantile) for r in exact_group_quantile(df, ["g"], "v", q, accuracy=100, buckets=3).collect()}
    assert got == {g: (sum(v is not None for v in vs), _disc(vs, q)) for g, vs in groups.items()}


def test_exact_quantile_of_a_group_beyond_the_accuracy(spark):
    df = spark.range(0, 60_000, numPartitions=6).select(F.lit("a").alias("k"), F.lit(None).cast("int").alias("j"), (F.col("id") * 7919 % 60_000).alias("v"))
    row, = exact_group_quantile(df, ["k", "j"], "v").collect()
    assert tuple(row) == ("a", None, 60_000, 56_999)
    assert exact_group_quantile(df.limit(0), ["k"], "v").collect() == []
    with pytest.raises(ValueError, match="above 0"):
        exact_group_quantile(df, ["k"], "v", 0)


def test_exact_benchmarks_equal_the_sketch_on_small_groups(spark):
    overlap = Layers(spark, SF_SMOKE).overlap_table
    cols = [*PEER_KEYS, "specialty_p95_services"]
    assert _rows(peer_benchmarks(overlap, exact=True, accuracy=4).select(*cols)) == _rows(peer_benchmarks(overlap).select(*cols))


# --- states -----------------------------------------------------------------
def test_states_merge_in_any_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("xyz"), rng.randint(0, 40), rng.choice([None, 1.5, 2.0, 10.0]), f"p{rng.randint(0, 300)}") for _ in range(4000)]
    rows += [("a", "w", None, None, None), ("c", "w", None, None, None)]
    df = spark.createDataFrame(rows, "g string, h string, n int, v double, p string").repartition(5)
    rollup = MergeableRollup(sums={"n": "n"}, means={"mean": "v"}, distinct={"people": "p"})
    fine = rollup.states(df, ["g", "h"])
    once = rollup.values(rollup.merged(fine, ["g"]), ["g"])
    parts = [rollup.states(part, ["g", "h"]) for part in df.randomSplit([1.0, 2.0, 1.0], 4)]
    many = rollup.merged(rollup.merged(parts[0].union(parts[1]), ["g", "h"]).union(parts[2]), ["g"])
    direct = df.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.avg("v").alias("mean"), F.count_distinct("p").alias("people"))
    assert _rows(once) == _rows(rollup.values(many, ["g"])) == _rows(direct.select("g", "rows", "n", "mean", "people"))


def test_sketch_error_is_as_stated(spark):
    rollup = MergeableRollup(distinct={"ids": "id"}, lg_k=10)
    df = spark.range(200_000).withColumn("g", F.col("id") % 8)
    est = rollup.values(rollup.merged(rollup.states(df, ["g"]), []), []).first().ids
    assert abs(est - 200_000) <= rollup.error() * 200_000
    exact = MergeableRollup(distinct={"ids": "id"}, lg_k=18)
    assert exact.values(exact.merged(exact.states(df, ["g"]), []), []).first().ids == 200_000
    assert df.count() < 2**18 and exact.error() < 0.006


# --- monthly totals ---------------------------------------------------------
def _same_code_rollup(totals, raw):
    want = rollup_b_code(rollup_b_monthly(raw, FIXTURE_SNAPSHOT_YEAR))
    cols = ["provider_npi", "hcpcs_code", "medicaid_total_patients", "medicaid_total_claim_lines", "medicaid_months_billed", F.round("medicaid_total_paid", 4)]
    assert _rows(totals.code_rollup().select(*cols)) == _rows(want.select(*cols))
    assert totals.code_rollup().dtypes == want.dtypes and totals.consistent()


def test_monthly_totals_equal_a_full_run(spark, scratch):
    raw = program_b_raw(spark, SF_SMOKE).where(F.col(S.B_MONTH).startswith(str(FIXTURE_SNAPSHOT_YEAR)))
    raw.write.parquet(f"{scratch}/raw")
    raw = spark.read.parquet(f"{scratch}/raw")
    totals = MonthlyTotals(spark, f"{scratch}/t", FIXTURE_SNAPSHOT_YEAR, parts=8)
    month = lambda m: F.col(S.B_MONTH) == f"{FIXTURE_SNAPSHOT_YEAR}-{m:02d}"
    assert totals.consistent() and totals.code_rollup().count() == 0
    first = raw.where(~month(3) & ~month(4)).withColumn(S.B_PAID, F.when(month(2), F.col(S.B_PAID) * 2 + 0.01).otherwise(F.col(S.B_PAID)))
    totals.load(first, [m for m in totals.months if m[-2:] not in ("03", "04")])
    _same_code_rollup(totals, first)
    totals.load(raw, [f"{FIXTURE_SNAPSHOT_YEAR}-02"])  # corrected
    totals.load(raw, [f"{FIXTURE_SNAPSHOT_YEAR}-03", f"{FIXTURE_SNAPSHOT_YEAR}-04"])  # appended
    _same_code_rollup(totals, raw)
    totals.load(raw, [f"{FIXTURE_SNAPSHOT_YEAR}-05"])  # repeated: nothing changes
    _same_code_rollup(totals, raw)
    providers = totals.provider_rollup()
    monthly = rollup_b_monthly(raw, FIXTURE_SNAPSHOT_YEAR)
    want = monthly.groupBy("provider_npi").agg(F.count_distinct("hcpcs_code"), F.count_distinct("claim_month"), F.sum("total_patients"))
    assert _rows(providers.select("provider_npi", "medicaid_distinct_hcpcs_count", "medicaid_months_active", "medicaid_total_patients")) == _rows(want)
    totals.load(raw.where(~month(6)), [f"{FIXTURE_SNAPSHOT_YEAR}-06"])  # emptied
    _same_code_rollup(totals, raw.where(~month(6)))
    with pytest.raises(ValueError, match="not of the year"):
        totals.load(raw, ["1997-01"])


def test_broken_load_is_mended_by_the_next(spark, scratch, monkeypatch):
    from peerlens.operators import incremental

    rows = [("p1", "s", "c1", "1998-01", 1, 1, 10.0), ("p2", "s", "c1", "1998-01", 1, 1, 5.5), ("p1", "s", "c1", "1998-02", 2, 1, 1.25)]
    raw = spark.createDataFrame(rows, S.PROGRAM_B_RAW)
    totals = MonthlyTotals(spark, scratch, FIXTURE_SNAPSHOT_YEAR, parts=4)
    totals.load(raw, ["1998-01", "1998-02"])
    more = spark.createDataFrame([("p3", "s", "c2", "1998-02", 4, 1, 7.0)], S.PROGRAM_B_RAW)
    real = incremental.replace_partitions

    def fail(df, path, by, values):
        if by == "claim_month":
            raise OSError("lost")
        return real(df, path, by, values)

    monkeypatch.setattr(incremental, "replace_partitions", fail)
    with pytest.raises(OSError):
        totals.load(more, ["1998-02"])
    assert not totals.consistent()
    monkeypatch.setattr(incremental, "replace_partitions", real)
    totals.load(more, ["1998-02"])
    _same_code_rollup(totals, raw.where(f"{S.B_MONTH} = '1998-01'").union(more))


# --- quarantine -------------------------------------------------------------
def test_every_row_is_clean_or_quarantined(spark, scratch):
    raw = soiled_program_a(program_a_raw(spark, SF_SMOKE))
    rows = quarantine.with_faults(raw, FIXTURE_SNAPSHOT_YEAR)
    clean, bad, counts = quarantine.split_rows(rows, f"{scratch}/q")
    assert counts["clean"] + counts["quarantined"] == counts["rows"] == raw.count()
    assert clean.count() == counts["clean"] and bad.count() == counts["quarantined"] > 0
    assert clean.where("total_services < 0 OR length(provider_npi) <> 10 OR hcpcs_code IS NULL").count() == 0
    stars = bad.where(F.array_contains("_faults", "cast: total_services"))
    assert stars.count() == raw.where("Tot_Srvcs = '*'").count() and {r[0] for r in stars.select("_raw.Tot_Srvcs").collect()} == {"*"}
    told = {r.fault: r["rows"] for r in quarantine.fault_counts(bad).collect()}
    assert told["key: provider_npi"] == raw.where("Rndrng_NPI IS NULL").count()
    assert told["check: provider_npi is 10 digits"] == raw.where("length(Rndrng_NPI) <> 10").count()


def test_malformed_lines_are_quarantined(spark, scratch):
    good = {"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1", "Tot_Srvcs": "2"}
    with open(f"{scratch}/page.json", "w") as fh:
        fh.write(json.dumps(good) + '\n{"Rndrng_NPI": "10000\n' + json.dumps(good | {"Tot_Srvcs": "x", "HCPCS_Cd": None}) + "\n")
    rows = quarantine.with_faults(quarantine.read_pages_permissively(spark, scratch), FIXTURE_SNAPSHOT_YEAR)
    clean, bad, counts = quarantine.split_rows(rows, f"{scratch}-out")
    assert counts == {"clean": 1, "quarantined": 2, "rows": 3}
    faults = sorted(r["_faults"] for r in bad.collect())
    assert faults == [["cast: total_services", "key: hcpcs_code"], ["page: malformed"]]
    told = bad.where("array_contains(_faults, 'page: malformed')").first()
    assert told["_raw"]["_corrupt_record"].startswith('{"Rndrng_NPI": "10000')


def test_unknown_checks_pass_unless_asked(spark):
    raw = spark.createDataFrame([("1000000001", "C1", None)], "Rndrng_NPI string, HCPCS_Cd string, Tot_Srvcs string")
    for c, _, _ in S.PROGRAM_A_COLUMNS:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    assert quarantine.with_faults(raw, 1998).first()["_faults"] == []
    assert "check: total_services >= 0" in quarantine.with_faults(raw, 1998, nulls="fail").first()["_faults"]


# --- heavy keys -------------------------------------------------------------
def _skewed(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 20_000))
    return spark.range(0, n, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"))


def test_heavy_keys_are_found_and_spread(spark):
    df = _skewed(spark)
    hot = hot_keys(df, ["k"])
    h = df.where("k = 'hot'").select(F.xxhash64("k")).first()[0]
    assert set(hot) == {h} and abs(hot[h] - 1 / 3) < 0.01
    small = df.select("k").distinct().withColumn("w", F.length("k"))
    joined = spread_join(df, small, ["k"], hot=hot, tasks=8)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k in kept:
            spark.conf.set(k, "-1" if "Threshold" in k else "false")
        plain, spread = df.join(small, ["k"], "left"), spread_join(df, small, ["k"], hot=hot, tasks=8)
        assert _rows(spread.select("k", "v", "w")) == _rows(plain.select("k", "v", "w"))

        def sizes(j):
            return sorted(r.n for r in j.groupBy(F.spark_partition_id()).agg(F.count("w").alias("n")).collect())

        even, uneven = sizes(spread), sizes(plain)
        assert uneven[-1] > 3 * uneven[len(uneven) // 2]
        assert even[-1] <= 3 * even[len(even) // 2]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert joined.columns == ["k", "v", "w"]
    # the small side is copied for the heavy key alone
    copies = math.ceil(hot[h] * 8 * 8)
    assert spread_join(small, small.limit(0), ["k"], hot=hot, tasks=8).count() == small.count()
    assert copies > 16


def test_no_heavy_key_no_change(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    few = df.withColumn("k", F.col("k") % 4)
    assert len(hot_keys(few, ["k"])) == 4 and hot_keys(few.limit(900), ["k"]) == {}
    assert hot_keys(df, ["k"]) == {} and hot_keys(df.limit(0), ["k"]) == {}
    nulls = df.withColumn("k", F.when(F.col("k") % 2 == 0, F.col("k")))
    assert hot_keys(nulls, ["k"]) == {}
    plain = spread_join(nulls, df.withColumnRenamed("v", "w"), ["k"], "inner")
    assert plain.count() == 2500
    with pytest.raises(ValueError, match="entries at least"):
        hot_keys(df, ["k"], share=0.0001)
    with pytest.raises(ValueError, match="inner"):
        spread_join(df, df, ["k"], "full")


def test_risk_with_measured_keys_equals_plain(spark):
    overlap = Layers(spark, SF_SMOKE).overlap_table
    hot = hot_keys(overlap, PEER_KEYS, share=0.01, least=1)
    assert hot
    assert _rows(risk_indicators(overlap, hot=hot)) == _rows(risk_indicators(overlap))


# --- drift ------------------------------------------------------------------
def test_drift_tells_every_kind(spark, scratch):
    schema = "a string, b string, c int, d double, e string, f boolean"
    lines = [
        {"a": "x", "b": 5, "c": 1, "d": 1, "z": {"q": 1}}, {"a": "y", "b": "t", "c": 2, "d": 1.5, "e": "only here"},
        {"a": None, "c": 3, "d": 2.25, "z": [1]}, {"a": "v", "b": True, "c": 4, "d": 1e300},
    ]
    with open(f"{scratch}/p.json", "w") as fh:
        fh.write("\n".join(map(json.dumps, lines)) + "\n\nnot json\n[1]\n")
    from pyspark.sql import types as T

    got = {r.field: tuple(r)[1:] for r in drift_report(read_lines(spark, scratch), T.StructType.fromDDL(schema)).collect()}
    assert got == {
        "a": ("string", "STRING", 4, 6, "partly missing"),
        "b": ("string", "BIGINT+BOOLEAN+STRING", 3, 6, "retyped"),
        "c": ("int", "BIGINT", 4, 6, "partly missing"),
        "d": ("double", "BIGINT+DECIMAL+DOUBLE", 4, 6, "partly missing"),
        "e": ("string", "STRING", 1, 6, "partly missing"),
        "f": ("boolean", "", 0, 6, "missing"),
        "z": (None, "ARRAY+OBJECT", 2, 6, "unknown"),
    }
