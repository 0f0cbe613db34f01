"""Hand-made rows for the semantics that decide whether results match."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.operators.clean import cast_failures, rename_cast
from peerlens.operators.marts import peer_benchmarks, provider_spending, risk_indicators
from peerlens.operators.overlap import provider_overlap
from peerlens.operators.quality import (
    Check,
    at_least,
    enforce,
    quality_report_a,
    quality_report_b,
    run_checks,
)
from peerlens.operators.rollup import rollup_a_code, rollup_b_code, rollup_b_monthly
from peerlens.plans import reports


def raw_a_rows(spark, rows):
    """rows: dicts with clean-ish keys; missing raw fields are null."""
    names = [raw for raw, _, _ in S.PROGRAM_A_COLUMNS]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, S.PROGRAM_A_RAW)


def a_row(npi="1000000001", code="C1", desc="desc C1", spec="S1", state="ST", place="F", **measures):
    r = {
        "Rndrng_NPI": npi,
        "HCPCS_Cd": code,
        "HCPCS_Desc": desc,
        "Rndrng_Prvdr_Type": spec,
        "Rndrng_Prvdr_State_Abrvtn": state,
        "Place_Of_Srvc": place,
        "Tot_Benes": "1",
        "Tot_Srvcs": "1",
        "Avg_Sbmtd_Chrg": "10",
        "Avg_Mdcr_Pymt_Amt": "5",
    }
    r.update(measures)
    return r


def raw_b_rows(spark, rows):
    return spark.createDataFrame(rows, S.PROGRAM_B_RAW)


def b_row(npi="1000000001", code="C1", month="2022-01", paid=1.0, patients=1, lines=1, serv="9"):
    return (npi, serv, code, month, patients, lines, paid)


OVERLAP_SCHEMA = T.StructType(
    [
        T.StructField("provider_npi", T.StringType()),
        T.StructField("hcpcs_code", T.StringType()),
        T.StructField("hcpcs_description", T.StringType()),
        T.StructField("provider_specialty", T.StringType()),
        T.StructField("provider_state", T.StringType()),
        T.StructField("medicare_total_services", T.DoubleType()),
        T.StructField("medicare_avg_submitted_charge", T.DoubleType()),
        T.StructField("medicare_avg_payment_amt", T.DoubleType()),
        T.StructField("medicaid_total_paid", T.DoubleType()),
        T.StructField("medicaid_total_patients", T.LongType()),
        T.StructField("medicaid_months_billed", T.LongType()),
    ]
)


def overlap_rows(spark, rows):
    """rows: (npi, specialty, services, charge, paid) on code C1."""
    data = [(n, "C1", "d", s, "ST", float(sv), float(ch), 1.0, float(pd), 1, 1) for n, s, sv, ch, pd in rows]
    return spark.createDataFrame(data, OVERLAP_SCHEMA)


# --- P2 / D2: unparseable numbers -----------------------------------------
def test_bad_numbers_become_null_and_are_counted(spark):
    raw = raw_a_rows(
        spark,
        [a_row(npi=f"100000000{i}", Tot_Srvcs=v, Tot_Benes=b) for i, (v, b) in
         enumerate([("*", "1"), ("1,234", "2"), ("", "3"), ("12.0", "12.0")])],
    )
    clean = {r.provider_npi: r for r in rename_cast(raw).collect()}
    assert clean["1000000000"].total_services is None
    assert clean["1000000001"].total_services is None
    assert clean["1000000002"].total_services is None
    assert clean["1000000003"].total_services == 12.0
    assert clean["1000000003"].total_beneficiaries is None  # '12.0' is not an int
    report = {r.column_name: r for r in cast_failures(raw).collect()}
    assert report["total_services"].failed_casts == 3
    assert report["total_services"].non_null_inputs == 4
    assert report["total_beneficiaries"].failed_casts == 1


# --- P7: null keys --------------------------------------------------------
def test_null_keys_dropped(spark):
    raw = raw_a_rows(spark, [a_row(npi=None), a_row(code=None), a_row()])
    assert rename_cast(raw).count() == 1
    b = raw_b_rows(spark, [b_row(npi=None), b_row(code=None), b_row()])
    assert rollup_b_monthly(b, 2022).count() == 1


# --- P8: month edges --------------------------------------------------------
def test_month_edges(spark):
    months = ["2021-12", "2022-01", "2022-12", "2022-12-31", "2022-1", None]
    b = raw_b_rows(spark, [b_row(month=m) for m in months])
    kept = sorted(r.claim_month for r in rollup_b_monthly(b, 2022).collect())
    assert kept == ["2022-01", "2022-1", "2022-12"]


# --- G1: servicing providers collapse ------------------------------------------
def test_servicing_split_summed(spark):
    b = raw_b_rows(spark, [b_row(serv="1", paid=2.5, patients=3), b_row(serv="2", paid=1.5, patients=4)])
    rows = rollup_b_monthly(b, 2022).collect()
    assert len(rows) == 1
    assert rows[0].total_paid == 4.0 and rows[0].total_patients == 7 and rows[0].claim_year == 2022


# --- C3 / D1 / C1: quality gate ---------------------------------------------------
def test_reversal_reported_not_blocking(spark):
    b = raw_b_rows(spark, [b_row(paid=-5.0), b_row(code="C2")])
    report = quality_report_b(rollup_b_monthly(b, 2022), 2022)
    by = {r.check_name: r for r in report.collect()}
    assert by["total_paid >= 0"].violations == 1 and not by["total_paid >= 0"].critical
    enforce(report, echo=False)  # non-critical: no exception


def test_null_measure_passes_but_is_unknown(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "x double")
    rows = run_checks(df, [Check("x >= 0", at_least("x", 0))], "t").collect()
    assert rows[0].violations == 1 and rows[0].unknown_count == 1 and rows[0].row_count == 3
    strict = run_checks(df, [Check("x >= 0", at_least("x", 0))], "t", nulls="fail").collect()
    assert strict[0].violations == 2


def test_critical_failure_raises_after_all_checks(spark):
    raw = raw_a_rows(spark, [a_row(npi="123456789"), a_row(Avg_Sbmtd_Chrg="-1")])
    report = quality_report_a(rename_cast(raw, snapshot_year=2022), 2022)
    rows = report.collect()
    assert len(rows) == 7  # every check evaluated
    with pytest.raises(ValueError) as err:
        enforce(report, echo=False)
    assert "provider_npi is 10 digits" in str(err.value)
    assert "avg_submitted_charge >= 0" in str(err.value)


# --- D4: two descriptions ---------------------------------------------------------
def test_two_descriptions_repeat_b_totals(spark):
    a = rename_cast(raw_a_rows(spark, [a_row(desc="one"), a_row(desc="two")]))
    b = rollup_b_monthly(raw_b_rows(spark, [b_row(paid=7.0)]), 2022)
    ov = provider_overlap(rollup_a_code(a), rollup_b_code(b)).collect()
    assert sorted(r.hcpcs_description for r in ov) == ["one", "two"]
    assert all(r.medicaid_total_paid == 7.0 for r in ov)
    one = provider_overlap(rollup_a_code(a, by_description=False), rollup_b_code(b)).collect()
    assert len(one) == 1 and one[0].hcpcs_description == "one"


# --- D3: deterministic representative -----------------------------------------------
def test_representative_is_deterministic(spark):
    rows = [
        a_row(place="A", spec=None, state="ZZ"),
        a_row(place="B", spec="S2", state="NY"),
        a_row(place="C", spec="S1", state="TX"),
        a_row(place="D", spec="S1", state="CA"),
    ]
    results = set()
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        for parts in (1, 3):
            a = rename_cast(raw_a_rows(spark, perm).repartition(parts))
            r = rollup_a_code(a).collect()
            assert len(r) == 1
            results.add((r[0].provider_specialty, r[0].provider_state))
            s = provider_spending(a, rollup_b_monthly(raw_b_rows(spark, [b_row()]), 2022)).collect()
            results.add((s[0].provider_specialty, s[0].provider_state))
    assert results == {("S1", "CA")}  # non-null first, then smallest; same row for both


# --- D5: null specialty ---------------------------------------------------------------
def test_null_specialty_has_no_benchmark(spark):
    ov = overlap_rows(spark, [("1", None, 5, 100, 60000), ("2", None, 1, 1, 1)])
    r = {x.provider_npi: x for x in risk_indicators(ov).collect()}
    assert r["1"].charge_ratio_vs_specialty is None
    assert r["1"].specialty_avg_submitted_charge is None
    assert not r["1"].high_volume_flag and not r["1"].high_charge_flag
    assert r["1"].high_medicaid_spend_flag and r["1"].risk_score == 1


# --- D6: small peer groups ------------------------------------------------------------
def test_charge_flag_needs_three_rows(spark):
    groups = {"G1": [1], "G2": [1, 9], "G3": [1, 1, 9]}
    rows = [(f"{g}-{i}", g, 1, c, 0) for g, cs in groups.items() for i, c in enumerate(cs)]
    flagged = {x.provider_npi for x in risk_indicators(overlap_rows(spark, rows)).collect() if x.high_charge_flag}
    assert flagged == {"G3-2"}


@pytest.mark.parametrize("n,expected", [(19, set()), (20, {20})])
def test_volume_flag_group_size(spark, n, expected):
    rows = [(str(i), "S", i, 1, 0) for i in range(1, n + 1)]
    flagged = {int(x.provider_npi) for x in risk_indicators(overlap_rows(spark, rows)).collect() if x.high_volume_flag}
    assert flagged == expected


def test_stddev_null_for_single_row_group(spark):
    bench = peer_benchmarks(overlap_rows(spark, [("1", "S", 1, 5, 0)])).collect()
    assert bench[0].specialty_stddev_submitted_charge is None


# --- R1 / R4: zero benchmark, threshold edge --------------------------------------------
def test_zero_benchmark_ratio_is_null(spark):
    r = risk_indicators(overlap_rows(spark, [("1", "S", 1, 0, 0), ("2", "S", 1, 0, 0)])).collect()
    assert all(x.charge_ratio_vs_specialty is None for x in r)


def test_spend_threshold_is_strict(spark):
    r = {x.provider_npi: x for x in risk_indicators(
        overlap_rows(spark, [("1", "S", 1, 1, 50000.00), ("2", "S", 1, 1, 50000.01)])).collect()}
    assert not r["1"].high_medicaid_spend_flag and r["2"].high_medicaid_spend_flag


# --- J2 / J3: A only ------------------------------------------------------------------------
def test_a_only_provider_kept(spark):
    a = rename_cast(raw_a_rows(spark, [a_row(npi="1000000001"), a_row(npi="1000000002")]))
    b = rollup_b_monthly(raw_b_rows(spark, [b_row(npi="1000000001")]), 2022)
    r = {x.provider_npi: x for x in provider_spending(a, b).collect()}
    assert r["1000000002"].medicaid_total_paid is None and not r["1000000002"].bills_both_programs
    assert r["1000000001"].bills_both_programs


# --- T1-T4: ties at the limit ---------------------------------------------------------------
def test_ties_at_limit_are_stable(spark):
    rows = [(f"{i:03d}", "S", 1, 10, 60000) for i in range(60)]  # all tie on the ratio
    ov = overlap_rows(spark, rows)
    risk = risk_indicators(ov, charge_factor=0.5).withColumn("risk_score", F.lit(3))
    picks = set()
    for parts in (1, 4, 7):
        picks.add(tuple(r.provider_npi for r in reports.report_highest_risk(risk.repartition(parts)).collect()))
    assert len(picks) == 1 and len(next(iter(picks))) == 50
    assert next(iter(picks))[0] == "000"


# --- skew: a salted join gives the same rows as the plain one ------------------------------
def test_salted_risk_join_equals_plain(spark):
    rows = [(str(i), "HOT" if i % 3 else f"S{i % 7}", i % 40, 10 + i % 13, 1000.0 * i) for i in range(300)]
    rows.append(("x", None, 5, 5, 5))
    ov = overlap_rows(spark, rows)
    plain = sorted(tuple(r) for r in risk_indicators(ov).collect())
    salted = sorted(tuple(r) for r in risk_indicators(ov, salt_buckets=8).collect())
    assert plain == salted and len(plain) == 301


def test_salted_join_inner_and_validation(spark):
    from peerlens.operators.joins import salted_join

    big = spark.createDataFrame([(k, i) for i in range(100) for k in ("a", "a", "b")], "k string, v int")
    small = spark.createDataFrame([("a", 1.0), ("c", 3.0)], "k string, w double")
    assert salted_join(big, small, ["k"], "inner", buckets=5).count() == 200
    assert salted_join(big, small, ["k"], "left", buckets=5).count() == 300
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], "right")


def test_sized_settings():
    from peerlens.session import sized_settings

    tb = 1024**4
    conf = sized_settings(8 * tb, total_cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == str(65536)
    assert sized_settings(10 * 1024**2, total_cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_hot_peer_group_on_sort_merge_path(spark):
    """One peer group with most rows, benchmark not broadcast: plain and salted joins agree."""
    rows = [(f"h{i}", "HOT", i % 50, 10 + i % 17, 100.0 * i) for i in range(3000)]
    rows += [(f"c{i}", f"S{i % 40}", i % 9, 5 + i % 11, 10.0 * i) for i in range(1000)]
    ov = overlap_rows(spark, rows).repartition(8)
    expected = sorted(tuple(r) for r in risk_indicators(ov).collect())
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = risk_indicators(ov)
        got = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
        salted = risk_indicators(ov, salt_buckets=16)
        got_salted = sorted(tuple(r) for r in salted.collect())
        salted_plan = salted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected == got_salted and len(got) == 4000
    assert "SortMergeJoin" in plan and "SortMergeJoin" in salted_plan  # not the broadcast path
