"""Steps that name their own number of tasks: the same rows, and tasks that do not grow with the input."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from peerlens.plans.layers import Layers
from peerlens.session import checkpoint_dir
from peerlens.sources import pages as P
from peerlens.sources.fixtures import program_a_raw
from peerlens.sources.paged import landed_fetch
from tests.conftest import SF_SMOKE

NUMBERS = ["Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt", "Avg_Mdcr_Stdzd_Amt"]


def _rows(df, digits=2):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def _feed(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), "id").alias("id"), F.col("id").cast("string").alias("n"))


KIND = "id string, n string"


def test_program_a_is_dealt_by_its_lines(spark):
    settled = lambda df: _rows(df.withColumns({c: F.col(c).cast("double") for c in NUMBERS}))
    sized = program_a_raw(spark, SF_SMOKE, False, each=300)
    assert sized.rdd.getNumPartitions() == 20  # 6,000 lines; the session has 8
    assert settled(sized) == settled(program_a_raw(spark, SF_SMOKE, False))


@pytest.mark.parametrize("table", ["a_code", "spending"])
def test_rollups_by_provider_are_dealt_by_the_lines(spark, table):
    plain, sized = Layers(spark, SF_SMOKE), Layers(spark, SF_SMOKE)
    assert plain.parts is None
    sized.parts = 20
    got, want = (getattr(x, table).drop("_transformed_at") for x in (sized, plain))
    assert sized.a_code.rdd.getNumPartitions() == 20
    assert _rows(got) == _rows(want)


def test_landed_envelopes_are_dealt_and_compressed(spark, scratch, monkeypatch):
    monkeypatch.setattr(P, "FEED_ROWS_PER_TASK", 2)
    before = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/peerlens-positions-*"))
    assert P.land_envelopes(_feed(spark, 101), scratch, 5) == 101
    files = glob.glob(f"{scratch}/part-*")
    assert len(files) > 8 and all(f.endswith(".json.gz") for f in files)
    assert set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/peerlens-positions-*")) == before  # the staged rows are gone
    from pyspark.sql.types import StructType

    pages = P.read_envelopes(spark, scratch, StructType.fromDDL(KIND))
    assert {r.page_offset: r.row_count for r in P.envelope_audit(pages, 5).collect()} == {o: min(5, 101 - o) for o in range(0, 101, 5)}
    assert _rows(P.envelope_rows(pages, None).drop(P.PAGE_COL)) == _rows(_feed(spark, 101))


def test_landed_page_files_are_dealt_and_compressed(spark, scratch, monkeypatch):
    monkeypatch.setattr(P, "FEED_ROWS_PER_TASK", 2)
    assert P.land_pages(_feed(spark, 23), f"{scratch}/pages", 5) == 23
    files = glob.glob(f"{scratch}/pages/*/part-*")
    assert len(files) == 5 and all(f.endswith(".json.gz") for f in files)
    fetch = landed_fetch(f"{scratch}/pages", 5)
    assert sorted(r["id"] for o in range(0, 25, 5) for r in fetch(o, 5)) == sorted(f"r{i}" for i in range(23))


@pytest.mark.parametrize("sent", [0, 100])
def test_latest_envelopes_by_both_joins(spark, monkeypatch, sent):
    monkeypatch.setattr(P, "MOST_PAGES_SENT", sent)
    kinds = "_page_offset bigint, rows array<struct<id:string,n:string>>, _landed_at int, _page_file string, b int"
    pages = [(o, [(f"r{o}", str(v))], None if v == 0 else v, "xy"[v % 2], v) for o in range(0, 200, 5) for v in range(3)]
    kept = P.latest_envelopes(spark.createDataFrame([*pages, (None, [], 1, "x", 9)], kinds))
    assert sorted(r["_page_offset"] for r in kept.collect()) == list(range(0, 200, 5))
    assert {r["_landed_at"] for r in kept.collect()} == {2}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert ("REPARTITION_BY_NUM" in plan) == (sent == 0)
    by_batch = P.latest_envelopes(spark.createDataFrame([(0, None, 7, "x", 1), (0, None, None, None, 2)], kinds), "b")
    assert [r["b"] for r in by_batch.collect()] == [2]


def test_an_audit_reads_the_feed_once(spark, scratch):
    feed = _feed(spark, 12).withColumn(P.PAGE_COL, (F.floor(F.substring("id", 2, 9).cast("int") / 5) * 5).cast("bigint"))
    feed.write.parquet(f"{scratch}/feed")
    audit = P.page_audit(spark.read.parquet(f"{scratch}/feed"), 5)
    shutil.rmtree(f"{scratch}/feed")
    assert {r.page_offset: r.status for r in audit.collect()} == {0: "ok", 5: "ok", 10: "last"}
    assert not os.path.exists(f"{scratch}/feed")


def test_positions_are_found_without_a_shuffle_of_the_rows(spark):
    plan = P.with_row_positions(spark.range(0, 1000, numPartitions=7))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
