"""Paged feed: landing, parallel read, page audit, incremental availableNow stream."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.sources.pages import (
    land_pages,
    landed_pages,
    page_audit,
    read_page_files,
    require_complete,
    with_row_positions,
)
from peerlens.streaming.pages import stream_page_files


def _raw(spark, n):
    rows = [(f"{1000000000 + i}", f"C{i % 3}", str(i)) for i in range(n)]
    return spark.createDataFrame(rows, "Rndrng_NPI string, HCPCS_Cd string, Tot_Srvcs string")


def _write_page(folder, offset, records, as_array=False):
    d = f"{folder}/_page_offset={offset}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/page.json", "w") as fh:
        if as_array:
            json.dump(records, fh)
        else:
            fh.write("\n".join(json.dumps(r) for r in records))


def test_row_positions_contiguous(spark):
    df = with_row_positions(spark.range(0, 1234, numPartitions=7))
    pos = sorted(r._row_pos for r in df.collect())
    assert pos == list(range(1234))


def test_land_and_read_pages(spark, scratch):
    n = land_pages(_raw(spark, 23).repartition(3), f"{scratch}/landing", page_size=5)
    assert n == 23
    pages = read_page_files(spark, f"{scratch}/landing")
    assert pages.count() == 23
    audit = {r.page_offset: (r.row_count, r.status) for r in page_audit(pages, page_size=5).collect()}
    assert audit == {0: (5, "ok"), 5: (5, "ok"), 10: (5, "ok"), 15: (5, "ok"), 20: (3, "last")}


def test_audit_gap_open_end_and_short(spark, scratch):
    rec = {"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1"}
    _write_page(scratch, 0, [rec] * 5)
    _write_page(scratch, 5, [rec] * 3)     # short but not last
    _write_page(scratch, 15, [rec] * 5)    # gap before it (10 missing), last and full
    audit = {r.page_offset: r.status for r in page_audit(read_page_files(spark, scratch), page_size=5).collect()}
    assert audit == {0: "ok", 5: "gap_after", 15: "open_end"}
    _write_page(f"{scratch}/b", 0, [rec] * 2)
    _write_page(f"{scratch}/b", 5, [rec] * 5)
    audit = {r.page_offset: r.status for r in page_audit(read_page_files(spark, f"{scratch}/b"), page_size=5).collect()}
    assert audit == {0: "short_not_last", 5: "open_end"}


def test_page_as_json_array(spark, scratch):
    recs = [{"Rndrng_NPI": str(i), "HCPCS_Cd": "C"} for i in range(4)]
    _write_page(scratch, 0, recs, as_array=True)
    df = read_page_files(spark, scratch, multi_line=True)
    assert sorted(r.Rndrng_NPI for r in df.collect()) == ["0", "1", "2", "3"]


def test_stream_takes_only_new_pages(spark, scratch):
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    rec = {"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1", "Tot_Srvcs": "2"}
    _write_page(landing, 0, [rec] * 5)
    _write_page(landing, 5, [rec] * 5)
    assert stream_page_files(spark, landing, target, ckpt, max_files_per_trigger=1) == 10  # two batches
    assert stream_page_files(spark, landing, target, ckpt) == 0
    _write_page(landing, 10, [rec] * 2)
    assert stream_page_files(spark, landing, target, ckpt) == 2
    out = spark.read.parquet(target)
    assert out.count() == 12
    assert set(out.columns) >= {S.INGESTED_AT, S.SOURCE_TAG, "_page_offset"}
    assert out.filter(F.col("_page_offset") == 10).count() == 2


def test_stream_counts_every_batch(spark, scratch):
    landing, target, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    rec = {"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1"}
    for i in range(6):
        _write_page(landing, i * 5, [rec] * 5)
    assert stream_page_files(spark, landing, target, ckpt, max_files_per_trigger=1) == 30


def test_audit_misaligned_and_overfull(spark, scratch):
    rec = {"Rndrng_NPI": "1000000001", "HCPCS_Cd": "C1"}
    _write_page(scratch, 0, [rec] * 6)   # more rows than a page holds
    _write_page(scratch, 5, [rec] * 5)
    _write_page(scratch, 7, [rec] * 1)   # offset not on a page boundary
    audit = {r.page_offset: r.status for r in page_audit(read_page_files(spark, scratch), page_size=5).collect()}
    assert audit == {0: "overfull", 5: "gap_after", 7: "misaligned"}


def test_positions_keep_every_row_when_partitions_are_coalesced(spark):
    """A shuffled input whose pruned plan would be partitioned differently: every row, every position."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        wide = spark.range(50_000).select("id", F.concat(F.lit("x" * 60), F.col("id").cast("string")).alias("pad")).repartition(40, "id")
        got = with_row_positions(wide)
        assert got.count() == 50_000
        assert got.select("_row_pos").distinct().agg(F.min("_row_pos"), F.max("_row_pos"), F.count("*")).first() == (0, 49_999, 50_000)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def _page(folder, offset, text):
    os.makedirs(f"{folder}/_page_offset={offset}", exist_ok=True)
    with open(f"{folder}/_page_offset={offset}/page.json", "w") as f:
        f.write(text)


SCHEMA = T.StructType([T.StructField("k", T.StringType())])


def test_truncated_page_fails(spark, scratch):
    _page(scratch, 0, '{"k": "a"}\n{"k": "b"}\n{"k": "c')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_page_files(spark, scratch, SCHEMA, source_tag=None).collect()


def test_array_page(spark, scratch):
    _page(scratch, 0, '[\n  {"k": "a"},\n  {"k": "b"}\n]')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_page_files(spark, scratch, SCHEMA, source_tag=None).collect()
    rows = read_page_files(spark, scratch, SCHEMA, source_tag=None, multi_line=True).collect()
    assert sorted(r.k for r in rows) == ["a", "b"]


def test_missing_first_page_and_empty_last_page(spark, scratch):
    full = "\n".join('{"k": "x"}' for _ in range(5))
    _page(f"{scratch}/late", 5, full)
    _page(f"{scratch}/late", 10, '{"k": "x"}')
    late = page_audit(read_page_files(spark, f"{scratch}/late", SCHEMA, source_tag=None), 5)
    assert {r.page_offset: r.status for r in late.collect()} == {5: "gap_before", 10: "last"}
    with pytest.raises(ValueError, match="not complete"):
        require_complete(late)
    _page(f"{scratch}/done", 0, full)
    _page(f"{scratch}/done", 5, full)
    pages = read_page_files(spark, f"{scratch}/done", SCHEMA, source_tag=None, multi_line=False)
    with pytest.raises(ValueError, match="open_end"):
        require_complete(page_audit(pages, 5, landed_pages(spark, f"{scratch}/done")))
    _page(f"{scratch}/done", 10, "[]")
    pages = read_page_files(spark, f"{scratch}/done", SCHEMA, source_tag=None, multi_line=False)
    audit = page_audit(pages, 5, landed_pages(spark, f"{scratch}/done"))
    assert require_complete(audit) == {"ok": 2, "last": 1}
