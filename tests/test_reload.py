"""Landing and loading again: every row once, untouched parts left alone."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.sources import pages as P
from peerlens.sources.pages import (
    envelope_audit, envelope_rows, land_envelopes, land_pages, latest_envelopes, page_audit, read_envelopes, read_page_files,
)
from peerlens.sources.reload import replace_partitions, replacing_months
from peerlens.sources.tables import write_table
from peerlens.streaming.pages import read_taken_envelopes, stream_envelopes

KIND = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.StringType())])


def _feed(spark, n, tag=""):
    return spark.range(n, numPartitions=3).select(F.concat(F.lit("r"), F.col("id")).alias("id"), F.concat(F.col("id"), F.lit(tag)).alias("n"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 5, 23, 25])
def test_envelopes_hold_the_same_pages(spark, scratch, n):
    assert land_envelopes(_feed(spark, n), f"{scratch}/flat", 5) == n
    flat = read_envelopes(spark, f"{scratch}/flat", KIND)
    if n:
        land_pages(_feed(spark, n), f"{scratch}/folders", 5)
        old = read_page_files(spark, f"{scratch}/folders", KIND, source_tag=None)
        assert _rows(envelope_rows(flat, None)) == _rows(old) and envelope_rows(flat, None).columns == old.columns
        assert _rows(envelope_audit(flat, 5)) == _rows(page_audit(old, 5))
    assert glob.glob(f"{scratch}/flat/*/") == []  # no folder per page
    land_envelopes(_feed(spark, n), f"{scratch}/ended", 5, ended=True)
    statuses = {r.status for r in envelope_audit(read_envelopes(spark, f"{scratch}/ended", KIND), 5).collect()}
    assert "last" in statuses and "open_end" not in statuses


def test_malformed_envelope_fails(spark, scratch):
    land_envelopes(_feed(spark, 12), scratch, 5)
    with open(f"{scratch}/part-x.json", "w") as fh:
        fh.write('{"_page_offset": 15, "rows": [{"id": "a"')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        envelope_rows(read_envelopes(spark, scratch, KIND)).collect()


def test_page_landed_again_counts_once(spark, scratch):
    landing, target, checkpoint = (f"{scratch}/{n}" for n in ("landing", "bronze", "checkpoint"))
    land_envelopes(_feed(spark, 12), landing, 5)
    assert stream_envelopes(spark, landing, target, checkpoint, KIND) == 3
    assert stream_envelopes(spark, landing, target, checkpoint, KIND) == 0

    def again(text):
        with open(f"{landing}/again-{len(os.listdir(landing))}.json", "w") as fh:
            fh.write(text)
        return stream_envelopes(spark, landing, target, checkpoint, KIND)

    assert again('{"_page_offset": 5, "rows": [{"id": "r5", "n": "new"}, {"id": "r6", "n": "new"}]}') == 1
    assert again('{"_page_offset": 10, "rows": []}') == 1  # emptied
    kept = read_taken_envelopes(spark, target, KIND)
    want = sorted([(f"r{i}", str(i), 0) for i in range(5)] + [("r5", "new", 5), ("r6", "new", 5)])
    assert _rows(envelope_rows(kept, None)) == want
    assert {(r.page_offset, r.row_count) for r in envelope_audit(kept, 5).collect()} == {(0, 5), (5, 2), (10, 0)}
    # twice within one batch: the file landed last
    for n, tag in enumerate("ab"):
        path = f"{landing}/both-{tag}.json"
        with open(path, "w") as fh:
            fh.write('{"_page_offset": 0, "rows": [{"id": "r0", "n": "%s"}]}' % tag)
        os.utime(path, (2_000_000_000 - n, 2_000_000_000 - n))
    assert stream_envelopes(spark, landing, target, checkpoint, KIND) == 2
    assert ("r0", "a", 0) in _rows(envelope_rows(read_taken_envelopes(spark, target, KIND), None))


def test_repeated_batch_is_there_once(spark, scratch):
    landing, target = f"{scratch}/landing", f"{scratch}/bronze"
    land_envelopes(_feed(spark, 12), landing, 5)
    # the checkpoint was lost after the batch was written: it is taken again under the same number
    for k in range(2):
        assert stream_envelopes(spark, landing, target, f"{scratch}/checkpoint{k}", KIND) == 3
    assert os.listdir(target).count("_batch=0") == 1
    assert envelope_rows(read_taken_envelopes(spark, target, KIND), None).count() == 12


def test_taken_envelopes_lie_in_small_row_groups(spark, scratch):
    """A reader takes a row group's envelopes at once, whole pages: their number must not grow with the file."""
    land_envelopes(_feed(spark, 200), f"{scratch}/landing", 5)  # one task: one file, taken into one file
    assert stream_envelopes(spark, f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/checkpoint", KIND) == 40
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{scratch}/bronze/*/*.parquet")]
    assert max(f.num_rows for f in files) > 8
    assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) <= 8
    assert _rows(envelope_rows(read_taken_envelopes(spark, f"{scratch}/bronze", KIND), None).select("id", "n")) == _rows(_feed(spark, 200))


def test_pages_are_put_together_by_few_rows_a_task(spark, scratch):
    """Also where the session's shuffle partitions are enough: pages are put together after an exchange of rows, in tasks of a stated size."""
    plan, write = [], P.write_envelopes
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(P, "write_envelopes", lambda pages, *a: (plan.append(pages._jdf.queryExecution().executedPlan().toString()), write(pages, *a)))
        assert land_envelopes(_feed(spark, 40), scratch, 5) == 40
    assert "REPARTITION_BY_NUM" in plan[0] and "hashpartitioning" not in plan[0].split("REPARTITION_BY_NUM")[0].rsplit("Exchange", 1)[0]


def test_latest_of_equal_times_is_the_greater_name(spark):
    rows = [(0, [("a", "1")], 1, "x"), (0, [("a", "2")], 1, "y"), (5, None, 1, "x")]
    df = spark.createDataFrame(rows, "_page_offset bigint, rows array<struct<id:string,n:string>>, _landed_at int, _page_file string")
    kept = latest_envelopes(df)
    assert sorted((r["_page_offset"], r["_page_file"]) for r in kept.collect()) == [(0, "y"), (5, "x")]
    assert _rows(envelope_rows(kept, None)) == [("a", "2", 0)]
    assert {(r.page_offset, r.row_count) for r in envelope_audit(kept, 1).collect()} == {(0, 1), (5, 0)}


# --- months -----------------------------------------------------------------
def _months(spark, months, tag="", each=6):
    parts = [spark.range(each).select("id", F.lit(m).alias("month"), F.lit(f"{m}{tag}").alias("v")) for m in months]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _read(spark, path):
    return spark.read.schema("id bigint, v string, month string").parquet(path).select("id", "month", "v")


def test_only_the_named_months_change(spark, scratch):
    path = f"{scratch}/b"
    write_table(_months(spark, ["01", "02", "03"]), path, partition_by=["month"])
    stamp = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=01/*")}
    for _ in range(2):  # repeated: the same
        assert replace_partitions(_months(spark, ["02"], "new", 4), path, "month", ["02"]) == 4
        want = _rows(_months(spark, ["01", "03"]).union(_months(spark, ["02"], "new", 4)))
        assert _rows(_read(spark, path)) == want
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=01/*")} == stamp
    # a new month comes, a month without rows goes
    replace_partitions(_months(spark, ["04"]), path, "month", ["02", "04"])
    assert {r.month for r in _read(spark, path).collect()} == {"01", "03", "04"}
    assert not os.path.exists(f"{path}/month=02")


def test_rows_of_other_months_stop_the_load(spark, scratch):
    path = f"{scratch}/b"
    write_table(_months(spark, ["01", "02"]), path, partition_by=["month"])
    before = _rows(_read(spark, path))
    for bad in (_months(spark, ["01", "02"], "x"), _months(spark, ["01"]).withColumn("month", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="no partition that is replaced"):
            replace_partitions(bad, path, "month", ["01"])
    assert _rows(_read(spark, path)) == before


def test_a_month_is_replaced_by_its_own_rows(spark, scratch):
    path = f"{scratch}/b"
    write_table(_months(spark, ["01", "02"]), path, partition_by=["month"])
    own = _read(spark, path).where("month = '01' AND id < 3").withColumn("v", F.lit("kept"))
    assert replace_partitions(own, path, "month", ["01"]) == 3
    assert {(r.month, r.v) for r in _read(spark, path).collect()} == {("01", "kept"), ("02", "02")}


def test_stream_of_months(spark, scratch):
    source, path = f"{scratch}/in", f"{scratch}/b"

    def run():
        stream = spark.readStream.schema("id bigint, month string, v string").parquet(source)
        query = stream.writeStream.foreachBatch(replacing_months(path, "month")).option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start()
        query.awaitTermination()

    _months(spark, ["01", "02"]).write.parquet(source)
    run()
    _months(spark, ["02"], "corrected", 2).write.mode("append").parquet(source)
    run()
    run()
    assert _rows(_read(spark, path)) == _rows(_months(spark, ["01"]).union(_months(spark, ["02"], "corrected", 2)))
