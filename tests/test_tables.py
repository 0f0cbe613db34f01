"""Tables by name and compaction: nothing lost, nothing changed, no gap."""

import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from peerlens.sources import compaction
from peerlens.sources.tables import KEPT_VERSIONS, _versions, compact_table, read_table, replace_table, write_table


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _months(spark, n=100, parts=4):
    return spark.range(0, n, numPartitions=parts).select(
        "id", F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("m"), (F.col("id") * 1.5).alias("v")
    )


def test_partitioned_table_by_name_has_all_rows(spark, scratch):
    df = _months(spark)
    assert write_table(df, f"{scratch}/t", name="tabtest.months", partition_by=["m"]) == 100
    named = read_table(spark, "tabtest.months")
    assert _rows(named.select("id", "m", "v")) == _rows(df)
    assert dict(named.dtypes)["m"] == "string" and {r.m for r in named.collect()} == {"00", "01", "02"}
    plan = named.where("m = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    # again, with other columns, other partitions and fewer rows
    other = df.where("m <> '00'").select("id", "m", F.lit("x").alias("w"))
    write_table(other, f"{scratch}/u", name="tabtest.months", partition_by=["m"])
    again = read_table(spark, "tabtest.months")
    assert sorted(again.columns) == ["id", "m", "w"] and _rows(again.select("id", "m", "w")) == _rows(other)
    # one more partition by append
    write_table(other.limit(2).withColumn("m", F.lit("09")), f"{scratch}/u", name="tabtest.months", mode="append", partition_by=["m"])
    assert spark.table("tabtest.months").where("m = '09'").count() == 2


def test_names_with_odd_characters(spark, scratch):
    df = spark.createDataFrame([(1, "a b"), (2, "c/d=e%")], "`the id` int, `part key` string")
    write_table(df, f"{scratch}/it's a table", name="tabtest.odd", partition_by=["part key"])
    assert _rows(read_table(spark, "tabtest.odd").select("the id", "part key")) == _rows(df)


def test_old_plain_table_becomes_a_view(spark, scratch):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tabtest")
    spark.range(3).write.mode("overwrite").option("path", f"{scratch}/plain").saveAsTable("tabtest.plain")
    replace_table(spark.range(5), "tabtest.plain", f"{scratch}/versions")
    assert read_table(spark, "tabtest.plain").count() == 5
    assert spark.read.parquet(f"{scratch}/plain").count() == 3  # the files of the old one stay


@pytest.mark.parametrize("by", [None, ["m"]])
def test_replace_leaves_no_gap(spark, scratch, by):
    name = f"tabtest.live_{'p' if by else 'u'}"
    first = _months(spark, 60)
    replace_table(first, name, scratch, partition_by=by)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(name).count())
            except Exception as e:  # noqa: BLE001
                seen.append(repr(e)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 5):
        # the new rows are made of the table itself
        replace_table(spark.table(name).select("id", "m", "v").union(_months(spark, 60)), name, scratch, partition_by=by)
    stop.set()
    reader.join()
    assert len(seen) > 2 and set(seen) <= {60 * k for k in range(1, 6)} and seen == sorted(seen)
    assert spark.table(name).count() == 300
    assert len(_versions(spark, name)) == KEPT_VERSIONS


def test_failed_write_leaves_the_old_rows(spark, scratch):
    replace_table(spark.range(7), "tabtest.safe", scratch)
    broken = spark.range(9).select(F.assert_true(F.col("id") < 5).alias("x"))
    with pytest.raises(Exception, match="USER_RAISED|assert|false"):
        replace_table(broken, "tabtest.safe", scratch)
    assert spark.table("tabtest.safe").count() == 7


def test_compaction_changes_no_partition_value(spark, scratch):
    path = f"{scratch}/t"
    df = _months(spark, 300, 5).withColumn("m", F.when(F.col("m") == "02", "1 2/é=%").otherwise(F.col("m")))
    write_table(df, path, partition_by=["m"])
    folders = sorted(os.listdir(path))
    before, after = compact_table(spark, path)
    assert (before, after) == (15, 3)
    assert sorted(os.listdir(path)) == folders
    read = spark.read.schema("id bigint, v double, m string").parquet(path)
    assert _rows(read.select("id", "m", "v")) == _rows(df)
    assert compact_table(spark, path) == (3, 3)  # nothing left to do


def test_large_files_stay_untouched(spark, scratch):
    path = f"{scratch}/t"
    noise = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    write_table(noise.coalesce(1), path)
    large = glob.glob(f"{path}/*.parquet")
    size = os.path.getsize(large[0])
    write_table(noise.where("id < 600").repartition(12), path, mode="append")
    small = sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")) - size
    stamp = os.stat(large[0]).st_mtime_ns
    assert compact_table(spark, path, target_file_bytes=size) == (13, 2)
    assert os.stat(large[0]).st_mtime_ns == stamp
    moved = [f for f in glob.glob(f"{path}.before-compaction/**/*.parquet", recursive=True)]
    assert len(moved) == 12 and sum(map(os.path.getsize, moved)) == small
    assert read_table(spark, path).count() == 60_600
    # small files are packed to about the target, never beyond it by more than a file
    write_table(noise.repartition(30), f"{scratch}/many")
    total = sum(map(os.path.getsize, glob.glob(f"{scratch}/many/*.parquet")))
    _, after = compact_table(spark, f"{scratch}/many", target_file_bytes=total // 4)
    assert 4 <= after <= 6 and read_table(spark, f"{scratch}/many").count() == 60_000


def test_files_with_other_columns_are_packed_together(spark, scratch):
    path = f"{scratch}/t"
    write_table(spark.range(4).coalesce(1), path)
    write_table(spark.range(4, 8).withColumn("w", F.lit("x")).coalesce(1), path, mode="append")
    assert compact_table(spark, path) == (2, 1)
    assert {tuple(r) for r in read_table(spark, path).groupBy("w").count().collect()} == {(None, 4), ("x", 4)}


@pytest.mark.parametrize("fail_at", [1, 2, 6, 12, 14])
def test_failed_swap_restores_the_table(spark, scratch, monkeypatch, fail_at):
    path = f"{scratch}/t"
    df = _months(spark, 90, 4)
    write_table(df, path, partition_by=["m"])
    files = sorted(glob.glob(f"{path}/*/*.parquet"))
    real, calls = compaction.Files.move, []

    def move(self, source, target):
        calls.append(source)
        if len(calls) == fail_at:
            raise RuntimeError("no space")
        real(self, source, target)

    monkeypatch.setattr(compaction.Files, "move", move)
    with pytest.raises(RuntimeError, match="no space"):
        compact_table(spark, path)
    assert sorted(glob.glob(f"{path}/*/*.parquet")) == files
    assert _rows(spark.read.schema("id bigint, v double, m string").parquet(path).select("id", "m", "v")) == _rows(df)


def test_lost_rows_stop_the_compaction(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    write_table(spark.range(40).repartition(4), path)
    plan = compaction.packing_plan
    monkeypatch.setattr(compaction, "packing_plan", lambda *a: plan(*a).withColumn("rows", F.col("rows") + 1))
    with pytest.raises(RuntimeError, match="not as many written"):
        compact_table(spark, path)
    assert read_table(spark, path).count() == 40
