"""Compaction in place: small files are packed together, large ones stay where they are.

Files are chosen by their sizes alone, as Spark lists them (a filter on ``_metadata.file_size`` prunes the scan, so
no large file is opened).  The small files of a partition folder are packed, in order of their names, into bins of
about the target size; every bin is rewritten as one file by one task, beside the table.  Then the old files
are moved out and the new ones in, by renaming, one after the other; if any step fails, all are moved back.

Partition folders keep their names, whatever their values look like (``month=01`` stays ``month=01``): only the columns inside the
files are read and written.  Nothing is rewritten that is not small, so a second run right after does nothing.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.sources.files import DEFAULT_FORMAT, TARGET_FILE_BYTES, Files

#: A file below this share of the target size is small.
SMALL = 0.75


def _scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.option("mergeSchema", "true") if fmt == "parquet" else reader).load(path)


def file_sizes(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """One row per file with rows: ``file``, ``folder``, ``bytes``, ``rows`` (footers only: no column is read)."""
    files = _scan(spark, path, fmt).groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return files.select("file", F.regexp_replace("file", "/[^/]*$", "").alias("folder"), "bytes", "rows")


def packing_plan(sizes: DataFrame, target_file_bytes: int) -> DataFrame:
    """The small files that go together: ``file``, ``folder``, ``bytes``, ``rows``, ``bin`` (numbers from 0 in each folder).

    A bin holds files that begin within the same stretch of ``target_file_bytes`` of their folder; bins of one file are left out.
    """
    by_name = Window.partitionBy("folder").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(by_name), F.lit(0))
    dealt = sizes.where(F.col("bytes") < SMALL * target_file_bytes).withColumn("bin", F.floor(before / target_file_bytes))
    mates = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))
    return dealt.withColumn("_mates", mates).where("_mates > 1").drop("_mates")


def compact_table(
    spark: SparkSession,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    target_file_bytes: int = TARGET_FILE_BYTES,
    schema: T.StructType | None = None,
) -> tuple[int, int]:
    """Pack the small files of a table into files of about ``target_file_bytes``; returns (files before, files after).

    Same rows, same partition folders.  ``partition_by`` and ``schema`` are not needed: folders are kept as they are, and the files'
    own columns are written back.  The old files stay in ``<path>.before-compaction`` until the next compaction.  During
    the swap (renames only) a reader may meet a moved file; point readers at a name (:func:`~peerlens.sources.tables.replace_table`) to avoid that.
    """
    root = path.rstrip("/")
    if fmt == "delta":
        raise ValueError("a Delta table's files belong to its log: compact it with OPTIMIZE")
    files = Files(spark, root)
    sizes = file_sizes(spark, root, fmt)
    plan = packing_plan(sizes, target_file_bytes).orderBy("folder", "bin", "file").collect()  # names of small files only
    before = sizes.count()
    if not plan:
        return before, before
    bins: dict[tuple[str, int], int] = {}
    for r in plan:
        bins.setdefault((r.folder, r.bin), len(bins))
    table = _scan(spark, root, fmt)
    inside = [c for c in table.columns if not any(f"/{c}=" in unquote(r.folder) for r in plan)]
    dealt = spark.createDataFrame([(r.file, bins[r.folder, r.bin]) for r in plan], "_file string, _bin int")
    small = table.where(F.col("_metadata.file_size") < SMALL * target_file_bytes).select(*inside, F.col("_metadata.file_path").alias("_file"))
    staged = f"{root}.compacted-{uuid.uuid4().hex[:8]}"
    rows = small.join(dealt, "_file").drop("_file")
    rows.repartition(len(bins), "_bin").write.format(fmt).partitionBy("_bin").save(staged)
    new = {}
    for r in spark.read.format(fmt).load(staged).groupBy("_bin", F.col("_metadata.file_path").alias("file")).count().collect():
        new.setdefault(r["_bin"], []).append(r)
    for (folder, number), b in bins.items():
        wanted = sum(r.rows for r in plan if bins[r.folder, r.bin] == b)
        if sum(r["count"] for r in new.get(b, [])) != wanted:
            raise RuntimeError(f"compaction of {path}: {wanted} rows read from bin {number} of {folder}, not as many written")
    backup = f"{root}.before-compaction"
    files.delete(backup)
    _swap(files, root, backup, plan, {place: new[b] for place, b in bins.items()})
    files.delete(staged)
    spark.catalog.refreshByPath(path)
    return before, before - len(plan) + sum(len(made) for made in new.values())


def _swap(files: Files, root: str, backup: str, plan: list, new: dict[tuple[str, int], list]) -> None:
    """Move the planned files out to ``backup`` and the new ones in; on any failure move everything back."""
    done: list[tuple[str, str]] = []

    def move(source: str, target: str) -> None:
        files.move(source, target)
        done.append((source, target))

    local = lambda uri: files.name(unquote(uri))  # noqa: E731  ``_metadata`` gives encoded URIs
    mark, inside = uuid.uuid4().hex[:8], len(files.name(root))
    try:
        for (folder, _), made in new.items():  # hidden names: readers pass them over
            for r in made:  # one task may have written several bins: files of one name
                move(local(r["file"]), f"{local(folder)}/_{mark}-{len(done)}-{r['file'].rsplit('/', 1)[1]}")
        hidden = [target for _, target in done]
        for r in plan:
            move(local(r.file), backup + local(r.file)[inside:])
        for file in hidden:
            move(file, file.replace(f"/_{mark}-", f"/packed-{mark}-"))
    except Exception:
        for source, target in reversed(done):
            files.move(target, source)
        raise
