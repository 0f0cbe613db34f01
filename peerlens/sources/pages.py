"""Paged feed, re-aimed: pages land as files; Spark reads them in parallel.

The paged API of program A returns pages of at most ``page_size`` JSON
objects at increasing offsets; the fetch stops at an empty or short page.
Pulling every page through one driver ran out of memory at a few million
rows, so here each page is a file in a landing folder, named by its offset
(``<landing>/_page_offset=<n>/…``), and the whole folder is read by many
tasks at once with a declared schema (never inferred).

* :func:`land_pages` writes any DataFrame as such pages (tests, replays,
  the bench): global row positions come from per-partition counts — a
  table with one row per input partition — never from a global sort or a
  single-partition window;
* :func:`read_page_files` reads a landing folder (JSON lines, or one JSON
  array per file with ``multi_line=True``);
* :func:`page_audit` turns the stop rule into a check over what landed:
  offsets aligned and contiguous, every page full but the last.

One folder per page does not suit a feed of millions of pages.  :func:`land_envelopes` lands pages as *envelopes*: one JSON line per
page with its offset and the array of its rows, many to a file, in one flat folder, whatever the number of pages.  An empty page
is an envelope without rows, and a page that is landed again is one more envelope; :func:`latest_envelopes` takes the last one of every page.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens import schemas as S
from peerlens.sources.files import Files
from peerlens.sources.sizing import FEED_ROWS_PER_TASK, dealt, parts_for, shared_folder, written_once
from peerlens.sources.tables import with_audit

PAGE_COL = "_page_offset"

#: Landed pages are compressed: as plain text they take many times the bytes of the rows.
LANDED_COMPRESSION = "gzip"
#: Up to so many pages their newest versions (some 100 bytes each) are sent to all tasks; above, the envelopes are dealt by page.
MOST_PAGES_SENT = 100_000
PAGES_PER_TASK = 20
#: Envelopes of a row group where envelopes are kept as parquet.  Writer and reader hold a row group's share at once (the reader up to 4,096 rows of it),
#: and a row is a whole page here: by bytes alone a row group holds hundreds of pages.
ENVELOPES_PER_GROUP = 8
ENVELOPE_TABLE = {"parquet.block.row.count.limit": str(ENVELOPES_PER_GROUP)}


def with_row_positions(df: DataFrame, col: str = "_row_pos") -> DataFrame:
    """Add a 0-based contiguous position to every row, distributed.

    The rows are written once, each with the number of its partition and its place in it, to the
    shared folder; positions come from that written table alone, so nothing depends on two runs of the
    input being partitioned alike.  A partition's start is the number of rows in the partitions before
    it, computed on a table of one row per partition.  That table (24 bytes for a task of the write) is broadcast, so the rows are not shuffled for it.
    """
    return _positioned(df, shared_folder(df.sparkSession, "positions"), col)


def _positioned(df: DataFrame, staged: str, col: str = "_row_pos") -> DataFrame:
    """:func:`with_row_positions` by way of the folder ``staged``, which holds the rows until they are read."""
    spark = df.sparkSession
    tagged = df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    tagged.write.parquet(staged)
    kept = spark.read.schema(tagged.schema).parquet(staged)
    sizes = kept.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    order = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_start"))
    return (
        kept.join(F.broadcast(starts), "_pid")
        .withColumn(col, F.col("_start") + F.col("_mid") - F.col("_first"))
        .drop("_pid", "_mid", "_first", "_start")
    )


def land_pages(df: DataFrame, landing_dir: str, page_size: int = S.PAGE_SIZE) -> int:
    """Write ``df`` as pages of ``page_size`` rows, one folder per page offset.

    Rows are first put in a fixed order inside each partition (a local
    sort, no shuffle), so a retried task gives every row the same position
    again.  Each page is written by one task as one file (a page is at most
    ``page_size`` rows, so no task gets more).  Returns the number of rows.
    """
    taken, obs = Observation("taken"), Observation("landed")
    spark, staged = df.sparkSession, shared_folder(df.sparkSession, "positions")
    positioned = _positioned(df.sortWithinPartitions(*df.columns).observe(taken, F.count(F.lit(1)).alias("rows")), staged)
    rows = int(taken.get["rows"])
    paged = positioned.withColumn(
        PAGE_COL, (F.floor(F.col("_row_pos") / page_size) * page_size).cast("bigint")
    ).drop("_row_pos")
    parts = parts_for(spark, rows, FEED_ROWS_PER_TASK)
    whole = dealt(paged, parts, PAGE_COL) if parts else paged.repartition(PAGE_COL)
    # observed above the exchange: in the stage that writes, where a re-run task replaces its counts
    whole.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", LANDED_COMPRESSION).partitionBy(
        PAGE_COL
    ).json(landing_dir)
    Files(spark, staged).delete(staged)
    landed = int(obs.get["rows"])
    if rows != landed:
        raise RuntimeError(f"{rows} rows came in, {landed} were landed in {landing_dir}")
    return landed


def read_page_files(
    spark: SparkSession,
    landing_dir: str,
    schema: T.StructType = S.PROGRAM_A_RAW,
    source_tag: str | None = S.SOURCE_TAG_A,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read every landed page with a declared schema; keeps ``_page_offset``.

    A page that is no valid JSON fails the job that reads it (``mode="FAILFAST"``), it never turns
    into rows of nulls that a later key filter would drop.

    The offset comes from the folder name (partition discovery), so a page
    file needs no extra field.  With ``multi_line=True`` each file may be
    one JSON array (the API's own page format): every element becomes a row.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(PAGE_COL, T.LongType(), True)])
    df = spark.read.schema(full).option("mode", mode).option("multiLine", str(multi_line).lower()).json(landing_dir)
    return with_audit(df, source_tag) if source_tag else df


def landed_pages(spark: SparkSession, landing_dir: str) -> DataFrame:
    """The page offsets (``page_offset``) for which a file has landed, whether it holds rows or not.

    From the file listing: no page is opened.
    """
    files = spark.read.format("binaryFile").load(landing_dir)
    return files.select(F.col(PAGE_COL).cast("bigint").alias("page_offset")).distinct()


def page_audit(pages: DataFrame, page_size: int = S.PAGE_SIZE, landed: DataFrame | None = None) -> DataFrame:
    """One row per landed page: ``page_offset``, ``row_count``, ``status``.

    ``landed`` (see :func:`landed_pages`) adds pages without rows: an empty page at the end is the proof
    that the feed is complete.  Status: ``ok`` (full, next page present), ``last`` (short or
    empty page, nothing after it: the feed ended as the stop rule says), ``open_end`` (last page
    is full, so the feed may have more), ``gap_before`` (the first page present does not start at 0),
    ``gap_after`` (no page at offset + size though later pages exist), ``short_not_last`` (short page
    followed by more pages), ``misaligned`` (offset not a multiple of the
    page size), ``overfull`` (more rows than a page holds).  A page with several
    faults gets the first of: misaligned, overfull, gap_before, then the others.  All joins are
    on the offset; lowest and highest offset are scalar subqueries.
    """
    counts = pages.groupBy(F.col(PAGE_COL).alias("page_offset")).agg(F.count(F.lit(1)).alias("row_count"))
    if landed is not None:
        counts = landed.join(counts, "page_offset", "left").select("page_offset", F.coalesce("row_count", F.lit(0)).alias("row_count"))
    return audit_counts(counts, page_size)


def audit_counts(counts: DataFrame, page_size: int = S.PAGE_SIZE) -> DataFrame:
    """:func:`page_audit` from one row per landed page (``page_offset``, ``row_count``).

    The counts are read four times, so they are written first (one small row per page): the feed behind them is read once.
    """
    counts = written_once(counts, "page-counts")
    nxt = counts.select((F.col("page_offset") - F.lit(page_size)).alias("_prev"), F.lit(True).alias("_has_next"))
    ends = counts.agg(F.min("page_offset").alias("lo"), F.max("page_offset").alias("hi"))
    j = counts.join(nxt, counts.page_offset == nxt._prev, "left")
    has_next = F.coalesce(F.col("_has_next"), F.lit(False))
    is_first = F.col("page_offset") == ends.select("lo").scalar()
    is_last = F.col("page_offset") == ends.select("hi").scalar()
    status = (
        F.when(F.col("page_offset") % page_size != 0, F.lit("misaligned"))
        .when(F.col("row_count") > page_size, F.lit("overfull"))
        .when(is_first & (F.col("page_offset") > 0), F.lit("gap_before"))
        .when(is_last & (F.col("row_count") < page_size), F.lit("last"))
        .when(is_last, F.lit("open_end"))
        .when(~has_next, F.lit("gap_after"))
        .when(F.col("row_count") < page_size, F.lit("short_not_last"))
        .otherwise(F.lit("ok"))
    )
    return j.select("page_offset", "row_count", status.alias("status"))


def require_complete(audit: DataFrame, allow_open_end: bool = False) -> dict[str, int]:
    """Pages per status; raises ``ValueError`` unless the feed is complete from offset 0 to its end."""
    found = {r["status"]: r["pages"] for r in page_audit_summary(audit).collect()}
    bad = sorted(set(found) - {"ok", "last"} - ({"open_end"} if allow_open_end else set()))
    if bad or not found:
        raise ValueError(f"the paged feed is not complete: {found or 'no page has landed'}")
    return found


def page_audit_summary(audit: DataFrame) -> DataFrame:
    """Pages and rows per status (``status``, ``pages``, ``row_count``)."""
    return audit.groupBy("status").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("row_count").alias("row_count")
    )


# -- envelopes ---------------------------------------------------------------
LANDED_AT = "_landed_at"
PAGE_FILE = "_page_file"


def envelope_schema(schema: T.StructType = S.PROGRAM_A_RAW) -> T.StructType:
    return T.StructType([T.StructField(PAGE_COL, T.LongType(), True), T.StructField("rows", T.ArrayType(schema), True)])


def land_envelopes(df: DataFrame, landing_dir: str, page_size: int = S.PAGE_SIZE, mode: str = "overwrite", ended: bool = False) -> int:
    """Write ``df`` as page envelopes, many to a file, in one folder; returns the number of rows.

    ``ended=True`` adds the empty page that ends a feed whose last page is full.
    """
    taken = Observation("taken")
    spark, staged = df.sparkSession, shared_folder(df.sparkSession, "positions")
    positioned = _positioned(df.sortWithinPartitions(*df.columns).observe(taken, F.count(F.lit(1)).alias("rows")), staged)
    rows = int(taken.get["rows"])
    offset = (F.floor(F.col("_row_pos") / page_size) * page_size).cast("bigint")
    # a page is at most page_size rows, so no group grows with the feed; dealt whatever the session's partitions are: without it, tasks would
    # put together the pages of a whole input split before the exchange, and of a whole coalesced partition after it
    whole = dealt(positioned.withColumn(PAGE_COL, offset), max(1, math.ceil(rows / FEED_ROWS_PER_TASK)), PAGE_COL)
    paged = whole.groupBy(PAGE_COL).agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
    if ended and rows % page_size == 0:
        last = spark.createDataFrame([(rows,)], f"{PAGE_COL} bigint")
        paged = paged.unionByName(last.withColumn("rows", F.array().cast(paged.schema["rows"].dataType)))
    landed = Observation("landed")
    write_envelopes(paged.observe(landed, F.sum(F.size("rows")).alias("rows")), landing_dir, mode)
    Files(spark, staged).delete(staged)
    if rows != (landed.get["rows"] or 0):
        raise RuntimeError(f"{rows} rows came in, {landed.get['rows']} were landed in {landing_dir}")
    return rows


def write_envelopes(pages: DataFrame, landing_dir: str, mode: str = "overwrite") -> None:
    """Write envelopes (``_page_offset``, ``rows``) as compressed JSON lines into ``landing_dir``."""
    pages.write.mode(mode).option("compression", LANDED_COMPRESSION).json(landing_dir)


def read_envelopes(spark: SparkSession, landing_dir: str, schema: T.StructType = S.PROGRAM_A_RAW, mode: str = "FAILFAST") -> DataFrame:
    """All landed envelopes: ``_page_offset``, ``rows``, and when and with which file they landed."""
    pages = spark.read.schema(envelope_schema(schema)).option("mode", mode).json(landing_dir)
    return pages.select("*", F.col("_metadata.file_modification_time").alias(LANDED_AT), F.col("_metadata.file_name").alias(PAGE_FILE))


def latest_envelopes(envelopes: DataFrame, *before: str) -> DataFrame:
    """The last envelope of every page: by the columns ``before``, then by landing time, then by file name.

    Finding them reads offsets and versions only, never the rows; it is done at once, on the envelopes there are, and what is found (a small row
    per page) is written, so that its true size tells how the envelopes meet it: sent to all tasks up to ``MOST_PAGES_SENT`` pages, and the rows are not
    shuffled; above, dealt by page to tasks of ``PAGES_PER_TASK`` pages.
    """
    version = F.struct(*before, LANDED_AT, PAGE_FILE)
    newest = written_once(envelopes.groupBy(F.col(PAGE_COL).alias("_page")).agg(F.max(version).alias("_newest")), "newest-pages")
    pages = newest.count()
    at = F.broadcast(newest) if pages <= MOST_PAGES_SENT else dealt(newest, math.ceil(pages / PAGES_PER_TASK), "_page")
    # no version is greater than the newest: "at least" is "equal", and stays out of the keys that deal the envelopes
    return envelopes.join(at, (F.col(PAGE_COL) == at["_page"]) & (version >= at["_newest"]), "left_semi")


def envelope_rows(envelopes: DataFrame, source_tag: str | None = S.SOURCE_TAG_A) -> DataFrame:
    """The rows of envelopes, with ``_page_offset`` (as :func:`read_page_files` gives them)."""
    rows = envelopes.select(PAGE_COL, F.inline("rows"))
    rows = rows.select(*(c for c in rows.columns if c != PAGE_COL), PAGE_COL)
    return with_audit(rows, source_tag) if source_tag else rows


def envelope_audit(envelopes: DataFrame, page_size: int = S.PAGE_SIZE) -> DataFrame:
    """:func:`page_audit` of envelopes (one per page): empty pages count, no row is unpacked."""
    counts = envelopes.select(F.col(PAGE_COL).alias("page_offset"), F.coalesce(F.size("rows"), F.lit(0)).cast("bigint").alias("row_count"))
    return audit_counts(counts, page_size)
