"""The paged feed as a Spark data source: pages are fetched by the tasks, never by the driver.

``register_paged(spark, fetch, ...)`` registers a source under a name; then ``spark.read.format(name).load()`` is the feed as a
table, and ``spark.readStream.format(name).load()`` takes what the feed has grown by.  ``fetch(offset, limit)`` is the caller's: it
returns the feed's rows from ``offset`` on, at most ``limit``, as dicts (:func:`http_fetch` for an HTTP endpoint,
:func:`landed_fetch` for pages that lie in a folder).  It runs in the tasks, so it must be importable or picklable there.

The end of the feed is found by asking for single rows: offsets are doubled until one has no row, then halved in (some sixty
requests for any length; no page passes through the driver).  The rows up to the end are cut into partitions of whole pages, so a lost
task asks for its own pages again and nothing else.  The stop rule holds in the tasks: a page shorter than
asked for, before the end that was found, fails the job instead of losing the rows behind it, and the task of the last page of a batch read asks on until a
short or an empty page, so rows that come in between are read too.  A stream's offset is the number of rows taken; a page
that was short and has grown is taken from where it ended.

Rows are matched to the declared schema by name: missing fields are null, unknown ones are ignored, and a number in a text column
becomes its text.  ``_page_offset`` is the offset of the page that a row belongs to.  A fetch that raises is repeated
``attempts`` times, then the task fails.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from peerlens import schemas as S
from peerlens.sources.pages import PAGE_COL
from peerlens.sources.tables import with_audit

Fetch = Callable[[int, int], list[dict]]


@dataclass
class Feed:
    """A paged feed and how to read it."""

    fetch: Fetch
    schema: T.StructType = S.PROGRAM_A_RAW
    page_size: int = S.PAGE_SIZE
    pages_per_task: int = 20
    attempts: int = 4
    pause: float = 0.5

    def rows(self, offset: int, limit: int) -> list[dict]:
        for attempt in range(self.attempts):
            try:
                found = self.fetch(offset, limit)
                break
            except Exception:
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(self.pause * 2**attempt)
        if len(found) > limit:
            raise ValueError(f"the feed gave {len(found)} rows at offset {offset}, {limit} were asked for")
        return found

    def end(self, known: int = 0) -> int:
        """The number of rows, of which at least ``known`` are there: the first offset without a row."""
        if not self.rows(known, 1):
            return known
        step = self.page_size
        low = known  # has a row
        while self.rows(low + step, 1):
            low, step = low + step, 2 * step
        high = low + step  # has none
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.rows(middle, 1) else (low, middle)
        return high


@dataclass
class Pages(InputPartition):
    """Rows ``first`` to ``end`` of the feed; ``open``: ask on behind the end until the feed stops."""

    first: int
    end: int
    open: bool = False


def page_ranges(first: int, end: int, page_size: int, pages_per_task: int) -> list[Pages]:
    """The rows from ``first`` to ``end`` in partitions that begin at whole pages."""
    step = page_size * pages_per_task
    cuts = [first, *range((first // step + 1) * step, end, step), end]
    return [Pages(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def _with_page(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PAGE_COL, T.LongType(), True)])


def _text(value):
    """A value of a text column: text stays, other scalars become their JSON text."""
    return value if value is None or isinstance(value, str) else json.dumps(value)


def _batch(feed: Feed, rows: list[dict], page: int) -> pa.RecordBatch:
    kinds = to_arrow_schema(_with_page(feed.schema))
    columns = []
    for kind in kinds:
        if kind.name == PAGE_COL:
            columns.append(pa.array([page] * len(rows), pa.int64()))
        else:
            values = [r.get(kind.name) for r in rows]
            columns.append(pa.array([_text(v) for v in values] if pa.types.is_string(kind.type) else values, kind.type))
    return pa.record_batch(columns, schema=kinds)


def read_pages(feed: Feed, part: Pages) -> Iterator[pa.RecordBatch]:
    """The rows of a partition, a page at a time."""
    at, size = part.first, feed.page_size
    while at < part.end or part.open:
        page = at // size * size
        limit = page + size - at
        if not part.open:
            limit = min(limit, part.end - at)
        rows = feed.rows(at, limit)
        if rows:
            yield _batch(feed, rows, page)
        if len(rows) < limit:
            if at + len(rows) < part.end:
                raise ValueError(f"the page at offset {page} ended after {at + len(rows) - page} rows, but the feed goes on to {part.end}")
            return
        at += len(rows)


class _Reader(DataSourceReader):
    def __init__(self, feed: Feed):
        self.feed = feed

    def partitions(self) -> list[Pages]:
        parts = page_ranges(0, self.feed.end(), self.feed.page_size, self.feed.pages_per_task) or [Pages(0, 0)]
        parts[-1].open = True
        return parts

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        yield from read_pages(self.feed, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, feed: Feed):
        self.feed, self.known = feed, 0

    def initialOffset(self) -> dict:  # noqa: N802 (Spark's names)
        return {"rows": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.known = self.feed.end(self.known)
        return {"rows": self.known}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.known = max(self.known, end["rows"])
        return page_ranges(start["rows"], end["rows"], self.feed.page_size, self.feed.pages_per_task)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        yield from read_pages(self.feed, partition)

    def commit(self, end: dict) -> None:
        pass


def paged_source(feed: Feed, name: str = "paged") -> type[DataSource]:
    """A data source class for one feed."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return _with_page(feed.schema)

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return _Reader(feed)

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
            return _StreamReader(feed)

    return Paged


def register_paged(spark: SparkSession, fetch: Fetch, name: str = "paged", **settings) -> Feed:
    """Register the feed behind ``fetch`` as the format ``name``; ``settings`` are those of :class:`Feed`."""
    feed = Feed(fetch, **settings)
    spark.dataSource.register(paged_source(feed, name))
    return feed


def read_paged(
    spark: SparkSession, fetch: Fetch, source_tag: str | None = S.SOURCE_TAG_A, name: str = "paged", **settings
) -> DataFrame:
    """The whole feed as a table, with ``_page_offset`` and the audit columns."""
    register_paged(spark, fetch, name, **settings)
    pages = spark.read.format(name).load()
    return with_audit(pages, source_tag) if source_tag else pages


def stream_paged(
    spark: SparkSession,
    fetch: Fetch,
    target_dir: str,
    checkpoint_location: str,
    source_tag: str = S.SOURCE_TAG_A,
    name: str = "paged",
    **settings,
) -> int:
    """Append what the feed has grown by to ``target_dir`` and stop; returns the rows taken by this run.

    The checkpoint remembers how many rows were taken; a run right after another takes none.  The folder is written
    by the file sink, so a run that is broken off and repeated neither loses nor doubles rows: the next run ends the batch of the broken one, and
    what the feed has grown by since is taken by the run after that.
    """
    register_paged(spark, fetch, name, **settings)
    stream = spark.readStream.format(name).load().withColumn(S.INGESTED_AT, F.current_timestamp())
    query = (
        stream.withColumn(S.SOURCE_TAG, F.lit(source_tag)).writeStream.format("parquet").option("path", target_dir)
        .option("checkpointLocation", checkpoint_location).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(rows_at(p.sources[0].endOffset) - rows_at(p.sources[0].startOffset) for p in query.recentProgress)


def rows_at(offset: str | None) -> int:
    """The rows taken at an offset as a progress report prints it (none before the first batch)."""
    found = re.search(r"\d+", offset or "")
    return int(found[0]) if found else 0


# -- fetch functions ---------------------------------------------------------
def http_fetch(
    url: str,
    size_param: str = "size",
    offset_param: str = "offset",
    params: dict[str, str] | None = None,
    headers: dict[str, str] | None = None,
    timeout: float = 60.0,
    opener: Callable = urlopen,
) -> Fetch:
    """Pages of a JSON endpoint that takes a page size and an offset and answers with an array of objects."""

    def fetch(offset: int, limit: int) -> list[dict]:
        query = urlencode({**(params or {}), size_param: limit, offset_param: offset})
        with opener(Request(f"{url}?{query}", headers=headers or {}), timeout=timeout) as answer:
            rows = json.load(answer)
        if not isinstance(rows, list):
            raise ValueError(f"{url} answered with no array at offset {offset}")
        return rows

    return fetch


def landed_fetch(landing_dir: str, page_size: int = S.PAGE_SIZE) -> Fetch:
    """The feed replayed from landed pages: ``<landing>/_page_offset=<n>/*.json`` with a JSON object per line (plain or gzip)."""
    uri = landing_dir.replace("file:///", "/") if landing_dir.startswith("file:///") else landing_dir
    uri = uri.removeprefix("file:") if uri.startswith("file:/") else uri

    def fetch(offset: int, limit: int) -> list[dict]:
        files, root = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        rows: list[dict] = []
        while len(rows) < limit:
            page = (offset + len(rows)) // page_size * page_size
            folder = pafs.FileSelector(f"{root}/{PAGE_COL}={page}", allow_not_found=True)
            parts = sorted(f.path for f in files.get_file_info(folder) if f.path.endswith((".json", ".json.gz")))
            lines = [line for p in parts for line in files.open_input_stream(p).read().splitlines() if line.strip()]
            skip = offset + len(rows) - page
            rows += [json.loads(line) for line in lines[skip : skip + limit - len(rows)]]
            if len(lines) < page_size:
                break
        return rows

    return fetch
