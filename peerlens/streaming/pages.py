"""Incremental page ingest with Structured Streaming (``availableNow``).

A file-source stream over the landing folder remembers, in its checkpoint,
which page files it has already taken.  Each run with
``trigger(availableNow=True)`` takes every page landed since the last run
(in as many micro-batches as ``maxFilesPerTrigger`` asks for), appends them
to the bronze folder through the file sink (exactly-once via the sink's
own log), then stops.  A second run right after takes nothing.

There is no state and no watermark: pages are independent rows.  A fresh
full reload = a new target folder and a new checkpoint folder; both must
be on the shared file system (the checkpoint under the folder the cluster
names in ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from peerlens import schemas as S
from peerlens.sources.pages import ENVELOPE_TABLE, LANDED_AT, PAGE_COL, PAGE_FILE, envelope_schema, latest_envelopes


class _RowsTaken(StreamingQueryListener):
    """Sums ``numInputRows`` over every micro-batch, per query id.

    ``recentProgress`` keeps only the last few progress reports, so a run
    that takes many batches would be under-counted from it.  Events of one
    query arrive in order and the terminated event comes last, so waiting
    for it means every progress report has been counted.
    """

    def __init__(self) -> None:
        self.rows: dict[str, int] = defaultdict(int)
        self.done: set[str] = set()
        self._cv = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802 (Spark's callback names)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._cv:
            self.rows[str(event.progress.id)] += int(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._cv:
            self.done.add(str(event.id))
            self._cv.notify_all()

    def taken(self, query_id: str, timeout: float = 120.0) -> int:
        with self._cv:
            if not self._cv.wait_for(lambda: query_id in self.done, timeout):
                raise TimeoutError(f"no end of query {query_id} reported within {timeout} s; its rows are not counted")
            return self.rows[query_id]


def stream_page_files(
    spark: SparkSession,
    landing_dir: str,
    target_dir: str,
    checkpoint_location: str,
    schema: T.StructType = S.PROGRAM_A_RAW,
    source_tag: str = S.SOURCE_TAG_A,
    max_files_per_trigger: int | None = None,
    partition_by_page: bool = False,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> int:
    """Append newly landed pages to ``target_dir``; return the rows taken this run.

    An unreadable page fails the run (see ``read_page_files``); with ``multi_line`` a file may be one JSON array.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(PAGE_COL, T.LongType(), True)])
    reader = spark.readStream.schema(full).option("mode", mode).option("multiLine", str(multi_line).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = (
        reader.json(landing_dir)
        .withColumn(S.INGESTED_AT, F.current_timestamp())
        .withColumn(S.SOURCE_TAG, F.lit(source_tag))
    )
    writer = (
        stream.writeStream.format("parquet")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by_page:
        writer = writer.partitionBy(PAGE_COL)
    listener = _RowsTaken()
    spark.streams.addListener(listener)
    try:
        query = writer.start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return listener.taken(str(query.id))
    finally:
        spark.streams.removeListener(listener)


#: Column (and folder) of the micro-batch that took an envelope.
BATCH = "_batch"


def stream_envelopes(
    spark: SparkSession,
    landing_dir: str,
    target_dir: str,
    checkpoint_location: str,
    schema: T.StructType = S.PROGRAM_A_RAW,
    max_files_per_trigger: int | None = None,
) -> int:
    """Take newly landed page envelopes into ``target_dir`` and stop; returns the envelopes taken by this run.

    A micro-batch replaces its own partition ``_batch=<number>`` by dynamic partition overwrite inside ``foreachBatch``, so a batch that is
    repeated after a failure is there once.  :func:`read_taken_envelopes` gives the last envelope of every page, so a page that
    was landed again, corrected or emptied, counts once.  The number of folders is that of the batches.  Row groups hold few envelopes
    (``ENVELOPES_PER_GROUP``), so a task that writes or reads the folder holds few pages at once, however many lie in a file.
    """
    reader = spark.readStream.schema(envelope_schema(schema)).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = [F.col("_metadata.file_modification_time").alias(LANDED_AT), F.col("_metadata.file_name").alias(PAGE_FILE)]

    def take(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn(BATCH, F.lit(number).cast("bigint"))
        writer = numbered.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **ENVELOPE_TABLE)
        writer.partitionBy(BATCH).parquet(target_dir)

    listener = _RowsTaken()
    spark.streams.addListener(listener)
    try:
        query = (
            reader.json(landing_dir).select("*", *landed).writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return listener.taken(str(query.id))
    finally:
        spark.streams.removeListener(listener)


def read_taken_envelopes(spark: SparkSession, target_dir: str, schema: T.StructType = S.PROGRAM_A_RAW) -> DataFrame:
    """The last envelope of every page that :func:`stream_envelopes` has taken."""
    kept = T.StructType([
        *envelope_schema(schema).fields, T.StructField(LANDED_AT, T.TimestampType()), T.StructField(PAGE_FILE, T.StringType()),
        T.StructField(BATCH, T.LongType()),
    ])
    return latest_envelopes(spark.read.schema(kept).parquet(target_dir), BATCH)
