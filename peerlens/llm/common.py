"""Helpers shared by the operators of this subpackage.

Intermediate tables that are read more than once are *written* to the shared
folder the cluster names in ``spark.checkpoint.dir`` and read back
(:func:`written`): that cuts the lineage, and a lost executor costs a re-read,
never a recomputation.  Nothing here collects rows to the driver.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.operators.hot_keys import hot_keys, spread_join
from peerlens.session import checkpoint_dir

#: Texts handled together inside a task (bounds the working memory of numpy code).
SLICE_CHARS = 1_000_000


def shared_folder(spark: SparkSession, what: str) -> str:
    """A fresh folder (as a URI) under the session's shared checkpoint folder."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/llm/{what}-{uuid.uuid4().hex}"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, what: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back with its schema.

    ``batch_rows``: rows per Arrow batch in the Python tasks of this write (bounds their memory where rows hold whole texts).
    """
    spark = df.sparkSession
    path = shared_folder(spark, what)
    usual = spark.conf.get(_BATCH)
    try:
        if batch_rows:
            spark.conf.set(_BATCH, batch_rows)
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, usual)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, like: str) -> str:
    """A column name that ``df`` does not have (whatever the case of its letters)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{like}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder URI, for tasks that write their own file formats."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, write: Callable) -> None:
    """Write ``folder/name`` through ``write(stream)``.

    Callers use a name that is new for every task attempt; only names that a
    finished task reported are ever read, so a lost or speculative attempt
    leaves at most an unread file.
    """
    filesystem, path = open_folder(folder)
    filesystem.create_dir(path, recursive=True)
    with filesystem.open_output_stream(f"{path}/{name}", compression=None) as stream:
        write(stream)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of at most ``limit`` bytes of text (one row at least).

    Null texts come out as empty strings.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = 0
        while start < len(size):
            total = np.cumsum(size[start : start + 100_000])
            stop = start + max(1, int(np.searchsorted(total, limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, [t or "" for t in column.slice(start, stop - start).to_pylist()]
            start = stop
        del batch, column
        give_back()


def bounded_sample(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most ``most`` rows, the first by a hash of the id.

    The rows are counted and thinned out by their hash first, so that about ``most`` rows leave the tasks, however many tasks
    there are; the order and the limit then work on those alone.  A table of up to ``most`` rows comes back whole.
    """
    order = F.xxhash64(id_col)
    total = rows.count()
    if total > most:
        share = (most + 6 * most**0.5) / total
        rows = rows.where(order.cast("double") < F.lit(share * 2.0**64 - 2.0**63))
    return rows.orderBy(order, id_col).limit(most)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph by alternating star contraction.

    ``edges``: columns ``a``, ``b`` of any one orderable type; self-loops and
    repeats are harmless, rows with a null end are ignored.  Returns ``node``,
    ``comp`` (the smallest node of the component) for every node of an edge
    between two different nodes.  Each round rewires every node to the
    smallest neighbour (large star, then small star); the number of rounds
    grows with the logarithm of a component's size, and every round is two
    pre-aggregated shuffles on an edge list that never grows.  The list of a
    round is written to the shared folder.  Raises if it did not converge.
    """
    stars = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    stars = stars.where("lo < hi").distinct()
    seen = None
    for _ in range(max_rounds):
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hubs = hot_keys(both, ["u"])  # a hub's links are dealt over several tasks
        # large star: neighbours above u move to u's smallest neighbour
        large = spread_join(both, least, ["u"], "inner", hubs, ["v"]).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("lo < hi").distinct()
        # small star: u and its neighbours below move to the smallest of them
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = spread_join(large, down, ["hi"], "inner", hubs, ["lo"]).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.union(down.select("hi", F.col("m").alias("lo"))).where("lo < hi").distinct()
        stars = written(small.select("lo", "hi"), "stars")
        print_ = stars.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("lo", "hi")).alias("x")
        ).first()
        if seen == (print_.n, print_.x):
            heads = stars.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("comp"))
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).union(heads)
        seen = (print_.n, print_.x)
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
