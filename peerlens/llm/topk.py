"""Exact top-k search by inner product in three phases with a uniform threshold.

The coordinates are cut into ``lists`` runs; a row's *local score* in a list is the inner product over that run, and its
score the sum of the local ones.  Rows lie whole in Spark's partitions, so every task holds its share of all lists.

1. *Gather*: every task sends, per query and list, its ``k`` best local scores, with the whole scores of these rows.  From
   these come, per query, the top M_j of every list and a safe bound B, the k-th best whole score seen (k different rows
   reach it).
2. *Cutoff*: a row that is more than (sum of M_j - B) / lists below M_j in every list sums up to less than B.  So that one
   gap, uniform over the lists, is broadcast with the tops, and tasks collect only rows within the gap of M_j in some list.
3. *Resolve*: a collected row whose local scores seen, plus the cutoffs of its other lists, fall short of the task's k-th best score
   is dropped; for the rest the missing local scores are added, and every task sends its k best rows per query.  The last ranking is by
   score, then by the smaller id.

Everything is integer arithmetic, exact in doubles or else in 64 bits, so the cutoff has no tolerance and loses no row.
Equal vectors are searched as one class, on either side (:mod:`peerlens.llm.intvectors`): copies never make pairs.  The queries are
dealt into blocks of about ``BLOCK_BYTES``; a block is broadcast, the rows are read again for every block.

Rows that take no part, repeated rows and vectors of other lengths: see :mod:`peerlens.llm.intvectors`.  Rows with the
query's own id are no candidates.  An id with several vectors is searched once for each.  An empty table gives an
empty result.  Columns beside those named are not read, so their names may clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.common import shared_folder, written
from peerlens.llm.intvectors import KEY, best, classes, exact_type, integer_rows, matrices

LISTS = 2
SCALE = 256
#: Bytes of query vectors broadcast at a time.
BLOCK_BYTES = 8 << 20
#: Bytes of vectors that a task reads, where there are more tasks than cores: what a task sends does not grow with its rows.
TASK_BYTES = 256 << 20
#: Cells of a score matrix computed at a time.
CELLS = 1 << 21


def _runs(size: int, lists: int) -> list[slice]:
    edge = np.linspace(0, size, min(lists, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edge[:-1], edge[1:])]


def _local_scores(x: np.ndarray, q: np.ndarray, lists: int) -> list[np.ndarray]:
    """Per list, the local scores (queries x rows)."""
    kind = exact_type(x, q)
    x, q = x.astype(kind), q.astype(kind)
    return [q[:, run] @ x[:, run].T for run in _runs(x.shape[1], lists)]


def _parts(batch: pa.RecordBatch, queries: dict[int, tuple[np.ndarray, np.ndarray]]):
    """(query numbers, query matrix, row numbers, row matrix) pieces of a batch whose score matrix is bounded."""
    for at, x in matrices(batch):
        if x.shape[1] in queries:
            numbers, q = queries[x.shape[1]]
            step = max(1, CELLS // len(q))
            for k in range(0, len(x), step):
                yield numbers, q, at[k : k + step], x[k : k + step]


_ENTRY = "_q int, _list int, _local bigint, _score bigint, _h1 bigint, _h2 bigint"
_FOUND = "_h1 bigint, _h2 bigint, _score bigint, _ids array<bigint>"
#: Below every score.
_NONE = -(1 << 58)


def _gather(points: DataFrame, shared, keep: int, lists: int) -> DataFrame:
    """Phase 1: every task's ``keep`` best local scores per query and list."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value[0]
        held: dict[int, tuple] = {}
        for batch in batches:
            h1, h2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in KEY)
            for numbers, q, at, x in _parts(batch, queries):
                local = _local_scores(x, q, lists)
                score = sum(local)
                for j, s in enumerate(local):
                    width = min(keep, s.shape[1])
                    top = np.argpartition(s, s.shape[1] - width, axis=1)[:, s.shape[1] - width :]
                    rows = np.arange(len(q))[:, None]
                    new = (np.repeat(numbers, width), s[rows, top].ravel(), score[rows, top].ravel(), h1[at][top].ravel(), h2[at][top].ravel())
                    new = tuple(np.concatenate(c) for c in zip(held[j], new)) if j in held else new
                    order = best(new[0], new[1], new[3], keep)
                    held[j] = tuple(c[order] for c in new)
        for j, (number, local, score, a, b) in held.items():
            columns = [number.astype(np.int32), np.full(len(number), j, dtype=np.int32), local.astype(np.int64), score.astype(np.int64), a, b]
            yield pa.record_batch([pa.array(c) for c in columns], names=["_q", "_list", "_local", "_score", *KEY])

    return points.select("_v", *KEY).mapInArrow(gather, _ENTRY)


def cutoffs(entries: DataFrame, keep: int, lists: int) -> DataFrame:
    """Per query ``_q``: the safe bound ``_bound`` (null below ``keep`` rows) and the tops of the lists ``_tops``."""
    tops = entries.groupBy("_q").agg(
        F.array(*[F.max(F.when(F.col("_list") == j, F.col("_local"))) for j in range(lists)]).alias("_tops")
    )
    seen = entries.select("_q", "_score", *KEY).distinct()  # a row may be in several lists
    rank = F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("_score")))
    bound = seen.withColumn("_rank", rank).where(F.col("_rank") == keep).select("_q", F.col("_score").alias("_bound"))
    return tops.join(bound, "_q", "left")


def _resolve(points: DataFrame, shared, keep: int, lists: int) -> DataFrame:
    """Phases 2 and 3: rows within the gap of some list's top, resolved; every task's ``keep`` best per query."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, key, bound, tops = shared.value
        kth = bound.copy()  # the task's k-th best score so far, never below the bound
        held = [np.zeros(0, dtype=np.int64) for _ in range(3)]  # query, score, smallest id
        ids = np.zeros(0, dtype=object)
        for batch in batches:
            found = batch.column(batch.schema.get_field_index("_ids"))
            for numbers, q, at, x in _parts(batch, queries):
                local = _local_scores(x, q, lists)
                m = len(local)
                gap = tops[numbers, :m].sum(axis=1) - kth[numbers]
                near = [m * s.astype(np.int64) >= (m * tops[numbers, j] - gap)[:, None] for j, s in enumerate(local)]
                a, b = np.nonzero(np.logical_or.reduce(near))
                # an unseen local score is below its cutoff: top - gap / lists
                most = sum(
                    np.where(n[a, b], m * s[a, b].astype(np.int64), m * tops[numbers, j][a] - gap[a])
                    for j, (n, s) in enumerate(zip(near, local))
                )
                left = np.flatnonzero(most >= m * kth[numbers][a])
                a, b = a[left], b[left]
                score = sum(s[a, b].astype(np.int64) for s in local)
                good = np.flatnonzero(score >= kth[numbers][a])
                a, b, score = a[good], b[good], score[good]
                if not len(a):
                    continue
                used, place = np.unique(at[b], return_inverse=True)
                lists_of = np.empty(len(used), dtype=object)
                lists_of[:] = found.take(pa.array(used)).to_pylist()
                first = np.array([i[0] for i in lists_of], dtype=np.int64)[place]
                held = [np.concatenate(c) for c in zip(held, (numbers[a], score, first))]
                ids = np.concatenate([ids, lists_of[place]])
                order = best(*held, keep)
                held, ids = [c[order] for c in held], ids[order]
                own, start, count = np.unique(held[0], return_index=True, return_counts=True)
                full = count == keep
                kth[own[full]] = np.maximum(kth[own[full]], held[1][(start + count - 1)[full]])
        yield pa.record_batch(
            [*(pa.array(h[held[0]]) for h in key), pa.array(held[1]), pa.array(ids.tolist(), pa.list_(pa.int64()))],
            names=[*KEY, "_score", "_ids"],
        )

    return points.select("_v", "_ids").mapInArrow(resolve, _FOUND)


def _block(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The query vectors of one block by their length, with their numbers in the block."""
    out: dict[int, list] = {}
    done = 0
    for batch in table.to_batches():
        for at, q in matrices(batch):
            out.setdefault(q.shape[1], []).append((at + done, q))
        done += batch.num_rows
    return {size: tuple(np.concatenate(c) for c in zip(*parts)) for size, parts in out.items()}


def exact_top_k(
    rows: DataFrame,
    query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    lists: int = LISTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` rows of highest integer inner product with every row that ``query`` picks, against all rows.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; fewer than ``k`` rows where there are no more.
    Ids must be integers.
    """
    spark = rows.sparkSession
    whole = written(integer_rows(rows, id_col, vec_col, scale, F.coalesce(query, F.lit(False)).alias("_asked")), "integer-vectors")
    ids = whole.where("_asked").select(F.col("_id").alias("query_id"), *KEY)
    size = whole.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("_v")).alias("width")).first()
    own = ids.groupBy("query_id").count().agg(F.max("count").alias("rows")).first()
    keep = k + (own.rows or 0)  # rows of the query's own id may be among its best
    wide, cores = size.width or 1, spark.sparkContext.defaultParallelism
    # at least as many files as cores, so that all of them read
    files = max(cores, math.ceil(size.rows * wide * 4 / TASK_BYTES))
    points = written(classes(whole.select("_id", "_v", *KEY), keep).repartition(files), "vector-classes")
    asked = written(whole.where("_asked").select(*KEY, "_v").distinct(), "queries")
    blocks = max(1, math.ceil(asked.count() * wide * 8 / block_bytes))
    folder = shared_folder(spark, "top-k")
    spark.createDataFrame([], _FOUND).write.parquet(f"{folder}/block=none")
    for n in range(blocks):
        table = asked.where(F.pmod("_h1", F.lit(blocks)) == n).toArrow()
        queries, key = _block(table.select(["_v"])), [table[c].to_numpy() for c in KEY]
        entries = written(_gather(points, spark.sparkContext.broadcast((queries,)), keep, lists), "local-scores")
        bound, tops = np.full(len(table), _NONE), np.zeros((len(table), lists), dtype=np.int64)
        for at in cutoffs(entries, keep, lists).toLocalIterator():  # one row per query of the block
            tops[at._q] = [t or 0 for t in at._tops]
            if at._bound is not None:
                bound[at._q] = at._bound
        found = _resolve(points, spark.sparkContext.broadcast((queries, key, bound, tops)), keep, lists)
        found.write.parquet(f"{folder}/block={n}")
    found = spark.read.schema(_FOUND).parquet(f"{folder}/block=*").select(*KEY, "_score", F.explode("_ids").alias("vec_id"))
    order = [F.desc("_score"), F.asc("vec_id")]
    first = found.withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).where(F.col("_rank") <= keep)
    others = ids.join(first, KEY).where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", *KEY).orderBy(*order))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query_id").cast("bigint").alias("query_id"), "rank", "vec_id", F.col("_score").alias("score")
    )
