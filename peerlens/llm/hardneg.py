"""Hard negatives by best-first search in STR-packed R-trees.

1. Rows of equal label and equal vector form a class with a few ids (:mod:`peerlens.llm.intvectors`); classes are dealt into
   shards, by label and vector length first, then by sort-tile-recursive cuts: a shard of over ``shard_bytes`` is cut into slabs
   along its coordinate of largest variance, at quantiles that Spark finds for all shards of a level together, and the slabs are cut along theirs.
   Ties at a cut are dealt by a hash, so equal components cannot keep a shard large.
2. In each shard the rows are packed the same way into leaves of ``LEAF`` rows; ``FANOUT`` consecutive boxes make a box of the
   next level.  The packed rows and the minimum bounding boxes are written, one row per shard.
3. A box [lo, hi] bounds the inner product with an anchor: per coordinate the product lies between that with lo and
   that with hi, and the sums of the smaller and of the larger ones bound the whole.  The search takes boxes from a queue, the
   highest bound first, and drops a box if its interval meets no open score window or if it lies strictly below
   the k-th best score of every window it meets (equal ones stay: a smaller id may win).  All windows of an anchor share one queue.
4. Positives are searched in the shards of the anchor's label with one open window, negatives in all other shards, with one window per
   different positive score.  A task keeps its k best per window over all its shards; a ranking by score, then by smaller id, ends it.

Anchors are broadcast in blocks of about ``block_bytes``; equal anchors are searched once.  All arithmetic is on integers, exact in doubles or
else in 64 bits, so no bound needs a tolerance.

Rows without a label, and those that :mod:`peerlens.llm.intvectors` leaves out, take no part; rows that repeat id, label and vector count
once; an id with several vectors is an anchor with each of them, and no positive of its own.  Vectors of other lengths have no score.
An empty table gives an empty result.  Columns beside those named are not read, so their names may clash.  Ids must be integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.common import shared_folder, written
from peerlens.llm.intvectors import KEY, best, classes, exact_type, integer_rows, matrices

LEAF = 128
FANOUT = 16
SCALE = 256
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: Shards that a task searches, where there are more tasks than cores.
TASK_SHARDS = 256
#: Slabs that one round cuts a shard into at most, and the quantiles that their ends are taken from.
SLABS = 64
#: Axes along which rows are packed inside a shard.
AXES = 4
_OPEN = 1 << 58  # beyond every score
ANCHOR = ["_label", *KEY]


# -- shards ------------------------------------------------------------------
def shard_rows(points: DataFrame, shard_bytes: int) -> DataFrame:
    """``points`` (``_label``, ``_v``, ...) with the name of their shard ``_shard``; no shard holds much over ``shard_bytes`` of vectors."""
    left = points.withColumns({"_size": F.size("_v"), "_shard": F.concat_ws("/", F.hex("_label"), F.size("_v"))})
    done = None
    while True:
        counted = left.groupBy("_shard", "_size").count()
        shards = F.ceil(F.col("count") * F.col("_size") * 4 / shard_bytes)
        large = written(counted.select("_shard", shards.alias("_shards")).where("_shards > 1"), "large-shards")
        if large.isEmpty():
            return (left if done is None else done.unionByName(left)).drop("_size")
        small = left.join(large, "_shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        todo = left.join(large, "_shard")
        spread = todo.select("_shard", F.posexplode("_v").alias("_axis", "_x")).groupBy("_shard", "_axis").agg(F.variance("_x").alias("_var"))
        axis = spread.groupBy("_shard").agg(F.max(F.struct("_var", "_axis"))["_axis"].alias("_axis"))
        place = F.get("_v", F.col("_axis")).cast("bigint") * F.lit(1 << 20) + F.pmod("_h1", F.lit(1 << 20))
        todo = written(todo.join(axis, "_shard").withColumn("_place", place), "placed-rows")
        cuts = todo.groupBy("_shard").agg(
            F.percentile_approx("_place", [i / SLABS for i in range(1, SLABS)], 50 * SLABS).alias("_cuts"),
            F.least(F.greatest(F.ceil(F.sqrt(F.max("_shards"))), F.lit(2)), F.lit(SLABS)).cast("int").alias("_slabs"),
        )
        ends = F.transform(
            F.sequence(F.lit(1), F.col("_slabs") - 1),
            lambda i: F.get("_cuts", (F.round(i * SLABS / F.col("_slabs")) - 1).cast("int")),
        )
        cuts = cuts.select("_shard", ends.alias("_ends"))
        slab = F.size(F.filter("_ends", lambda e: e < F.col("_place")))
        dealt = todo.join(cuts, "_shard").withColumn("_shard", F.concat_ws("/", "_shard", slab))
        left = written(dealt.select(*left.columns), "slabs")


def pack(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The order of the rows of ``x`` in sort-tile-recursive leaves along its widest axes."""
    axes = np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[:AXES]

    def tile(rows: np.ndarray, k: int) -> list[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or k == len(axes):
            return [rows]
        rows = rows[np.argsort(x[rows, axes[k]], kind="stable")]
        slabs = math.ceil(pages ** (1 / (len(axes) - k)))
        step = leaf * -(-pages // slabs)
        return [part for s in range(0, len(rows), step) for part in tile(rows[s : s + step], k + 1)]

    return np.concatenate(tile(np.arange(len(x)), 0))


def boxes(x: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> list[tuple[np.ndarray, np.ndarray]]:
    """(lo, hi) of the boxes of every level, from the top; the last level bounds ``leaf`` consecutive rows each."""
    at = np.arange(0, len(x), leaf)
    levels = [(np.minimum.reduceat(x, at), np.maximum.reduceat(x, at))]
    while len(levels[0][0]) > fanout:
        lo, hi = levels[0]
        at = np.arange(0, len(lo), fanout)
        levels.insert(0, (np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)))
    return levels


_INDEX = "_shard string, _label string, _width int, _x binary, _boxes array<binary>, _ids array<bigint>, _counts array<int>"


def build_index(points: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One written row per shard: packed rows, boxes by level (lo before hi), and the ids of the packed rows."""
    spark = points.sparkSession
    sharded = written(shard_rows(points, shard_bytes), "shards")

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        (_, x), = matrices(table.to_batches()[0])
        order = pack(x)
        x = np.ascontiguousarray(x[order], dtype=np.int32)
        ids = table["_ids"].take(pa.array(order)).to_pylist()
        row = {
            "_shard": table["_shard"][0].as_py(), "_label": table["_label"][0].as_py(), "_width": x.shape[1], "_x": x.tobytes(),
            "_boxes": [b.tobytes() for level in boxes(x) for b in level],
            "_ids": [i for own in ids for i in own], "_counts": [len(own) for own in ids],
        }
        kinds = [pa.string(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table({k: pa.array([v], kind) for (k, v), kind in zip(row.items(), kinds)})

    rows = sharded.select("_shard", F.col("_label").cast("string").alias("_label"), "_v", "_ids")
    files = max(2 * spark.sparkContext.defaultParallelism, math.ceil(sharded.select("_shard").distinct().count() / TASK_SHARDS))
    # a task per so many shards, whatever their bytes: a search costs far more than reading them, and what it sends does not grow with them
    return written(rows.repartition(files, "_shard").groupBy("_shard").applyInArrow(build, _INDEX), "tree")


# -- search ------------------------------------------------------------------
class Tree:
    """A shard read back: packed rows, boxes by level, ids."""

    def __init__(self, row: dict):
        self.label, width = row["_label"], row["_width"]
        read = lambda b: np.frombuffer(b, dtype=np.int32).reshape(-1, width)
        self.x = read(row["_x"])
        flat = [read(b) for b in row["_boxes"]]
        self.levels = list(zip(flat[::2], flat[1::2]))
        ends = np.cumsum(row["_counts"])
        self.ids = np.split(np.array(row["_ids"], dtype=np.int64), ends[:-1])
        self.first = np.array([i[0] for i in self.ids], dtype=np.int64)

    def cast(self, kind: type) -> None:
        self.x = self.x.astype(kind)
        self.levels = [(lo.astype(kind), hi.astype(kind)) for lo, hi in self.levels]


class Best:
    """The ``k`` best rows of every score window of one anchor."""

    def __init__(self, low: list[int], high: list[int], k: int):
        self.low, self.high, self.k = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64), k
        self.kth = np.full(len(low), -_OPEN, dtype=np.int64)
        self.rows: list[list[tuple[int, int, list[int]]]] = [[] for _ in low]  # (-score, smallest id, ids)

    def wanted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Intervals (low to high) that may still hold a row for some window."""
        low, high = low[:, None], high[:, None]
        return ((high >= self.low) & (low <= self.high) & (np.minimum(high, self.high) >= self.kth)).any(axis=1)

    def add(self, tree: Tree, start: int, score: np.ndarray) -> None:
        s = score.astype(np.int64)
        at, window = np.nonzero((s[:, None] >= np.maximum(self.low, self.kth)) & (s[:, None] <= self.high))
        if not len(at):
            return
        first = best(window, s[at], tree.first[start + at], self.k)
        for w, i in zip(window[first].tolist(), at[first].tolist()):
            self.rows[w].append((-int(s[i]), int(tree.first[start + i]), tree.ids[start + i].tolist()))
        for w in np.unique(window).tolist():
            self.rows[w] = sorted(self.rows[w])[: self.k]
            if len(self.rows[w]) == self.k:
                self.kth[w] = -self.rows[w][-1][0]


def best_first(tree: Tree, q: np.ndarray, found: Best, leaf: int = LEAF, fanout: int = FANOUT) -> int:
    """Search ``tree`` for one anchor; returns the number of leaves opened."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    top, opened = found.high.max(), 0
    queue: list[tuple[int, int, int, int, int]] = []

    def push(level: int, first: int, end: int) -> None:
        lo, hi = (b[first:end] for b in tree.levels[level])
        low, high = (lo @ up + hi @ down).astype(np.int64), (hi @ up + lo @ down).astype(np.int64)
        for i in np.flatnonzero(found.wanted(low, high)).tolist():
            heapq.heappush(queue, (-min(int(high[i]), int(top)), level, first + i, int(low[i]), int(high[i])))

    push(0, 0, len(tree.levels[0][0]))
    while queue:
        _, level, node, low, high = heapq.heappop(queue)
        if not found.wanted(np.array([low]), np.array([high]))[0]:
            continue
        if level == len(tree.levels) - 1:
            found.add(tree, node * leaf, tree.x[node * leaf : (node + 1) * leaf] @ q)
            opened += 1
        else:
            push(level + 1, node * fanout, (node + 1) * fanout)
    return opened


_FOUND = "_label string, _h1 bigint, _h2 bigint, _window bigint, _score bigint, _ids array<bigint>"


def _search(index: DataFrame, anchors: pa.Table, k: int, same: bool, limits: tuple[int, int, int]) -> DataFrame:
    """The tasks' ``k`` best classes per anchor and window, among rows of the anchor's label (``same``) or of the others.

    ``anchors`` has ``_windows``: positive scores, of which ``limits`` = (low, high, of) make windows low/of to high/of; null: one open window.
    """
    low, high, of = limits
    shared = index.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        label, windows = table["_label"].to_pylist(), table["_windows"].to_pylist()
        vector = [np.array(v, dtype=np.int64) for v in table["_v"].to_pylist()]
        found: dict[int, Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row)
                width = tree.x.shape[1]
                mine = [i for i, v in enumerate(vector) if len(v) == width and (label[i] == tree.label) == same]
                if not mine:
                    continue
                kind = exact_type(tree.x, np.array([vector[i] for i in mine]))
                tree.cast(kind)
                for i in mine:
                    if i not in found:
                        scores = windows[i]
                        found[i] = (
                            Best([-_OPEN], [_OPEN], k) if scores is None
                            else Best([-(-low * s // of) for s in scores], [high * s // of for s in scores], k)
                        )
                    best_first(tree, vector[i].astype(kind), found[i])
        h1, h2 = table["_h1"].to_pylist(), table["_h2"].to_pylist()
        out = [
            (label[i], h1[i], h2[i], windows[i][w] if windows[i] is not None else None, -less, ids)
            for i, b in found.items() for w, rows in enumerate(b.rows) for less, _, ids in rows
        ]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        columns = list(zip(*out)) if out else [()] * len(kinds)
        names = ["_label", "_h1", "_h2", "_window", "_score", "_ids"]
        yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return index.mapInArrow(search, _FOUND)


def _in_blocks(index: DataFrame, anchors: DataFrame, k: int, same: bool, limits: tuple[int, int, int], block_bytes: int) -> DataFrame:
    """The ``k`` best ids per anchor and window over all shards: ``_label``, ``_h1``, ``_h2``, ``_window``, ``_id``, ``_score``."""
    spark = index.sparkSession
    size = anchors.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("_v")).alias("width")).first()
    blocks = max(1, math.ceil(size.rows * (size.width or 1) * 8 / block_bytes))
    folder = shared_folder(spark, "r-tree-search")
    spark.createDataFrame([], _FOUND).write.parquet(f"{folder}/block=none")
    for n in range(blocks):
        table = anchors.where(F.pmod("_h1", F.lit(blocks)) == n).toArrow()
        if len(table):
            _search(index, table, k, same, limits).write.parquet(f"{folder}/block={n}")
    found = spark.read.schema(_FOUND).parquet(f"{folder}/block=*")
    window = Window.partitionBy(*ANCHOR, "_window").orderBy(F.desc("_score"), F.asc("_id"))
    each = found.select(*ANCHOR, "_window", "_score", F.explode("_ids").alias("_id"))
    return written(each.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k), "best-rows")


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    limits: tuple[int, int, int] = (30, 90, 100),
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The best different-label rows in a score window below every positive of every anchor.

    ``anchor`` picks the anchors among ``rows``.  An anchor's positives are its ``positives`` best other rows of the same ``label``, by integer inner product,
    ties to the smaller id.  For ``limits`` = (low, high, of) a negative's score lies, times ``of``, from ``low`` to ``high`` times the positive's.
    Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.
    """
    others = [label.cast("string").alias("_label"), F.coalesce(anchor, F.lit(False)).alias("_asked")]
    whole = written(integer_rows(rows.where(label.isNotNull()), id_col, vec_col, scale, *others), "integer-vectors")
    asked = whole.where("_asked")
    ids = asked.select(F.col("_id").alias("anchor_id"), *ANCHOR)
    own = ids.groupBy("anchor_id").count().agg(F.max("count").alias("rows")).first()
    first = positives + (own.rows or 0)  # rows of the anchor's own id may be among its best
    points = classes(whole.select("_id", "_label", "_v", *KEY), max(first, negatives), "_label")
    index = build_index(points, shard_bytes)

    anchors = written(asked.select(*ANCHOR, "_v").distinct(), "anchors")
    open_ = anchors.withColumn("_windows", F.lit(None).cast("array<bigint>"))
    near = _in_blocks(index, open_, first, True, limits, block_bytes)
    order = Window.partitionBy("anchor_id", *ANCHOR).orderBy(F.desc("_score"), F.asc("_id"))
    paired = ids.join(near.drop("_window", "rank"), ANCHOR).where("anchor_id != _id")
    paired = paired.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    paired = written(paired.select("anchor_id", *ANCHOR, F.col("_id").alias("positive_id"), F.col("_score").alias("_window")), "positives")

    scores = paired.groupBy(*ANCHOR).agg(F.array_sort(F.collect_set("_window")).alias("_windows"))
    hard = _in_blocks(index, anchors.join(scores, ANCHOR), negatives, False, limits, block_bytes)
    return paired.join(hard, [*ANCHOR, "_window"]).select(
        F.col("anchor_id").cast("bigint").alias("anchor_id"), "positive_id", "rank", F.col("_id").alias("negative_id"),
        F.col("_window").alias("positive_score"), F.col("_score").alias("negative_score"),
    )
