"""K-d tree sharding: split at distributed weighted medians until every leaf has its share of the bytes.

Rows are points in a space of integer metadata, all taken from the text: length class, bytes per character,
line count class and a checksum.  A node that holds the rows of ``k`` shards is split in ``k // 2`` and the
rest, at the place where the bytes are in that proportion, along the dimension in which the node is
widest (range relative to the whole table's range).  The number of levels is the logarithm of the number of shards.

The place of a split is found by distributed histograms: all nodes of a level are
refined together, each round cuts the interval that holds the place into ``bins`` and sums the bytes per bin (one
pre-aggregated shuffle with nodes x bins rows), until the bin is light enough or a single value.  Ties go on
with the checksum and then with the id.  Rows of equal texts have equal metadata, so they are split up only where
a group is too heavy for the shard sizes to stay near equal.

Only DataFrame operations; the driver sees tree nodes and histogram bins, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import written

#: Dimensions in the order of preference on ties.
DIMENSIONS = ("_length", "_density", "_lines", "_crc")
SCALE = 1 << 20
BINS = 1024
#: How far a split may be off, in parts of a shard's share of the bytes: between groups of equal texts, and to keep a group whole.
SLACK = 0.005
GROUP_SLACK = 0.05


@dataclass
class Node:
    """An inner node: the rows at or before ``bounds`` (in the order of ``keys``) go left."""

    keys: tuple[str, ...] = ()
    bounds: tuple[int, ...] = ()
    left: Node | int = 0
    right: Node | int = 0


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, size (UTF-8 bytes plus 8), checksum and the metadata dimensions of every row (ties: by id, or by its hash if it is no integer)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    octets = F.octet_length(text).cast("long")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    number = F.col(id_col) if isinstance(docs.schema[id_col].dataType, T.IntegralType) else F.xxhash64(id_col)
    return docs.select(
        F.col(id_col).alias("_id"),
        (octets + 8).alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        (F.log2(octets + 1) * SCALE).cast("long").alias("_length"),
        (octets * SCALE / F.greatest(F.length(text), F.lit(1))).cast("long").alias("_density"),
        (F.log2(lines + 1.0) * SCALE).cast("long").alias("_lines"),
        F.when(F.col(id_col).isNotNull(), number.cast("long")).otherwise(F.lit(-(1 << 62))).alias("_tie"),
    )


def _before(keys: tuple[str, ...], bounds: tuple[int, ...]) -> Column:
    """Rows at or before a bound in the lexicographic order of the keys."""
    out = F.col(keys[-1]) <= bounds[-1] if len(keys) == len(bounds) else F.lit(True)
    for key, bound in zip(reversed(keys[: len(bounds) - 1]), reversed(bounds[:-1])):
        out = (F.col(key) < bound) | ((F.col(key) == bound) & out)
    return out


def _place(tree: Node | int) -> Column:
    """The shard of a row, as one expression over the metadata."""
    if isinstance(tree, int):
        return F.lit(tree)
    keys = tree.keys[: len(tree.bounds)]
    return F.when(_before(keys, tree.bounds), _place(tree.left)).otherwise(_place(tree.right))


@dataclass
class _Search:
    """The search for the place of one node's split."""

    keys: tuple[str, ...]
    goal: float  # bytes wanted on the left
    spans: dict[str, tuple[int, int]]  # range of each key in the node
    fixed: tuple[int, ...] = ()
    low: int = 0
    high: int = 0
    done: float = 0.0  # bytes before the interval
    bounds: tuple[int, ...] | None = None

    def enter(self) -> None:
        self.low, self.high = self.spans[self.keys[len(self.fixed)]]

    def key(self) -> str:
        return self.keys[len(self.fixed)]

    def width(self, bins: int) -> int:
        return max(1, -(-(self.high - self.low + 1) // bins))

    def inside(self) -> Column:
        out = F.col(self.key()).between(self.low, self.high)
        for key, value in zip(self.keys, self.fixed):
            out = out & (F.col(key) == value)
        return out

    def take(self, sums: dict[int, float], bins: int, slack: float, group_slack: float) -> None:
        """Narrow down by one round's histogram, or settle the bound."""
        width, at = self.width(bins), self.done
        best = None
        for b in sorted(sums):
            after = at + sums[b]
            if after >= self.goal:
                best = b, at, after
                break
            at = after
        if best is None:  # rounding at the upper end
            b = max(sums, default=0)
            best = b, self.done + sum(v for k, v in sums.items() if k != b), self.done + sum(sums.values())
        b, before, after = best
        first, last = self.low + b * width, min(self.high, self.low + (b + 1) * width - 1)
        near_end = after - self.goal <= self.goal - before
        off = min(after - self.goal, self.goal - before)
        group = width == 1 and self.key() == "_crc" and off <= group_slack
        if off <= slack or group or (width == 1 and len(self.fixed) + 1 == len(self.keys)):
            edge = last if near_end else first - 1
            self.bounds = (*self.fixed, edge)
        elif width == 1:
            self.fixed, self.done = (*self.fixed, first), before
            self.enter()
        else:
            self.low, self.high, self.done = first, last, before


def _grow(points: DataFrame, shards: int, bins: int, slack: float, group_slack: float) -> Node | int:
    """The tree over written points: one pass of histograms per refinement, all nodes of a level together."""
    spans = {c: (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")) for c in (*DIMENSIONS, "_tie")}
    ranges = [e for pair in spans.values() for e in pair]
    whole = points.agg(F.sum("_size").alias("bytes"), *ranges).first()
    if not whole.bytes:
        return _even(0, shards)
    share = whole.bytes / shards
    root: list = [None]
    level = [(0, shards, root, 0)]  # first shard, number of shards, parent slot
    tree_of = lambda: root[0]
    while level:
        # leaf numbers of the tree so far tell the nodes of this level apart
        where = _place(tree_of()) if root[0] is not None else F.lit(0)
        open_ = {first: (first, k, holder, side) for first, k, holder, side in level if k > 1}
        stats = {
            r["_node"]: r
            for r in points.groupBy(where.alias("_node")).agg(F.sum("_size").alias("bytes"), *ranges).collect()
        }
        searches: dict[int, _Search] = {}
        for first, (_, k, _, _) in open_.items():
            r = stats.get(first)
            if r is None:
                continue
            span = {c: (r[f"{c}_lo"], r[f"{c}_hi"]) for c in spans}
            wide = [(span[c][1] - span[c][0]) / max(1, whole[f"{c}_hi"] - whole[f"{c}_lo"]) for c in DIMENSIONS]
            axis = DIMENSIONS[wide.index(max(wide))]
            keys = tuple(dict.fromkeys((axis, "_crc", "_tie")))
            searches[first] = _Search(keys, r.bytes * (k // 2) / k, span)
            searches[first].enter()
        while todo := {n: s for n, s in searches.items() if s.bounds is None}:
            node = F.col("_node")
            bin_, inside = F.lit(None).cast("long"), F.lit(False)
            for n, s in todo.items():
                here = (node == n) & s.inside()
                inside = inside | here
                bin_ = F.when(here, F.floor((F.col(s.key()) - s.low) / s.width(bins))).otherwise(bin_)
            tagged = points.withColumn("_node", where).where(inside)
            sums: dict[int, dict[int, float]] = {n: {} for n in todo}
            for r in tagged.groupBy("_node", bin_.alias("_bin")).agg(F.sum("_size").alias("bytes")).collect():
                sums[r["_node"]][r["_bin"]] = r.bytes
            for n, s in todo.items():
                s.take(sums[n], bins, slack * share, group_slack * share)
        below = []
        for first, k, holder, side in level:
            if k == 1:
                continue
            s, half = searches.get(first), k // 2
            node = Node(s.keys if s else ("_crc",), s.bounds if s else (-1,), first, first + half)
            _attach(holder, side, node)
            below += [(first, half, node, 0), (first + half, k - half, node, 1)]
        level = below
    return root[0] if root[0] is not None else 0


def _attach(holder, side: int, node: Node) -> None:
    if isinstance(holder, list):
        holder[0] = node
    elif side == 0:
        holder.left = node
    else:
        holder.right = node


def _even(first: int, k: int) -> Node | int:
    if k == 1:
        return first
    return Node(("_crc",), (-1,), _even(first, k // 2), _even(first + k // 2, k - k // 2))


def kd_shards(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS,
    slack: float = SLACK, group_slack: float = GROUP_SLACK, slot_rows: int = 50_000,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Shards 0 to ``shards`` - 1 have near equal bytes: each split is within ``slack`` of a shard's share (``group_slack``
    where that keeps a group of equal texts whole), or falls on a single row.  ``size``: UTF-8 bytes of the text (null: none) plus 8; ``text_crc32``: checksum of those bytes.  ``slot`` numbers the rows of a shard
    from 0 without gaps, in no stated order.  Rows of one text are in one shard unless the group is too
    heavy.  Ids may be of any type that has an order.  Null ids sort first; repeated rows are numbered apart.  Other columns are not read.
    An empty table gives no rows.
    """
    points = written(measured(docs, id_col, text_col), "points")
    tree = _grow(points, shards, bins, slack, group_slack)
    total = points.count()
    # Slots: rows are dealt by a hash into blocks of bounded size; a block's first slot is the number of rows in the blocks before it.
    blocks = max(1, -(-total // slot_rows))
    placed = points.withColumn("shard", _place(tree).cast("int")).withColumn(
        "_block", F.pmod(F.xxhash64("_id", "_crc"), F.lit(blocks)).cast("int")
    )
    sizes = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_block").orderBy("_id", "_crc")
    numbered = placed.withColumn("_n", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "_block"]).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        (F.col("_first") + F.col("_n")).cast("long").alias("slot"),
    )
