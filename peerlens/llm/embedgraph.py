"""Embedding near-duplicates over a robust-pruned flat graph built on overlapping cluster shards.

1. Equal vectors of a block (equal label, equal length) form a class; only class representatives go on.
2. A block is cut into overlapping cells until none is too large: pivots are picked farthest-first
   from a small sample of the cell, and a vector goes to its nearest pivot and to every pivot that is nearer than that one plus
   ``margin`` (in cosine), so that vectors near a border are in both cells.  A cell whose vectors are all
   close to each other cannot be cut so; it is dealt into parts, and every pair of parts becomes a cell.  The same
   cut is made twice: coarse cells, which are searched, and in them small cells, on which the graph is built.
3. Each small cell links its vectors to their nearest ones and prunes the lists robustly: a candidate
   goes if a kept neighbour is ``alpha`` times nearer to it than the vector is.  The lists of a vector from all its small cells are united.
4. In each coarse cell every vector is a query: a greedy beam search starts from the medoids of the small cells; every
   vector found within the range (cosine ``least`` minus ``slack``) is expanded in turn, as is the query itself, until no new one turns up.
5. Pairs found are verified in double precision.  A pair that several coarse cells share is counted in the first of them.
   Cells report the number of links and the local component of each vector, never lists of pairs.
6. The recall is audited: the vectors of all ids divisible by 50 are compared with all vectors by brute force, a bounded
   number at a time, and the recall is averaged over them; below ``recall`` everything is repeated with twice the margin, and fails in the end if that does not help.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import connected_components, written

COSINE = 0.93
SEARCH_ROWS = 8192
BUILD_ROWS = 1024
PIVOTS = 16
MARGIN = 0.08
DEGREE = 16
CANDIDATES = 48
BEAM = 24
ALPHA = 1.2
SLACK = 0.03
#: Pivots are at least so different; a cell without two such vectors in its sample is dense.
APART = 0.8
#: Audit queries compared in one pass.
AUDIT_QUERIES = 4096
RECALL = 0.95


def comparable(vec: Column, label: Column) -> Column:
    """Vectors that can link: a label, and finite components that are not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit_rows(vectors) -> np.ndarray:
    """Rows of length 1 in double precision."""
    v = np.array([np.asarray(x, dtype=np.float64) for x in vectors])
    v /= np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


# -- cells -------------------------------------------------------------------
def _pivots(sample: pd.DataFrame) -> pd.DataFrame:
    """Farthest-first pivots of a cell's sample; a single one for a dense cell."""
    sample = sample.sort_values("_order", kind="stable")
    v = unit_rows(sample["_vec"])
    chosen, nearest = [0], v @ v[0]
    while len(chosen) < PIVOTS:
        k = int(nearest.argmin())
        if nearest[k] > APART:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, v @ v[k])
    return pd.DataFrame({"_cell": [sample["_cell"].iloc[0]], "_pivots": [v[chosen].ravel().tolist()], "_n": [len(chosen)]})


def _cells(points: DataFrame, most: int, margin: float, rounds: int = 12) -> DataFrame:
    """``points`` (with ``_cell``) dealt into overlapping cells of at most ``most`` rows, as far as they can be cut."""
    done = None
    for level in range(rounds):
        sizes = points.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"))
        large = written(sizes.where(F.col("_rows") > most), "large-cells")
        if large.isEmpty():
            break
        small = points.join(large, "_cell", "left_anti")
        done = small if done is None else done.union(small)
        todo = points.join(large, "_cell")
        draw = F.xxhash64("_key", F.lit(level))
        share = F.lit(8.0 * PIVOTS) / F.col("_rows") * F.lit(2.0**64) - F.lit(2.0**63)
        sample = todo.where(draw.cast("double") < share).select("_cell", "_vec", draw.alias("_order"))
        pivots = sample.groupBy("_cell").applyInPandas(_pivots, "_cell string, _pivots array<double>, _n int")
        dealt = todo.join(pivots, "_cell", "left").drop("_cell", "_pivots", "_n").columns

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for (cell, n), part in rows.groupby(["_cell", "_n"], sort=False, dropna=False):
                    if not n > 1 or level >= 6:  # dense (or not getting smaller): pairs of parts
                        parts = int(-(-part["_rows"].iloc[0] // max(1, most // 2)))
                        own = part["_draw"].to_numpy() % parts
                        where = [[f"{cell}/{min(a, b)}+{max(a, b)}" for b in range(parts) if b != a] for a in own]
                    else:
                        p = np.array(part["_pivots"].iloc[0]).reshape(int(n), -1)
                        cosine = unit_rows(part["_vec"]) @ p.T
                        near = cosine >= cosine.max(axis=1, keepdims=True) - margin
                        where = [[f"{cell}/{k}" for k in np.flatnonzero(r)] for r in near]
                    yield part.assign(_cell=where).explode("_cell")[[*dealt, "_cell"]].drop(columns="_rows")

        spread = todo.join(pivots, "_cell", "left").withColumn("_draw", F.pmod(F.xxhash64("_key", F.lit(-1 - level)), F.lit(1 << 30)))
        kinds = {f.name: f.dataType.simpleString() for f in points.schema.fields}
        order = [c for c in dealt if c != "_rows"]
        schema = ", ".join(f"{c} {kinds[c]}" for c in order) + ", _cell string"
        points = written(spread.mapInPandas(deal, schema).select(*points.columns), "cells")
    return points if done is None else written(done.unionByName(points), "cells")


# -- graph -------------------------------------------------------------------
def robust_prune(v: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA) -> np.ndarray:
    """Pruned neighbour lists (rows x degree, -1 for none) of a small cell."""
    n = len(v)
    width = min(candidates, n - 1)
    out = np.full((n, degree), -1, dtype=np.int64)
    if width < 1:
        return out
    distance = np.maximum(0, 2 - 2 * (v @ v.T)).astype(np.float32)
    np.fill_diagonal(distance, np.inf)
    near = np.argpartition(distance, width - 1, axis=1)[:, :width]
    rows = np.arange(n)
    left = distance[rows[:, None], near]
    own = left.copy()
    for k in range(degree):
        pick = left.argmin(axis=1)
        alive = np.isfinite(left[rows, pick])
        if not alive.any():
            break
        kept = near[rows, pick]
        out[alive, k] = kept[alive]
        between = distance[kept[:, None], near]
        left[(alpha * between <= own) & alive[:, None]] = np.inf
        left[rows, pick] = np.inf
    return out


def both_ways(graph: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists with every link in both directions."""
    a, k = np.nonzero(graph >= 0)
    b, n = graph[a, k], len(graph)
    code = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(code % n, np.searchsorted(code // n, np.arange(1, n)))


def _build(cell: pd.DataFrame) -> pd.DataFrame:
    v, keys = unit_rows(cell["_vec"]), cell["_key"].to_numpy()
    graph = both_ways(robust_prune(v))
    medoid = np.zeros(len(v), dtype=bool)
    medoid[int((v @ v.mean(axis=0)).argmax())] = True
    return pd.DataFrame(
        {"_coarse": cell["_coarse"], "_key": keys, "_to": [keys[r].tolist() for r in graph], "_medoid": medoid}
    )


def range_search(
    v: np.ndarray, lists: list[np.ndarray], medoids: np.ndarray, least: float, slack: float = SLACK, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """(query, other) pairs with cosine of at least ``least``, every row a query.

    ``lists``: the neighbours of every row.  The beam looks at the first ``2 * beam`` neighbours of a row, the
    range expansion at all.
    """
    n = len(v)
    degree = np.array([len(x) for x in lists], dtype=np.int64)
    first, flat = np.cumsum(degree) - degree, np.concatenate([*lists, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    graph = np.full((n, max(1, min(2 * beam, int(degree.max(initial=0))))), -1, dtype=np.int64)
    for i, row in enumerate(lists):
        graph[i, : min(len(row), graph.shape[1])] = row[: graph.shape[1]]
    low = v.astype(np.float32)
    found_a, found_b = [], []
    for start in range(0, n, 512):
        queries = np.arange(start, min(n, start + 512))
        m = len(queries)
        seen = np.zeros((m, n), dtype=bool)
        entry = low[queries] @ low[medoids].T
        width = min(beam, len(medoids))
        best = np.argpartition(-entry, width - 1, axis=1)[:, :width]
        ids, sims = medoids[best], np.take_along_axis(entry, best, axis=1)
        seen[np.arange(m)[:, None], ids] = True
        fresh = np.ones(ids.shape, dtype=bool)
        active = np.arange(m)
        hits_q, hits_n = [np.repeat(np.arange(m), width)[(sims >= least - slack).ravel()]], [ids[sims >= least - slack]]
        while len(active):
            # expand each query's best candidate that is still open
            score = np.where(fresh[active], sims[active], -9)
            pick = score.argmax(axis=1)
            active = active[score[np.arange(len(active)), pick] > -9]
            if not len(active):
                break
            pick = pick[: len(pick)] if len(pick) == len(active) else np.where(fresh[active], sims[active], -9).argmax(axis=1)
            fresh[active, pick] = False
            near = graph[ids[active, pick]]
            open_ = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            q, c = np.nonzero(open_)
            node, who = near[q, c], active[q]
            seen[who, node] = True
            sim = np.einsum("ij,ij->i", low[queries[who]], low[node])
            close = sim >= least - slack
            hits_q.append(who[close]), hits_n.append(node[close])
            added = np.full(near.shape, -9, dtype=np.float32)
            added[q, c] = sim
            all_sims = np.concatenate([sims[active], added], axis=1)
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_fresh = np.concatenate([fresh[active], open_], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            sims[active] = np.take_along_axis(all_sims, top, axis=1)
            ids[active] = np.maximum(np.take_along_axis(all_ids, top, axis=1), 0)
            fresh[active] = np.take_along_axis(all_fresh, top, axis=1)
        # range expansion: from the query itself and everything within the range
        who, node = np.concatenate([np.arange(m), *hits_q]), np.concatenate([queries, *hits_n])
        seen[np.arange(m), queries] = True
        while len(who):
            found_a.append(queries[who]), found_b.append(node)
            grown_q, grown_n = [], []
            steps = np.cumsum(degree[node])
            cuts = np.searchsorted(steps, np.arange(1 << 20, int(steps[-1]) + (1 << 20), 1 << 20)) + 1
            for part in np.split(np.arange(len(who)), np.minimum(cuts[:-1], len(who))):
                size = degree[node[part]]
                q2 = np.repeat(who[part], size)
                n2 = flat[np.repeat(first[node[part]], size) + np.arange(len(q2)) - np.repeat(np.cumsum(size) - size, size)]
                open_ = ~seen[q2, n2]
                code = np.unique(q2[open_] * n + n2[open_])
                q2, n2 = code // n, code % n
                seen[q2, n2] = True
                close = np.einsum("ij,ij->i", low[queries[q2]], low[n2]) >= least - slack
                grown_q.append(q2[close]), grown_n.append(n2[close])
            who, node = np.concatenate(grown_q), np.concatenate(grown_n)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    both = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = both // n, both % n
    parts = [np.einsum("ij,ij->i", v[a[k : k + 262144]], v[b[k : k + 262144]]) >= least for k in range(0, len(a), 262144)]
    good = (a != b) & np.concatenate(parts) if parts else np.zeros(0, bool)
    return a[good], b[good]


def _searched(cell: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links (weighted by copies) and the local component of every vector of a coarse cell."""
    cell = cell.sort_values("_key", kind="stable").reset_index(drop=True)
    keys = cell["_key"].to_numpy()
    at = {k: i for i, k in enumerate(keys)}
    lists = [np.array([at[x] for x in row if x in at] if row is not None else [], dtype=np.int64) for row in cell["_to"]]
    medoids = np.flatnonzero(cell["_medoid"].fillna(False).to_numpy(dtype=bool))
    if not len(medoids):
        medoids = np.array([0])
    v = unit_rows(cell["_vec"])
    a, b = range_search(v, lists, medoids, least)
    component = np.arange(len(keys))
    while True:  # smallest row reachable
        before = component.copy()
        np.minimum.at(component, a, component[b])
        component = component[component]
        if (component == before).all():
            break
    # a pair belongs to the first coarse cell that both vectors are in
    here, shared = cell["_coarse"].iloc[0], cell["_homes"].to_numpy()
    several = np.array([len(h) > 1 for h in shared])
    mine = np.ones(len(a), dtype=bool)
    for k in np.flatnonzero(several[a] & several[b]):
        mine[k] = min(set(shared[a[k]]) & set(shared[b[k]])) == here
    links = np.bincount(a[mine], weights=cell["_copies"].to_numpy()[b[mine]], minlength=len(keys)).astype(np.int64)
    return pd.DataFrame({"_key": keys, "_links": links, "_near": keys[component]})


def _linked(classes: DataFrame, least: float, margin: float) -> DataFrame:
    """``_key``, ``_links``, ``_near`` per class and coarse cell, written."""
    coarse = _cells(classes.select("_key", "_vec", "_copies", F.col("_block").alias("_cell")), SEARCH_ROWS, margin)
    fine = _cells(coarse.select("_key", "_vec", F.col("_cell").alias("_coarse"), "_cell"), BUILD_ROWS, margin)
    lists = fine.groupBy("_cell").applyInPandas(_build, "_coarse string, _key binary, _to array<binary>, _medoid boolean")
    union = lists.groupBy("_coarse", "_key").agg(
        F.array_distinct(F.flatten(F.collect_list("_to"))).alias("_to"), F.max("_medoid").alias("_medoid")
    )
    homes = coarse.groupBy("_key").agg(F.sort_array(F.collect_set("_cell")).alias("_homes"))
    ready = coarse.withColumnRenamed("_cell", "_coarse").join(homes, "_key").join(union, ["_coarse", "_key"], "left")
    return written(
        ready.groupBy("_coarse").applyInPandas(lambda cell: _searched(cell, least), "_key binary, _links long, _near binary"), "searched"
    )


def audited_recall(classes: DataFrame, links: DataFrame, ids: DataFrame, id_col: str, least: float, most: int = AUDIT_QUERIES) -> float:
    """Mean share of its true links that was found, over the audit queries that have any (1.0 if none has).

    Queries: the different vectors of all ids divisible by 50 (of ids that are no integers: those whose hash is), about ``most`` at a time; each is compared with all vectors of its block.
    """
    number = F.col(id_col) if isinstance(ids.schema[id_col].dataType, T.IntegralType) else F.xxhash64(id_col)
    queries = ids.where(number % 50 == 0).select("_key").distinct()
    parts = max(1, -(-queries.count() // most))
    queries = written(queries.join(classes, "_key").select("_key", "_block", "_vec", F.pmod(F.xxhash64("_key"), F.lit(parts)).alias("_part")), "audit")
    total, asked = 0.0, 0
    for k in range(parts):
        some = queries.where(F.col("_part") == k).collect()
        if not some:
            continue
        mean, n = _audited(classes, links, some, least)
        total, asked = total + mean * n, asked + n
    return total / asked if asked else 1.0


def _audited(classes: DataFrame, links: DataFrame, some: list, least: float) -> tuple[float, int]:
    """(mean recall, number) of those of some queries that have true links to other vectors."""
    blocks: dict[str, tuple[list[bytes], np.ndarray]] = {}
    for block in {r["_block"] for r in some}:
        own = [r for r in some if r["_block"] == block]
        blocks[block] = [bytes(r["_key"]) for r in own], unit_rows([r["_vec"] for r in own])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for block, part in rows.groupby("_block"):
                if block in blocks:
                    keys, queries = blocks[block]
                    for at in range(0, len(part), 1024):
                        few = part.iloc[at : at + 1024]
                        hit = unit_rows(few["_vec"]) @ queries.T >= least
                        yield pd.DataFrame({"_key": keys, "_true": few["_copies"].to_numpy() @ hit})

    true = classes.mapInPandas(compare, "_key binary, _true long").groupBy("_key").agg(F.sum("_true").alias("_true"))
    others = F.col("_true") - F.col("_copies")
    found = F.coalesce("_links", F.lit(0)) - (F.col("_copies") - 1)  # without the links between copies
    row = true.join(classes.select("_key", "_copies"), "_key").join(links, "_key", "left").where(others > 0).agg(
        F.avg(F.least(found / others, F.lit(1.0))).alias("mean"), F.count(F.lit(1)).alias("n")
    ).first()
    return row["mean"] or 0.0, row["n"]


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    least: float = COSINE, margin: float = MARGIN, recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: ``id_col``, ``n_links``, ``component_id``, ``kept``, ``recall``.

    Two vectors of equal, non-null label and equal length are linked if their cosine in double precision is at least
    ``least``; equal vectors are.  ``n_links`` counts the other rows linked directly (repeated rows each),
    ``component_id`` is the smallest id reachable, ``kept`` says that it is the row's own.  Vectors that are null, empty, zero or hold null or
    non-finite components, and those without a label, link with nothing: 0 links, their own component.  Null ids take part but are no
    component id unless all of a component are null (then ``kept`` is true for them).  Ids may be of any type that has an order.  ``recall`` is the audited recall.  An empty table gives no rows.
    """
    label, vec = F.col(label_col), F.col(vec_col)
    as_text = F.concat_ws(",", vec.cast("array<double>").cast("array<string>"))
    rows = written(
        vectors.select(
            F.col(id_col).alias("_id"), vec.cast("array<double>").alias("_vec"),
            F.when(comparable(vec, label), F.concat_ws("|", label.cast("string"), F.size(vec))).alias("_block"), as_text.alias("_text"),
        ).withColumn("_key", F.when(F.col("_block").isNotNull(), F.unhex(F.md5(F.concat_ws("|", "_block", "_text"))))).drop("_text"),
        "vectors",
    )
    classes = written(
        rows.where("_key is not null").groupBy("_key").agg(
            F.any_value("_block").alias("_block"), F.any_value("_vec").alias("_vec"), F.min("_id").alias("_head"), F.count(F.lit(1)).alias("_copies")
        ), "vector-classes",
    )
    ids = rows.where("_key is not null").select(F.col("_id").alias(id_col), "_key")
    for attempt in range(4):
        searched = _linked(classes, least, margin * 2**attempt)
        links = searched.groupBy("_key").agg(F.sum("_links").alias("_others"))
        # links to other rows: those of other classes, and the other copies
        counted = classes.join(links, "_key", "left").select(
            "_key", "_head", (F.coalesce("_others", F.lit(0)) + F.col("_copies") - 1).alias("_links")
        )
        reached = audited_recall(classes, counted, ids, id_col, least)
        if reached >= recall:
            break
    else:
        raise RuntimeError(f"audited recall {reached:.3f} is below {recall}")
    edges = searched.where("_key != _near").select(F.col("_key").alias("a"), F.col("_near").alias("b"))
    component = connected_components(written(edges, "vector-links"))
    member = counted.join(component.withColumnRenamed("node", "_key"), "_key", "left").withColumn("comp", F.coalesce("comp", "_key"))
    heads = member.groupBy("comp").agg(F.min("_head").alias("_least"))
    result = member.join(heads, "comp").select("_key", "_links", "_least")
    return rows.select("_id", "_key").join(result, "_key", "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_least", "_id").alias("component_id"),
        F.col("_id").eqNullSafe(F.coalesce("_least", "_id")).alias("kept"),
        F.lit(float(reached)).alias("recall"),
    )
