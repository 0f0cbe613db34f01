"""Exact top-k search and hard negatives against brute force."""

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from peerlens.llm import hardneg, topk
from peerlens.llm.intvectors import LARGEST, best
from peerlens.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

KIND = "vec_id bigint, embedding array<float>, label int"


def _ints(rows):
    """Different (id, integer vector, label) that take part; label as given."""
    out = []
    for i, v, label in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) or abs(x) > LARGEST for x in v):
            continue
        row = (i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v), label)
        if row not in out:
            out.append(row)
    return out


def _score(a, b):
    return sum(x * y for x, y in zip(a, b))


def _top(rows, k, asked):
    rows = {(i, v) for i, v, _ in _ints(rows)}
    out = []
    for q, v in rows:
        if asked(q):
            others = sorted((-_score(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(others)]
    return sorted(out)


def _hard(rows, asked, positives=5, negatives=10, limits=(30, 90, 100)):
    rows = [r for r in _ints(rows) if r[2] is not None]
    low, high, of = limits
    out = []
    for q, v, label in rows:
        if not asked(q):
            continue
        scored = sorted((-_score(v, w), i, other) for i, w, other in rows if len(w) == len(v))
        same = [(-s, i) for s, i, other in scored if other == label and i != q][:positives]
        for p, name in same:
            inside = [(-s, i) for s, i, other in scored if other != label and low * p <= -s * of <= high * p][:negatives]
            out += [(q, name, n + 1, i, p, s) for n, (s, i) in enumerate(inside)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    """Groups of near and exact copies, ties, odd rows."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(260):
        v = rng.normal(size=8)
        if i % 3 == 0:  # a third in one group
            v = np.ones(8) + 0.05 * v
        if i % 5 == 0:
            v = np.round(v)  # ties
        if i % 7 == 1:
            v = np.full(8, 0.5)  # one common vector
        rows.append((i, v.tolist(), int(i % 4)))
    rows += [
        (300, None, 1), (301, [], 1), (302, [float("nan")] * 8, 1), (303, [float("inf")] + [0.0] * 7, 1), (304, [None] + [1.0] * 7, 1),
        (None, [1.0] * 8, 1), (305, [1.0] * 3, 1), (310, [0.5] * 3, 1), (306, [2.0] * 3, 2), (307, [0.0] * 8, 3), (308, [1e6] * 8, 2), (309, [1.0] * 8, None),
        rows[10], rows[20], (20, [0.25] * 8, 2), (311, [60000.0] * 8, 1), (312, [60000.0] * 8, 2),
    ]
    return rows


def test_top_k_equals_brute_force(spark, vectors):
    df = spark.createDataFrame(vectors, KIND).repartition(5)
    for k, lists, block in ((5, 2, 8 << 20), (3, 3, 512), (40, 1, 4096)):
        got = topk.exact_top_k(df, F.col("vec_id") % 10 == 0, k, lists=lists, block_bytes=block)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == _top(vectors, k, lambda i: i % 10 == 0)


def test_phases_collect_less_than_all(spark, vectors):
    """The cutoff keeps rows out, and every row of the result is within it."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=32) / 6).tolist(), 0) for i in range(3000)]
    local = topk._local_scores(*(np.floor(256 * np.array([rows[j][1] for j in at])).astype(np.int64) for at in (range(3000), [0])), 2)
    score = (local[0] + local[1])[0]
    bound = np.sort(score)[-6]
    gap = sum(s.max() for s in local) - bound
    near = sum((2 * s[0] >= 2 * s.max() - gap).astype(int) for s in local) > 0
    assert near.sum() < 600 and near[np.argsort(-score)[:6]].all()
    got = topk.exact_top_k(spark.createDataFrame(rows, KIND), F.col("vec_id") == 0)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(int(i), int(score[i])) for i in np.argsort(-score)[1:6]]


def test_hard_negatives_equal_brute_force(spark, vectors):
    df = spark.createDataFrame(vectors, KIND).repartition(5)
    for shard, block in ((1 << 20, 8 << 20), (600, 300)):
        got = hardneg.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), shard_bytes=shard, block_bytes=block)
        assert sorted(map(tuple, got.collect())) == _hard(vectors, lambda i: i % 10 == 0)
    got = hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0, F.col("label"), 2, 3, (-50, 100, 100))
    assert sorted(map(tuple, got.collect())) == _hard(vectors, lambda i: i % 50 == 0, 2, 3, (-50, 100, 100))


def test_negative_window_excludes(spark):
    """A window of a negative positive score is empty; a zero one takes zero scores."""
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5, 0.0], 2), (3, [0.0, 3.0], 2), (100, [0.0, 1.0], 3), (101, [1.0, 0.0], 3)]
    got = hardneg.hard_negatives(spark.createDataFrame(rows, KIND), F.col("vec_id") % 100 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect())) == _hard(rows, lambda i: i % 100 == 0)
    assert {(r.anchor_id, r.positive_id) for r in got.collect()} == {(100, 101)}


def test_tree_prunes_and_loses_nothing():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-40, 40, size=(1, 16)) * 5 + rng.integers(-9, 9, size=(400, 16)) for _ in range(12)]).astype(np.int32)
    x = x[hardneg.pack(x)]
    row = {
        "_label": "a", "_width": 16, "_x": x.tobytes(), "_boxes": [b.tobytes() for level in hardneg.boxes(x) for b in level],
        "_ids": list(range(len(x))), "_counts": [1] * len(x),
    }
    tree = hardneg.Tree(row)
    tree.cast(np.float64)
    leaves = len(tree.levels[-1][0])
    opened = 0
    for q in x[::160].astype(np.float64):
        score = (x @ q).astype(np.int64)
        for low, high in ((-hardneg._OPEN, hardneg._OPEN), (0, int(score.max()) // 2)):
            found = hardneg.Best([low], [high], 7)
            opened += hardneg.best_first(tree, q, found)
            inside = np.flatnonzero((score >= low) & (score <= high))
            want = inside[best(np.zeros(len(inside), dtype=int), score[inside], inside, 7)]
            assert [(-s, i) for s, i, _ in found.rows[0]] == [(int(score[i]), int(i)) for i in want]
    assert opened < 0.5 * leaves * 60


def test_boxes_bound_the_scores():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, size=(1000, 5)).astype(np.int32)
    x = x[hardneg.pack(x, 16)]
    levels = hardneg.boxes(x, 16, 4)
    assert len(levels[0][0]) <= 4 and len(levels[-1][0]) == 63
    for q in rng.integers(-200, 200, size=(20, 5)):
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        lo, hi = levels[-1]
        part = np.arange(1000) // 16
        assert ((lo @ up + hi @ down)[part] <= x @ q).all() and (x @ q <= (hi @ up + lo @ down)[part]).all()


def test_shards_are_bounded(spark):
    """A label with most rows is cut, also where its rows agree in most components."""
    rng = np.random.default_rng(4)
    rows = [(i, [0.0, float(i % 2), float(rng.integers(0, 3)), float(i) / 64], 1 if i % 10 else 2) for i in range(4000)]
    df = spark.createDataFrame(rows, KIND)
    from peerlens.llm.intvectors import classes, integer_rows

    points = classes(integer_rows(df, "vec_id", "embedding", 256, F.col("label").cast("string").alias("_label")), 3, "_label")
    sizes = [r["count"] for r in hardneg.shard_rows(points, 16 * 256).groupBy("_shard").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 2 * 256 and len(sizes) <= 64


def test_empty_tables_and_clashing_columns(spark, vectors):
    empty = spark.createDataFrame([], KIND)
    assert topk.exact_top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
    assert hardneg.hard_negatives(empty, F.col("vec_id") % 100 == 0, F.col("label")).collect() == []
    nulls = spark.createDataFrame([(None, None, None), (0, None, 1)], KIND)
    assert topk.exact_top_k(nulls, F.col("vec_id") % 50 == 0).collect() == []
    assert hardneg.hard_negatives(nulls, F.col("vec_id") % 100 == 0, F.col("label")).collect() == []
    df = spark.createDataFrame(vectors, KIND)
    for c in ("_id", "_v", "_h1", "_label", "rank", "score", "query_id", "_q", "anchor_id", "_shard", "_ids"):
        df = df.withColumn(c, F.lit("x"))
    assert topk.exact_top_k(df, F.col("vec_id") == 0, 2).count() == 2
    assert sorted(map(tuple, hardneg.hard_negatives(df, F.col("vec_id") == 20, F.col("label")).collect())) == _hard(vectors, lambda i: i == 20)
    int_ids = spark.createDataFrame(vectors[:50], "vec_id int, embedding array<double>, label string")
    assert topk.exact_top_k(int_ids, F.col("vec_id") == 0).count() == 5


def test_copies_of_a_hot_vector_are_not_paired(spark):
    """Half of all rows share a vector: its class holds a few ids, and ties go to the smaller ones."""
    rows = [(i, [1.0, 2.0] if i % 2 else [float(i % 9), 1.0], i % 3) for i in range(3000)]
    got = topk.exact_top_k(spark.createDataFrame(rows, KIND), F.col("vec_id") % 50 == 25).collect()
    assert sorted(map(tuple, got)) == _top(rows, 5, lambda i: i % 50 == 25)


@pytest.mark.parametrize("name", ["op12_exact_top_k", "op13_hard_negatives"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())
