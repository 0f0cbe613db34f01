"""Near-duplicate documents and vectors, and connected components, against brute force."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from peerlens.llm import embedgraph, minhash
from peerlens.llm.common import connected_components
from tests.conftest import SF_SMALL


def _classes(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def _brute(texts, least=0.8):
    sets = {i: minhash.shingle_counts(t or "", 5, "set") for i, t in texts.items() if (t or "").split()}
    ids = sorted(sets)
    return _classes(texts, [(a, b) for k, a in enumerate(ids) for b in ids[:k] if minhash.similarity(sets[a], sets[b]) >= least])


def _words(rng, n):
    return [f"w{rng.randint(0, 3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def family():
    """A base with many copies: edited in other places, shortened, and chains of small edits."""
    rng = random.Random(4)
    base = _words(rng, 200)
    texts = {}
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 10**6)}"
        if i % 3 == 0:
            cut = rng.randrange(150)
            del copy[cut : cut + rng.randint(0, 40)]
        texts[100 + i] = " ".join(copy)
    chain = _words(rng, 120)
    for i in range(25):
        texts[300 + i] = " ".join(chain)
        chain = [*chain[6:], *_words(rng, 6)]
    for i in range(60):
        texts[500 + i] = " ".join(_words(rng, rng.randint(5, 150)))
    return texts


def test_family_equals_brute_force(spark, family):
    df = spark.createDataFrame(list(family.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert got == _brute(family)
    assert 1 < len(set(got.values())) < len(got) - 30  # copies were joined, unrelated texts not


def test_small_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in found} == _brute(texts)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in found if r.kept)


def test_edges(spark):
    rows = [
        (5, "The same  words here now again and more"), (3, "the same words\there now again and more"), (3, "the same words here now again and more"),
        (None, "the same words here now again and more"), (7, None), (8, ""), (9, " \n"), (10, "short"), (11, "Short"), (12, "other"),
        (None, "alone without an id"), (13, "a b c d e f " * 20_000), (14, "a b c d e f " * 20_000), (15, "x"), (15, "y"),
    ]
    df = spark.createDataFrame([(i, t, "c", True) for i, t in rows], "doc_id long, text string, comp string, kept boolean")
    found = minhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    classes = {(r.doc_id, r.class_id, r.kept) for r in found}
    assert (5, 3, False) in classes and (3, 3, True) in classes and (None, 3, False) in classes
    assert {(7, 7, True), (8, 8, True), (9, 9, True), (10, 10, True), (11, 10, False), (12, 12, True)} <= classes
    assert {(13, 13, True), (14, 13, False), (None, None, True), (15, 15, True)} <= classes
    kept = [(r.doc_id, r.text) for r in minhash.drop_near_duplicates(df).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [3, 7, 8, 9, 10, 12, 13, 15, 15] and len(kept) == 10
    assert minhash.near_duplicates(df.limit(0)).count() == 0 and minhash.drop_near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("weights", ["set", "count"])
def test_signatures_estimate_weighted_similarity(weights):
    rng = random.Random(2)
    base = _words(rng, 300) + ["again and again we say it so"] * 20
    other = base[:260] + _words(rng, 40) + base[300:310]
    a, b = " ".join(base), " ".join(other)
    s = minhash.signatures([a, b, "", "one"], 2000, 5, weights)
    true = minhash.similarity(*(minhash.shingle_counts(t, 5, weights) for t in (a, b)))
    assert abs((s[0] == s[1]).mean() - true) < 4 * (true * (1 - true) / 2000) ** 0.5
    assert (s[2] == minhash._EMPTY).all() and (s[3] != minhash._EMPTY).all()


def test_dart_weights_need_not_be_whole():
    element = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rng = np.random.default_rng(0)
    x, y = rng.uniform(0.2, 3, 400), rng.uniform(0.2, 3, 400)
    owner = np.zeros(400, dtype=np.int64)
    a, b = (minhash.dart_signatures(owner, element, w, 1, 3000)[0] for w in (x, y))
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((a == b).mean() - true) < 0.04


def test_weighted_near_duplicates(spark):
    base = "some words that are said once and for all times in here"
    rows = [(1, base + " yes we can do it" * 40), (2, base + " yes we can do it" * 39), (3, base + " yes we can do it" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df, weights="count").collect()} == {1: 1, 2: 1, 3: 3}


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1200)] + [(7, 7), (2000, 2001), (2001, 2000)]
    want = _classes({x for e in edges for x in e}, edges)
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    alone = {n for n in want if all(a == b or n not in (a, b) for a, b in edges)}
    assert got == {n: c for n, c in want.items() if n not in alone}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _vectors(seed=0, groups=12, dim=32):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        center = rng.normal(size=dim)
        for _ in range(rng.integers(1, 30)):
            rows.append((center + rng.normal(size=dim) * 0.18, g % 3))
    rows += [(rng.normal(size=dim), int(rng.integers(0, 3))) for _ in range(150)]
    rows += [rows[3]] * 9
    return [(i, [float(x) for x in np.float32(v)], label) for i, (v, label) in enumerate(rows)]


def _brute_vectors(rows, least=0.93):
    v = embedgraph.unit_rows([r[1] for r in rows])
    label = np.array([r[2] for r in rows])
    close = (v @ v.T >= least) & (label[:, None] == label)
    np.fill_diagonal(close, False)
    ids = [r[0] for r in rows]
    comp = _classes(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close))])
    return {i: (int(n), comp[i]) for i, n in zip(ids, close.sum(axis=1))}


@pytest.mark.parametrize("search,build", [(8192, 1024), (64, 16)])
def test_vectors_equal_brute_force(spark, monkeypatch, search, build):
    """Also with cells so small that groups are cut up and dealt in pairs of parts."""
    monkeypatch.setattr(embedgraph, "SEARCH_ROWS", search)
    monkeypatch.setattr(embedgraph, "BUILD_ROWS", build)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = embedgraph.near_duplicate_vectors(df).collect()
    want, got = _brute_vectors(rows), {r.vec_id: (r.n_links, r.component_id) for r in found}
    links, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and links >= 0.95 * true and true > 500
    if search == 8192:
        assert got == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found) and found[0].recall >= 0.95


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1e30, 1e28], 1),
    ]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links int, comp string")
    found = embedgraph.near_duplicate_vectors(df).collect()
    assert len(found) == len(rows)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found}
    assert {(1, 4, 1, True), (2, 4, 1, False), (None, 4, 1, False), (12, 4, 1, False)} <= got
    assert {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)} <= got
    assert embedgraph.near_duplicate_vectors(df.limit(0)).count() == 0


def test_rows_without_words_are_not_merged(spark):
    rows = [(None, None, 1), (None, "", 2), (None, " \n", 3), (None, "", 2), (5, None, 4), (5, "", 5), (5, "  ", 6), (5, "", 5), (6, "a b c", 7), (6, "A b  c", 8), (7, "\u00e9", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(3)
    kept = sorted(r.n for r in minhash.drop_near_duplicates(docs).collect())
    assert [n for n in kept if n not in (7, 8)] == [1, 2, 2, 3, 4, 5, 6, 9]  # of two equal rows with an id one
    assert len([n for n in kept if n in (7, 8)]) == 1


def test_audit_counts_every_query_alike(spark):
    """Small groups whose links are lost pull the recall down, however many links one large group has."""
    vec = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(f"k{i}", "b", vec(0.0001 * i), 1, i, 299) for i in range(300)]
    rows += [(f"s{g}{j}", "b", vec(1 + 0.45 * g + 0.01 * j), 1, 1000 + 50 * g + j, 0) for g in range(6) for j in range(2)]
    table = spark.createDataFrame(rows, "key string, _block string, _vec array<double>, _copies long, vec_id long, _links long").withColumn("_key", F.encode("key", "utf-8"))
    classes, links, ids = table.select("_key", "_block", "_vec", "_copies"), table.select("_key", "_links"), table.select("vec_id", "_key")
    for most in (4096, 3):  # in one pass and in several
        assert abs(embedgraph.audited_recall(classes, links, ids, "vec_id", 0.93, most) - 0.5) < 1e-9


def test_clashing_columns_and_text_ids(spark):
    rows = [("a", "one two three four five six seven", 1), ("b", "one two three four five six seven", 2), ("c", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, __near_key int").selectExpr("*", "1 AS _near_key", "2 AS __gone_id", "3 AS _gone_key")
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == ["a", "c"]
    vectors = spark.createDataFrame([(f"v{i}", [1.0, 0.1 * (i // 2)], 1) for i in range(8)], "vec_id string, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedgraph.near_duplicate_vectors(vectors).collect()}
    assert len(got) == 8 and got["v0"][1] == "v0" and got["v1"][0] >= 1


def test_hot_buckets_and_hubs_equal_brute_force(spark, family, monkeypatch):
    """With everything counted as hot and buckets compared in tiny blocks the classes are the same."""
    from peerlens.llm import common
    from peerlens.operators import hot_keys as H

    every = lambda df, keys: H.hot_keys(df, keys, least=1)
    monkeypatch.setattr(minhash, "hot_keys", every)
    monkeypatch.setattr(common, "hot_keys", every)
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", 3)
    docs = spark.createDataFrame(list(family.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == _brute(family)
    star = spark.createDataFrame([(0, i) for i in range(1, 3000)] + [(5000, 5001)], "a long, b long")
    comp = {r.node: r.comp for r in connected_components(star).collect()}
    assert comp == {i: 0 for i in range(3000)} | {5000: 5000, 5001: 5000}
