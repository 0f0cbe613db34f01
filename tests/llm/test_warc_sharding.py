"""WARC archives with their index, and k-d tree shards."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from peerlens.llm import queries, sharding, warc
from peerlens.llm.common import open_folder
from tests.conftest import SF_SMALL


def test_warc_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL['op2_warc']})").fetchall(), key=str)
    got = queries.op2_warc(spark, SF_SMALL)
    assert got.columns == names and sorted((tuple(r) for r in got.collect()), key=str) == want


def _pages(spark):
    body = "é" * 80
    rows = [
        (5, "http://B.Example.org:8080/x?q=1", body), (3, "https://a.example.org/y", body), (9, None, body), (None, "ftp://u@c.net/", body),
        (1, "http://a.example.org/y", None), (2, "http://a.example.org/y", ""), (4, "no url at all\r\nX: y", "short"), (6, "http://a.example.org/y", "short"),
        (3, "https://a.example.org/y", body), (7, "http://ü.de/\t", "z" * 2_000_000),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, file string, offset int"), rows


def test_warc_edges(spark):
    pages, rows = _pages(spark)
    captures = warc.write_archives(pages.repartition(3))
    index = warc.build_index(captures, block_lines=2)
    found = warc.lookup(index, pages.select(warc.url_key(F.col("url"))))
    read = warc.read_records(found, payload=True).collect()
    assert len(read) == len(rows)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = {(r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in read}
    long = digest("é" * 80)
    assert {(3, long, "response", None), (5, long, "revisit", 3), (9, long, "revisit", 3), (None, long, "response", None)} <= got
    assert {(1, digest(""), "response", None), (2, digest(""), "response", None), (4, digest("short"), "response", None), (6, digest("short"), "response", None)} <= got
    assert sum(r.page_id == 3 for r in read) == 2
    sizes = {r.page_id: r.payload_bytes for r in read}
    assert sizes[5] == 160 and sizes[7] == 2_000_000 and sizes[1] == 0
    stored = {r.page_id: r.payload for r in read if r.page_id is not None}
    assert stored[5] is None and bytes(stored[3]) == ("é" * 80).encode()
    assert warc.lookup(index, spark.createDataFrame([("org,nowhere)/",), (None,), ("",), ("zzz",)], "k string")).count() == 0
    empty = pages.limit(0)
    nothing = warc.build_index(warc.write_archives(empty))
    assert warc.read_records(warc.lookup(nothing, pages.select("url"))).count() == 0


def test_hot_url_reaches_over_blocks_and_shards(spark):
    rows = [(i, "http://hot.org/" if i % 3 else f"http://h{i}.org/", f"page {i}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    index = warc.build_index(warc.write_archives(pages), block_lines=16)
    one = warc.lookup(index, spark.createDataFrame([("org,hot)/",)], "k string"))
    assert {r.page_id for r in one.collect()} == {i for i, u, _ in rows if "hot" in u}
    few = warc.lookup(index, spark.createDataFrame([("org,h0)/",), ("org,h2997)/",), ("org,h2997)/",)], "k string"))
    assert sorted(r.page_id for r in few.collect()) == [0, 2997]


def test_archives_are_plain_warc_files(spark):
    """One gzip member per record, each at the offset of its capture; damage is noticed."""
    pages, _ = _pages(spark)
    captures = warc.write_archives(pages.repartition(1))
    rows = captures.collect()
    filesystem, path = open_folder(rows[0].folder)
    with filesystem.open_input_file(f"{path}/{rows[0].file}") as f:
        raw = f.read()
    members = []
    while raw:
        unpack = zlib.decompressobj(31)
        members.append(unpack.decompress(raw) + unpack.flush())
        raw = unpack.unused_data
    assert len(members) == len(rows) + 1 and b"WARC-Type: warcinfo" in members[0]
    assert all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members)
    with pytest.raises(Exception):
        warc.read_records(captures.withColumn("offset", F.col("offset") + 1)).collect()


def test_url_keys(spark):
    urls = ["http://A.b.org:80/P?x#y", "https://user:pw@b.org", "rubbish text", None, "", "http://1.2.3.4/a b"]
    keys = [r.k for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u")).alias("k")).collect()]
    assert keys == ["org,b,a)/P?x#y", "org,b)", ")rubbish+text", ")", ")", "4,3,2,1)/a+b"]


# -- shards ------------------------------------------------------------------
def _check(rows, shards, docs):
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert all(0 <= s < shards for s in by)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs
    )
    return {s: sum(r.size for r in own) for s, own in by.items()}


def test_shards_of_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op6_kd_sharding(spark, "/root/testdata/sf0.1").collect()
    sizes = _check(rows, 24, docs)
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * mean and min(sizes.values()) > 0.9 * mean
    groups = {}
    for r in rows:
        groups.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in groups.values())  # equal texts stay together
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    again = queries.op6_kd_sharding(spark, "/root/testdata/sf0.1").collect()
    assert sorted((r.doc_id, r.shard) for r in again) == sorted((r.doc_id, r.shard) for r in rows)


def test_shard_edges(spark):
    docs = [(i, f"text {i} " * (i % 17)) for i in range(300)] + [(None, "no id"), (None, None), (7, None), (7, ""), (8, "x" * 40_000), (8, "x" * 40_000)]
    df = spark.createDataFrame([(i, t, 3, "s") for i, t in docs], "doc_id long, text string, shard int, _size string")
    for shards in (1, 2, 7):
        _check(sharding.kd_shards(df, shards).collect(), shards, docs)
    assert sharding.kd_shards(df.limit(0), 24).count() == 0


def test_hot_group_is_split(spark):
    """A group of equal texts heavier than a shard is cut by its ids, the others stay near equal."""
    docs = [(i, "the same text over and over") for i in range(2000)] + [(5000 + i, f"other text number {i} here") for i in range(2000)]
    rows = sharding.kd_shards(spark.createDataFrame(docs, "doc_id long, text string"), 8, slot_rows=100).collect()
    sizes = _check(rows, 8, docs)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(sizes.values()) < 1.1 * mean and min(sizes.values()) > 0.9 * mean


def test_all_rows_equal(spark):
    docs = [(1, "same")] * 50
    _check(sharding.kd_shards(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect(), 4, docs)


def test_tree_equals_sorted_medians(spark):
    """Every split against a plain sort of the node's rows: the widest axis, and no better place by more than the slack."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    points = sharding.measured(docs, "doc_id", "text")
    rows = [r.asDict() for r in points.collect()]
    shards = 24
    tree = sharding._grow(points, shards, 64, sharding.SLACK, sharding.GROUP_SLACK)
    share = sum(r["_size"] for r in rows) / shards
    whole = {c: max(r[c] for r in rows) - min(r[c] for r in rows) for c in sharding.DIMENSIONS}

    def walk(node, own, k):
        if isinstance(node, int):
            assert k == 1
            return 1
        wide = [(max(r[c] for r in own) - min(r[c] for r in own)) / max(1, whole[c]) for c in sharding.DIMENSIONS]
        assert node.keys[0] == sharding.DIMENSIONS[wide.index(max(wide))]
        place = lambda r: tuple(r[c] for c in node.keys)
        own = sorted(own, key=place)
        goal, at, best = sum(r["_size"] for r in own) * (k // 2) / k, 0, float("inf")
        for r in own:
            at += r["_size"]
            best = min(best, abs(at - goal))
        left = [r for r in own if place(r)[: len(node.bounds)] <= node.bounds]
        assert left == own[: len(left)]
        assert abs(sum(r["_size"] for r in left) - goal) <= best + sharding.GROUP_SLACK * share
        return walk(node.left, left, k // 2) + walk(node.right, own[len(left) :], k - k // 2)

    assert walk(tree, rows, shards) == shards


def test_ids_of_other_types(spark):
    docs = [(f"d{i}", f"text {i} " * (i % 13)) for i in range(200)] + [(None, "x")]
    _check(sharding.kd_shards(spark.createDataFrame(docs, "doc_id string, text string"), 5).collect(), 5, docs)
    pages = spark.createDataFrame([("p1", "http://a/b", "x")], "page_id string, url string, html string")
    with pytest.raises(TypeError, match="must be integers"):
        warc.write_archives(pages)
    small = spark.createDataFrame([(1, "http://a/b", "x" * 200), (2, "http://a/c", "x" * 200)], "page_id int, url string, html string")
    read = warc.read_records(warc.lookup(warc.build_index(warc.write_archives(small)), small.select(warc.url_key(F.col("url")))))
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in read.collect()) == [(1, "response", None), (2, "revisit", 1)]


def test_hot_payload_and_url_are_spread(spark):
    """A payload and an URL that most pages share: every page once, all of them read by several tasks."""
    rows = [(i, "http://hot/x" if i % 3 else f"http://h{i}/x", "the same body " * 20 if i % 4 else f"body {i} " * 20) for i in range(6000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    index = warc.build_index(warc.write_archives(pages))
    read = warc.read_records(warc.lookup(index, pages.select(warc.url_key(F.col("url")))))
    got = {r.page_id: (r.record_type, r.refers_to) for r in read.collect()}
    want = {i: ("response", None) if i % 4 == 0 or i == 1 else ("revisit", 1) for i in range(6000)}
    assert got == want and read.count() == 6000
