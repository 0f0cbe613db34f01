"""The paged feed as a data source: same rows as the feed, stop rule, growth, retries."""

import io
import json
import os
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import types as T

from peerlens.sources.paged import Feed, Pages, http_fetch, landed_fetch, page_ranges, read_paged, read_pages, stream_paged

KIND = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def _write(folder, rows, first=0):
    """Pages of five rows in a folder, one file per page."""
    os.makedirs(folder, exist_ok=True)
    for at in range(first // 5 * 5, len(rows) + 5, 5):
        with open(f"{folder}/{at}.json", "w") as fh:
            json.dump(rows[at : at + 5], fh)


def _folder(folder):
    """Fetch from such a folder; ends where a page is short."""

    def fetch(offset, limit):
        found = []
        while len(found) < limit:
            at = (offset + len(found)) // 5 * 5
            path = f"{folder}/{at}.json"
            page = json.load(open(path)) if os.path.exists(path) else []
            skip = offset + len(found) - at
            found += page[skip : skip + limit - len(found)]
            if len(page) < 5:
                break
        return found

    return fetch


def _records(n):
    return [{"id": f"r{i}", "n": i, "more": "x"} for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 5, 23, 25, 101])
def test_reads_every_row_once(spark, scratch, n):
    _write(scratch, _records(n))
    df = read_paged(spark, _folder(scratch), schema=KIND, page_size=5, pages_per_task=3, name=f"feed{n}")
    rows = df.collect()
    assert sorted((r.id, r.n, r._page_offset) for r in rows) == sorted((f"r{i}", i, i // 5 * 5) for i in range(n))
    assert df.columns == ["id", "n", "_page_offset", "_ingested_at", "_source"]
    assert df.rdd.getNumPartitions() == max(1, -(-n // 15))


def test_end_is_found_with_few_requests():
    for n in (0, 1, 4, 5, 6, 77, 12_345_678):
        asked = []

        def fetch(offset, limit):
            asked.append((offset, limit))
            return [{}] * max(0, min(limit, n - offset))

        feed = Feed(fetch, page_size=5)
        assert feed.end() == n and feed.end(n // 2) == n
        assert len(asked) < 110 and all(limit == 1 for _, limit in asked)


def test_page_ranges_cover_everything():
    for first, end in ((0, 0), (0, 7), (3, 30), (10, 20), (29, 30), (0, 30)):
        parts = page_ranges(first, end, 5, 2)
        assert [i for p in parts for i in range(p.first, p.end)] == list(range(first, end))
        assert all(p.first % 10 == 0 or p.first == first for p in parts)


def test_short_page_inside_fails():
    rows = _records(40)

    def fetch(offset, limit):  # the page at 10 gives three rows only
        limit = min(limit, 13 - offset) if 10 <= offset < 13 else limit
        return rows[offset : offset + max(0, limit)]

    with pytest.raises(ValueError, match="page at offset 10 ended after 3 rows"):
        list(read_pages(Feed(fetch, KIND, 5), Pages(0, 20)))


def test_rows_behind_the_planned_end_are_read():
    rows = _records(23)
    feed = Feed(lambda offset, limit: rows[offset : offset + limit], KIND, 5)
    assert sum(b.num_rows for b in read_pages(feed, Pages(0, 12, open=True))) == 23
    assert sum(b.num_rows for b in read_pages(feed, Pages(0, 12))) == 12
    assert sum(b.num_rows for b in read_pages(feed, Pages(23, 23, open=True))) == 0


def test_too_many_rows_and_failures():
    with pytest.raises(ValueError, match="6 rows at offset 0, 5 were asked for"):
        list(read_pages(Feed(lambda o, n: _records(6), KIND, 5), Pages(0, 6)))
    calls = []

    def flaky(offset, limit):
        calls.append(offset)
        if len(calls) < 3:
            raise OSError("busy")
        return _records(2)[offset : offset + limit]

    assert Feed(flaky, KIND, 5, pause=0).rows(0, 5) == _records(2) and len(calls) == 3

    def down(offset, limit):
        raise OSError("down")

    with pytest.raises(OSError, match="down"):
        Feed(down, KIND, 5, attempts=2, pause=0).rows(0, 5)


def test_values_take_the_declared_types():
    rows = [{"id": 7, "n": 1}, {"id": True}, {"id": 1.5, "n": None}, {}, {"id": "é\n", "n": 2**40, "z": 1}]
    batch, = read_pages(Feed(lambda o, n: rows[o : o + n], KIND, 5), Pages(0, 5))
    assert batch.to_pydict() == {"id": ["7", "true", "1.5", None, "é\n"], "n": [1, None, None, None, 2**40], "_page_offset": [0] * 5}
    with pytest.raises(Exception, match="int"):
        list(read_pages(Feed(lambda o, n: [{"n": "x"}][o : o + n], KIND, 5), Pages(0, 1)))


def test_stream_takes_what_has_grown(spark, scratch):
    feed, target, checkpoint = f"{scratch}/feed", f"{scratch}/bronze", f"{scratch}/checkpoint"
    take = lambda: stream_paged(spark, _folder(feed), target, checkpoint, schema=KIND, page_size=5, pages_per_task=2, name="grown")
    _write(feed, _records(13))
    assert take() == 13
    assert take() == 0
    _write(feed, _records(31), first=10)  # the short page at 10 is filled up, more follow
    assert take() == 18
    rows = spark.read.parquet(target).collect()
    assert sorted((r.n, r._page_offset) for r in rows) == [(i, i // 5 * 5) for i in range(31)]


def test_failing_task_fails_the_read(spark, scratch):
    _write(scratch, _records(12))
    os.remove(f"{scratch}/5.json")
    rows = _records(12)

    def fetch(offset, limit):  # the end is announced, the page is not there
        return rows[offset : offset + 1] if limit == 1 else _folder(scratch)(offset, limit)

    with pytest.raises(Exception, match="page at offset 5 ended after 0 rows"):
        read_paged(spark, fetch, schema=KIND, page_size=5, name="broken").collect()


def test_http_fetch_asks_and_checks():
    asked = []

    def opener(request, timeout):
        asked.append((request.full_url, dict(request.headers), timeout))
        offset = int(parse_qs(urlparse(request.full_url).query)["offset"][0])
        return io.BytesIO(b'{"error": 1}' if offset == 9 else json.dumps([{"id": offset}]).encode())

    fetch = http_fetch("http://x/data", params={"q": "a b"}, headers={"Accept": "json"}, opener=opener)
    assert fetch(5, 10) == [{"id": 5}]
    assert asked == [("http://x/data?q=a+b&size=10&offset=5", {"Accept": "json"}, 60.0)]
    with pytest.raises(ValueError, match="no array at offset 9"):
        fetch(9, 10)


def test_landed_fetch(spark, scratch):
    from pyspark.sql import functions as F

    from peerlens.sources.pages import land_pages

    df = spark.range(23).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n"))
    land_pages(df, f"{scratch}/pages", page_size=5)
    fetch = landed_fetch(f"{scratch}/pages", 5)
    assert [len(fetch(o, 5)) for o in (0, 20, 25, 3)] == [5, 3, 0, 5]
    assert len({r["n"] for o in range(0, 25, 5) for r in fetch(o, 5)}) == 23
    assert landed_fetch("file:" + f"{scratch}/pages", 5)(0, 2) == fetch(0, 2)
