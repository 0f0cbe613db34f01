"""WARC archives with revisit records and a two-level capture index.

Writing.  Each task streams the records of its rows into WARC/1.1 files, one gzip member per record.  A payload of
at least ``revisit_bytes`` that an earlier page (smaller id) has too becomes a ``revisit`` record.

Index.  Captures are sorted by reversed-host URL key over all files and cut into range shards.  A shard file holds
compressed blocks of ``block_lines`` capture lines, then its sparse directory (first key, offset and length of each block)
and a footer.  The first level above, one row per shard with its first key, is as long as the number of shuffle partitions.

Lookup.  A key finds its shards by binary search in the first keys, its blocks by binary search in the shard's directory, its lines in a range read of
those blocks alone, and its record by a range read in the archive.  A key with very many captures reaches over blocks and shards; every part is
found by the task of its own shard.  Reads of records are dealt by archive file and sorted by offset.

All files are written under names of their own per task attempt, and only names that finished tasks reported are used.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import open_folder, shared_folder, written
from peerlens.operators.joins import salted_join

REVISIT_BYTES = 100
FILE_BYTES = 1 << 30
BLOCK_LINES = 3000
#: Lines of a batch of captures, and bytes of a file that one task reads records from.
BATCH_LINES = 4096
READ_BYTES = 16 << 20
#: Tasks that the pages of one payload are dealt over.
HOT_PARTS = 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FOOTER = "<QI8s"
_MAGIC = b"CAPINDEX"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def url_key(url: Column) -> Column:
    """Reversed-host key of a URL: ``http://a.b.org:80/x?y`` gives ``org,b,a)/x?y``; null gives ``)``.

    The host is lower case, scheme, user and port are left out, blanks and control characters become ``+``.
    """
    authority = F.regexp_extract(url, _SCHEME + r"([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(authority), r"^.*@", ""), r":\d*$", "")
    rest = F.regexp_replace(url, _SCHEME + r"[^/?#]*", "")
    key = F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest)
    return F.regexp_replace(F.coalesce(key, F.lit(")")), r"[\x00-\x20\x7f]", "+")


# -- records -----------------------------------------------------------------
def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    digits = name[len("<urn:x-page:") : -1] if name else "null"
    return None if digits == "null" else int(digits)


def page_record(page_id, url: str | None, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """A response, or a revisit (without payload) if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        return _record("response", headers, http + payload)
    return _record("revisit", [*headers, ("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)], http)


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload); header names in lower case."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    status = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}
    return fields, status, payload


# -- writing -----------------------------------------------------------------
CAPTURE = "_key string, page_id long, folder string, file string, offset long, length long"


def write_archives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    folder: str | None = None, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record for every row of ``pages``; returns the captures (see ``CAPTURE``), unsorted.

    Payload: the body in UTF-8 (null: empty).  Of equal payloads of at least ``revisit_bytes`` bytes the smallest id is a
    response, the others are revisits that refer to it; repeated rows with that id are responses too, and a null id is never referred to
    and always a response.  Ids must be integers.  Other columns are not read.  An empty table gives no files and no captures.
    """
    if not isinstance(pages.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"ids of pages must be integers (they are the records' ids), {id_col} is {pages.schema[id_col].dataType.simpleString()}")
    folder = folder or shared_folder(pages.sparkSession, "warc")
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    full = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), body.alias("_body"),
        F.sha2(body, 256).alias("_digest"), F.octet_length(body).cast("long").alias("_size"),
    )
    small = full.where((F.col("_size") >= revisit_bytes) & F.col("_id").isNotNull()).select("_id", "_digest")
    firsts = small.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first < _last")
    # a payload that a third of all pages share is dealt over several tasks
    again = salted_join(small, firsts, ["_digest"], "inner", HOT_PARTS, ["_id"]).where("_id > _first").select(
        F.col("_id").alias("_again"), F.col("_digest").alias("_same"), "_first"
    ).distinct()
    joined = full.join(again, (full["_id"] == again["_again"]) & (full["_digest"] == again["_same"]), "left").select(
        "_id", "_url", url_key(F.col("_url")).alias("_key"), F.when(F.col("_first").isNull(), F.col("_body")).alias("_body"),
        "_digest", "_size", "_first",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, at = None, "", 0
        filesystem, path = open_folder(folder)
        for batch in batches:
            ids, urls, keys, bodies, digests, sizes, firsts_ = (c.to_pylist() for c in batch.columns)
            out = []
            for page, url, key, payload, digest, size, first in zip(ids, urls, keys, bodies, digests, sizes, firsts_):
                if stream is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    filesystem.create_dir(path, recursive=True)
                    stream = filesystem.open_output_stream(f"{path}/{name}", compression=None)
                    info = _member(_record("warcinfo", [("WARC-Record-ID", f"<urn:x-file:{name}>"), ("WARC-Date", DATE)], b""))
                    stream.write(info)
                    at = len(info)
                member = _member(page_record(page, url, payload, size, digest, first))
                stream.write(member)
                out.append((key, page, folder, name, at, len(member)))
                at += len(member)
                if at >= file_bytes:
                    stream.close()
                    stream = None
            if out:
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["_key", "page_id", "folder", "file", "offset", "length"]
                )
        if stream is not None:
            stream.close()

    return written(joined.mapInArrow(run, CAPTURE), "captures")


# -- index -------------------------------------------------------------------
def build_index(captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures into shard files of compressed blocks; one row per shard: ``shard``, ``first``, ``folder``, ``file``, ``n``."""
    folder = folder or shared_folder(captures.sparkSession, "capture-index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, path = open_folder(folder)
        name = f"index-{uuid.uuid4().hex}.blocks"
        stream, first_key, count, at = None, None, 0, 0
        lines: list[bytes] = []
        directory: list[bytes] = []

        def flush() -> None:
            nonlocal at
            block = zlib.compress(b"\n".join(lines), 6)
            key = lines[0].split(b"\t", 1)[0]
            directory.append(struct.pack("<QII", at, len(block), len(key)) + key)
            stream.write(block)
            at += len(block)
            lines.clear()

        for batch in batches:
            for key, page, where, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    filesystem.create_dir(path, recursive=True)
                    stream, first_key = filesystem.open_output_stream(f"{path}/{name}", compression=None), key
                lines.append("\t".join([key, "" if page is None else str(page), where, file, str(offset), str(length)]).encode())
                count += 1
                if len(lines) == block_lines:
                    flush()
        if stream is not None:
            if lines:
                flush()
            packed = zlib.compress(b"".join(directory), 6)
            stream.write(packed)
            stream.write(struct.pack(_FOOTER, at, len(packed), _MAGIC))
            stream.close()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first_key]), pa.array([folder]), pa.array([name]), pa.array([count], pa.int64())],
                names=["shard", "first", "folder", "file", "n"],
            )

    columns = [f.split()[0] for f in CAPTURE.split(", ")]
    ordered = captures.select(*columns).repartitionByRange("_key", "page_id").sortWithinPartitions("_key", "page_id", "file", "offset")
    return written(ordered.mapInArrow(run, "shard int, first string, folder string, file string, n long"), "shards")


class ShardReader:
    """Binary search in one shard file; keeps the block used last."""

    def __init__(self, folder: str, name: str):
        filesystem, path = open_folder(folder)
        self.file = filesystem.open_input_file(f"{path}/{name}")
        size = self.file.size()
        at, length, magic = struct.unpack(_FOOTER, self._range(size - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER)))
        if magic != _MAGIC:
            raise ValueError("not a capture index, or cut short")
        packed, self.blocks, self.firsts, k = zlib.decompress(self._range(at, length)), [], [], 0
        while k < len(packed):
            offset, block, key = struct.unpack_from("<QII", packed, k)
            self.blocks.append((offset, block))
            self.firsts.append(packed[k + 16 : k + 16 + key])
            k += 16 + key
        self.kept: tuple[int, list[bytes]] | None = None

    def _range(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def _lines(self, block: int) -> list[bytes]:
        if self.kept is None or self.kept[0] != block:
            self.kept = block, zlib.decompress(self._range(*self.blocks[block])).split(b"\n")
        return self.kept[1]

    def find(self, key: bytes) -> Iterator[list[bytes]]:
        """The fields of every line of a key."""
        block = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while block < len(self.firsts) and self.firsts[block] <= key:
            lines = self._lines(block)
            k = bisect.bisect_left(lines, key + b"\t")
            while k < len(lines) and lines[k].startswith(key + b"\t"):
                yield lines[k].split(b"\t")
                k += 1
            block += 1


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """The captures of every different key in the first column of ``keys``; keys without a capture and null keys give none.

    The rows of ``index`` (one per shard, as many as the build had partitions) are the only thing sent to all tasks.
    """
    shards = sorted((r.first.encode(), r.shard, r.folder, r.file) for r in index.collect())
    firsts, numbers = [s[0] for s in shards], list(range(len(shards)))
    wanted = keys.toDF(*["_key", *keys.columns[1:]]).select("_key").where("_key is not null").distinct()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_pylist()
            spans = [(max(0, bisect.bisect_left(firsts, k.encode()) - 1), bisect.bisect_right(firsts, k.encode())) for k in column]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, (a, b) in zip(column, spans) for _ in range(a, b)], pa.string()),
                 pa.array([n for a, b in spans for n in numbers[a:b]], pa.int32())], names=["_key", "_shard"],
            )

    def captures(lines: list[list[bytes]]) -> pa.RecordBatch:
        columns = list(zip(*lines))
        return pa.RecordBatch.from_arrays(
            [pa.array([x.decode() for x in columns[0]]), pa.array([int(x) if x else None for x in columns[1]], pa.int64())]
            + [pa.array([x.decode() for x in columns[k]]) for k in (2, 3)]
            + [pa.array([int(x) for x in columns[k]], pa.int64()) for k in (4, 5)],
            names=["_key", "page_id", "folder", "file", "offset", "length"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, lines = None, -1, []
        for batch in batches:
            for key, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    reader, current = ShardReader(shards[shard][2], shards[shard][3]), shard
                for line in reader.find(key.encode()):
                    lines.append(line)
                    if len(lines) >= BATCH_LINES:
                        yield captures(lines)
                        lines = []
        if lines:
            yield captures(lines)

    if not shards:
        return keys.sparkSession.createDataFrame([], CAPTURE)
    dealt = wanted.mapInArrow(deal, "_key string, _shard int")
    # so many tasks whatever the bytes of the keys: a key costs a read, not its bytes
    tasks = max(len(shards), 2 * keys.sparkSession.sparkContext.defaultParallelism)
    spread = F.pmod(F.xxhash64("_key"), F.lit(-(-tasks // len(shards))))
    return dealt.repartition(tasks, "_shard", spread).sortWithinPartitions("_shard", "_key").mapInArrow(search, CAPTURE)


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(captures: DataFrame, payload: bool = False) -> DataFrame:
    """The records of captures, read by range: page, URL, size and digest of the full payload, type, and what a revisit refers to.

    The digest of a stored payload is computed from its bytes and must equal the record's header; a record that
    doesn't raises.  ``payload`` adds the bytes (null for revisits).
    """
    schema = T._parse_datatype_string(RECORD + (", payload binary" if payload else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, current = None, None
        for batch in batches:
            out = []
            for folder, name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if (folder, name) != current:
                    filesystem, path = open_folder(folder)
                    stream, current = filesystem.open_input_file(f"{path}/{name}"), (folder, name)
                stream.seek(offset)
                fields, http, body = parse_record(zlib.decompress(stream.read(length), 31))
                digest, kind, size = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"], int(http["content-length"])
                if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                    raise ValueError(f"damaged record in {name} at {offset}")
                row = (_number(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, kind, _number(fields.get("warc-refers-to")))
                out.append((*row, body if kind == "response" else None) if payload else row)
            if out:
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)

    spark, places = captures.sparkSession, captures.select("folder", "file", "offset", "length")
    # stretches of a file, over so many tasks whatever the bytes of the places: each place is a range read
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stretch = F.floor(F.col("offset") / READ_BYTES)
    return places.repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset").mapInArrow(run, schema)
