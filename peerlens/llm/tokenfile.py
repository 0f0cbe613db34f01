"""Token-id files: fixed-size blocks of ids, shuffled into planes, compressed, with a chunk index.

File layout (all integers little-endian)::

    "IDPLANE1"
    for each chunk, for each plane: one zstandard frame
    index: per chunk  u64 first id, u32 ids, then per plane  u64 offset, u32 length
    footer: u64 index offset, u32 chunks, u32 planes, "IDPLANE1"

A chunk holds ``chunk_ids`` ids (the last one fewer).  With byte planes its
32-bit ids are transposed into 4 planes of bytes, with bit planes into 32 planes
of bits; equal-valued high planes shrink to almost nothing.  A reader takes the footer and
the index first and then only the chunks that hold the ids it needs.

Documents are dealt by ranges of ``id_col`` and sorted in each task, which
streams one file; so the files in their order hold the documents in ascending
order.  A task writes under a name of its own; only the names of finished
tasks are in the index table, which makes retries harmless.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from peerlens.llm.common import open_folder, shared_folder, text_slices, written

MAGIC = b"IDPLANE1"
FOOTER = struct.Struct("<QII8s")
CHUNK_IDS = 1 << 18
#: Ids of a file that one task reads.
READ_IDS = 16 * CHUNK_IDS
CACHE_WORDS = 500_000
#: Characters encoded together.
SLICE = 1_000_000


# -- planes ----------------------------------------------------------------
def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of a block of ids, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    table = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(table[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block of ``n`` from its planes."""
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        table = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(table, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class PlaneWriter:
    """Streams ids into one file."""

    def __init__(self, stream, chunk_ids: int = CHUNK_IDS, bits: bool = False, level: int = 3):
        self.stream, self.chunk_ids, self.bits = stream, chunk_ids, bits
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0
        self.index: list[bytes] = []
        self.stream.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.chunk_ids:
            block = np.concatenate(self.held)
            for k in range(0, len(block) - self.chunk_ids + 1, self.chunk_ids):
                self._chunk(block[k : k + self.chunk_ids])
            rest = block[len(block) - len(block) % self.chunk_ids :]
            self.held, self.n_held = [rest], len(rest)

    def _chunk(self, ids: np.ndarray) -> None:
        entry = struct.pack("<QI", self.total, len(ids))
        for plane in to_planes(ids, self.bits):
            frame = self.zstd.compress(plane)
            entry += struct.pack("<QI", self.at, len(frame))
            self.stream.write(frame)
            self.at += len(frame)
        self.index.append(entry)
        self.total += len(ids)

    def close(self) -> int:
        """Write the last chunk, the index and the footer; the number of ids."""
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        self.stream.write(b"".join(self.index))
        self.stream.write(FOOTER.pack(self.at, len(self.index), 32 if self.bits else 4, MAGIC))
        return self.total


class PlaneReader:
    """Random access to the ids of one file; keeps the chunk used last."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        at, chunks, self.planes, magic = FOOTER.unpack(self._range(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token-id file, or cut short")
        step = 12 * (1 + self.planes)
        index = self._range(at, chunks * step)
        self.entries = [struct.unpack("<" + "QI" * (1 + self.planes), index[k * step : (k + 1) * step]) for k in range(chunks)]
        self.first = np.array([e[0] for e in self.entries], dtype=np.int64)
        self.zstd = zstandard.ZstdDecompressor()
        self.kept: tuple[int, np.ndarray] | None = None

    def _range(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def chunk(self, k: int) -> np.ndarray:
        if self.kept is None or self.kept[0] != k:
            e = self.entries[k]
            first, last = e[2], e[-2] + e[-1]  # a chunk's planes lie side by side: one range read
            raw = self._range(first, last - first)
            frames = [raw[e[j] - first : e[j] - first + e[j + 1]] for j in range(2, len(e), 2)]
            self.kept = k, from_planes([self.zstd.decompress(f) for f in frames], e[1])
        return self.kept[1]

    def read(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start`` on, ``n`` of them."""
        parts, k = [], int(np.searchsorted(self.first, start, side="right")) - 1
        while n > 0:
            block = self.chunk(k)[start - int(self.first[k]) :][:n]
            parts.append(block)
            start, n, k = start + len(block), n - len(block), k + 1
        return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")


# -- tokens ----------------------------------------------------------------
#: Characters that NFC and lower-casing (character by character) treat the same alone and in any company.
_PLAIN_RANGES = ((0x09, 0x0A), (0x0D, 0x0D), (0x20, 0x7E), (0xA0, 0x12F), (0x131, 0x17F), (0x2010, 0x2027), (0x2030, 0x205E))
_PLAIN_CHARS = [chr(c) for a, b in _PLAIN_RANGES for c in range(a, b + 1)]
_LETTER = "".join(re.escape(c) for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "L")
_DIGIT = "".join(re.escape(c) for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile("[" + "".join(map(re.escape, _PLAIN_CHARS)) + "]*")
#: The pre-tokenizer's pattern for plain lower-case text.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
_JOINED = 2000
#: The normaliser and pre-tokenizer (fixed values) for which pre-tokens can be encoded apart.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def takes_words_apart(config: dict) -> bool:
    """Whether a tokenizer file's settings are those that :class:`WordEncoder` encodes word by word."""
    model = config["model"]
    return (
        config["normalizer"] == _NORMALIZER
        and config["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
        and (model["type"], model.get("end_of_word_suffix"), model.get("dropout")) == ("BPE", "</w>", None)
        and all("<|" in t["content"] for t in config["added_tokens"])
    )


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, each different word once.

    For vocabularies that normalise to NFC and lower case, drop white space and mark the token that ends a
    word with ``</w>`` (:func:`takes_words_apart`; with any other every text goes to the library whole): no token reaches over the end of a pre-token, so a text's ids are those of its pre-tokens.
    New ones are given to the library many at a time, between spaces, and told apart by the marks.  Texts
    with characters on which this could differ from the whole text (combining marks, unusual case or space,
    special-token strings) go to the library whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.apart = takes_words_apart(json.load(file))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        for k in range(0, len(pieces), _JOINED):
            some = pieces[k : k + _JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            stop = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stop) == len(some):
                raw, start = ids.tobytes(), [0, *stop[:-1].tolist()]
                self.cache.update(zip(some, [raw[a:b] for a, b in zip(start, stop.tolist())]))
            else:  # a pre-token that is several to the library
                self.cache.update((p, self._whole(p)) for p in some)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        plain = [self.apart and _PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        cut = [_PIECE.findall(t.lower()) if ok else [] for t, ok in zip(texts, plain)]
        self._learn(list(set().union(*cut).difference(self.cache)))
        get = self.cache.__getitem__
        return [b"".join(map(get, pieces)) if ok else self._whole(t) for t, ok, pieces in zip(texts, plain, cut)]


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


INDEX_SCHEMA = [("_part", T.IntegerType()), ("file", T.StringType()), ("local_start", T.LongType()), ("n_tokens", T.LongType())]


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    chunk_ids: int = CHUNK_IDS,
    bits: bool = False,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the id files in ascending ``id_col`` order.

    Returns the document index: ``id_col``, ``start`` (ids of all documents
    before it in the whole order), ``n_tokens`` (with the end id), ``folder``, ``file``,
    ``local_start`` (ids before it in its file).  Null or empty text: the end id
    alone.  Null ids come first; rows with equal ids are ordered by
    their text, and repeated rows each get their own place.  An empty table
    gives no files and an empty index.  Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    schema = T.StructType([docs.schema[id_col]] + [T.StructField(n, t) for n, t in INDEX_SCHEMA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = load(tokenizer_path), TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.planes"
        filesystem, path = open_folder(folder)
        stream = writer = None
        at = 0
        for rows, texts in text_slices(batches, text_col, SLICE):
            if writer is None:
                filesystem.create_dir(path, recursive=True)
                stream = filesystem.open_output_stream(f"{path}/{name}", compression=None)
                writer = PlaneWriter(stream, chunk_ids, bits)
            end = np.array([end_id], dtype="<u4").tobytes()
            ids = [x + end for x in encoder.encode_batch(texts)]
            size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            writer.add(np.frombuffer(b"".join(ids), dtype="<u4"))
            start = at + np.cumsum(size) - size
            at += int(size.sum())
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index(id_col)), pa.array([part] * len(size), pa.int32()), pa.array([name] * len(size)), pa.array(start), pa.array(size)],
                names=schema.names,
            )
        if writer is not None:
            writer.close()
            stream.close()

    dealt = docs.select(id_col, text_col).repartitionByRange(id_col).sortWithinPartitions(id_col, text_col)
    index = written(dealt.mapInArrow(run, schema), "token-index")
    # One row per file: the ids of all files before it.
    files = index.groupBy("_part").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    return index.join(offsets, "_part").select(
        id_col, (F.col("_before") + F.col("local_start")).alias("start"), "n_tokens", F.lit(folder).alias("folder"), "file", "local_start"
    )


def read_token_files(index: DataFrame, bytes_col: str = "ids") -> DataFrame:
    """The rows of a document index with their ids, read from the files, as little-endian 32-bit integers.

    Rows are dealt by stretches of the files, over so many tasks whatever the bytes of the index, and sorted by file and place,
    so a task reads each of its chunks once.
    """
    spark = index.sparkSession
    schema = T.StructType([*index.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, PlaneReader] | None = None
        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("folder", "file", "local_start", "n_tokens")}
            out = []
            for folder, file, start, n in zip(*column.values()):
                if opened is None or opened[0] != f"{folder}/{file}":
                    filesystem, path = open_folder(folder)
                    opened = f"{folder}/{file}", PlaneReader(filesystem.open_input_file(f"{path}/{file}"))
                out.append(opened[1].read(start, n).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)

    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = index.repartition(tasks, "file", F.floor(F.col("local_start") / READ_IDS))
    return dealt.sortWithinPartitions("file", "local_start").mapInArrow(run, schema)
