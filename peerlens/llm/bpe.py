"""Byte-level BPE encoding and decoding in length-bucketed numpy matrices.

A text is cut at the matches of the split pattern; every different piece is
merged once per worker and kept in a bounded table.  Pieces that are not in
the table are put in matrices, one per length class, padded with -1; in each
round every row merges its minimum-rank pair, leftmost first, and is compacted.
Ranks come from an open-addressing hash table of token pairs.

Where a row holds its minimum-rank pair several times, all non-overlapping
places (leftmost first) are merged in one round.  That equals merging them one
by one unless a pair with the merged token has a still lower rank; the few
tokens for which the vocabulary allows that are found on load, and for them only
the leftmost place is merged.

A round reads every cell of a row, so the matrix would take quadratic time for a single very long piece (letters
without a split point).  Rows of more than ``LONG`` bytes are therefore kept as linked tokens with the places of every rank in a
list: a round takes the lowest rank's places, leftmost first, and touches these and their neighbours alone.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import text_slices

#: Pieces kept per worker; the table is emptied when it is full.
CACHE_PIECES = 400_000
#: Characters encoded together.
SLICE = 1_000_000
#: Cells of one matrix; longer lists of pieces are merged in several matrices.
MATRIX_CELLS = 1 << 20

#: Bytes from which on a piece is merged by lists of places.
LONG = 8192
_MUL = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(1 << 40)
#: The split pattern (a fixed value) whose matches never reach over the ends of the chunks below; texts are cut there first, so that
#: whole chunks can be looked up.  With any other pattern whole texts are split by the pattern itself.
CHUNKED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of one space at most and non-space characters.
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: White space to Python's ``re`` but not to the split pattern.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing over numpy arrays."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ids = np.full(1 << bits, _NONE, dtype=np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            winners = todo[free]
            _, first = np.unique(slot[winners], return_index=True)
            winners = winners[first]
            self.keys[slot[winners]], self.ids[slot[winners]] = keys[winners], ids[winners]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MUL) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, ``_NONE`` where a pair does not merge (or a side is padding)."""
        shape, padding = left.shape, (left < 0) | (right < 0)
        keys = ((left << 24) | right).ravel()
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ids[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.ids[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return np.where(padding, _NONE, out.reshape(shape))


class ByteBpe:
    """Ranks and split pattern of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.chunked = pattern == CHUNKED
        self.tokens = dict(zip(ranks.values(), ranks.keys()))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        left, right, merged = [], [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i)
        left, right, merged = (np.array(x, dtype=np.int64) for x in (left, right, merged))
        self.pairs = PairTable((left << 24) | right, merged)
        early = merged < np.maximum(left, right)
        self.one_by_one = np.zeros(int(max(ranks.values())) + 1, dtype=bool)
        self.one_by_one[left[early]] = self.one_by_one[right[early]] = True
        self.cache: dict[str, bytes] = {}

    # -- merging ---------------------------------------------------------
    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (a non-empty byte string), as little-endian 32-bit integers."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        out = [self._merge_long(p) if len(p) > LONG else b"" for p in pieces]
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= LONG]
        classes = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
        start = 0
        while start < len(order):
            width_class = classes[order[start]]
            stop, widest = start, 1
            while stop < len(order) and classes[order[stop]] == width_class:
                widest = max(widest, int(lengths[order[stop]]))
                if stop > start and (stop - start + 1) * widest > MATRIX_CELLS:
                    break
                stop += 1
            self._merge_rows(pieces, order[start:stop], lengths, out)
            start = stop
        return out

    def _merge_rows(self, pieces, rows, lengths, out) -> None:
        width = int(lengths[rows].max())
        grid = np.full((len(rows), width), -1, dtype=np.int64)
        cells = np.arange(width) < lengths[rows][:, None]
        grid[cells] = self.byte_ids[np.frombuffer(b"".join(pieces[r] for r in rows), dtype=np.uint8)]
        rank = np.full(grid.shape, _NONE)  # of the pair that begins at a cell
        rank[:, :-1] = self.pairs.find(grid[:, :-1], grid[:, 1:])
        while len(rows):
            least = rank.min(axis=1)
            done = least == _NONE
            if done.any():
                size = (grid[done] >= 0).sum(axis=1)
                packed, step = grid[done].astype("<i4").tobytes(), 4 * grid.shape[1]
                for k, (r, n) in enumerate(zip(rows[done].tolist(), size.tolist())):
                    out[r] = packed[k * step : k * step + 4 * n]
                rows, grid, rank, least = rows[~done], grid[~done], rank[~done], least[~done]
                if not len(rows):
                    return
            here = rank == least[:, None]
            single = self.one_by_one[least]
            if single.any():
                first = here[single].argmax(axis=1)
                here[single] = np.arange(here.shape[1]) == first[:, None]
            r, c = np.nonzero(here)
            if len(r) > len(rows):  # leftmost first, none overlapping
                run_start = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1)])
                offset = np.arange(len(r)) - np.repeat(run_start, np.diff(np.r_[run_start, len(r)]))
                r, c = r[offset % 2 == 0], c[offset % 2 == 0]
            grid[r, c] = least[r]
            grid[r, c + 1] = -1
            # compaction, then new ranks beside the merged tokens
            keep = grid >= 0
            place = np.cumsum(keep, axis=1) - 1
            c = place[r, c]
            size = place[:, -1] + 1
            width = int(size.max())
            full = np.arange(width) < size[:, None]
            tokens, ranks = (np.full(full.shape, x, dtype=np.int64) for x in (-1, _NONE))
            tokens[full], ranks[full] = grid[keep], rank[keep]
            grid, rank = tokens, ranks
            for at in (c, c - 1):
                ok = at >= 0
                row, at = r[ok], at[ok]
                right = np.where(at + 1 < width, grid[row, np.minimum(at + 1, width - 1)], -1)
                rank[row, at] = self.pairs.find(grid[row, at], right)

    def _merge_long(self, piece: bytes) -> bytes:
        """:meth:`merge` of one long piece, by the places of each rank."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, _NONE)  # of the pair that begins at a token; _NONE at the end and where a token is gone
        rank[:-1] = self.pairs.find(ids[:-1], ids[1:])
        places: dict[int, list[int]] = {}
        for i in np.flatnonzero(rank != _NONE).tolist():
            places.setdefault(int(rank[i]), []).append(i)
        queue = sorted(places)
        while queue:
            least = heapq.heappop(queue)
            at = np.unique(np.array(places.pop(least), dtype=np.int64))
            at = at[rank[at] == least]  # others have changed since
            if not len(at):
                continue
            every = at
            if len(at) > 1:  # leftmost first, none overlapping
                run_start = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
                offset = np.arange(len(at)) - np.repeat(run_start, np.diff(np.r_[run_start, len(at)]))
                at = at[offset % 2 == 0]
            if self.one_by_one[least] and len(every) > 1:
                # up to the first place after which a pair with the merged token goes before the next place
                right, left = after[after[at]], before[at]
                right = np.where(right < n, ids[np.minimum(right, n - 1)], -1)
                beside = np.r_[False, left[1:] == after[at[:-1]]]  # the place on the left is merged by then
                left = np.where(beside, least, np.where(left >= 0, ids[np.maximum(left, 0)], -1))
                merged = np.full(len(at), least)
                early = np.flatnonzero((self.pairs.find(merged, right) < least) | (self.pairs.find(left, merged) < least))
                if len(early):
                    at = at[: early[0] + 1]
                    rest = every[every > at[-1]].tolist()
                    if rest:
                        places[least] = rest
                        heapq.heappush(queue, least)
            gone = after[at]
            ids[at], rank[gone] = least, _NONE
            after[at] = after[gone]
            follow = after[at] < n
            before[after[at[follow]]] = at[follow]
            left = before[at]
            touched = np.unique(np.concatenate([at, left[left >= 0]]))
            right = np.where(after[touched] < n, ids[np.minimum(after[touched], n - 1)], -1)
            rank[touched] = fresh = self.pairs.find(ids[touched], right)
            for i, r in zip(touched.tolist(), fresh.tolist()):
                if r == _NONE:
                    continue
                if r in places:
                    places[r].append(i)
                else:
                    places[r] = [i]
                    heapq.heappush(queue, r)
        out, i = [], 0
        while i < n:
            out.append(i)
            i = int(after[i])
        return ids[out].astype("<i4").tobytes()

    # -- whole texts -----------------------------------------------------
    def _chunks(self, text: str) -> list[str]:
        if not self.chunked or _ODD_SPACE.search(text):
            return [m[0] for m in self.pattern.finditer(text)]
        return _CHUNK.findall(text)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (int32) of each whole text."""
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        cut = [self._chunks(t) for t in texts]
        new = set().union(*cut).difference(self.cache) if cut else set()
        if new:
            new_chunks = list(new)
            split = [[m[0] for m in self.pattern.finditer(c)] if self.chunked else [c] for c in new_chunks]
            pieces = list({p for parts in split for p in parts})
            ids = dict(zip(pieces, self.merge([p.encode() for p in pieces])))
            for chunk, parts in zip(new_chunks, split):
                self.cache[chunk] = ids[parts[0]] if len(parts) == 1 else b"".join([ids[p] for p in parts])
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, chunks)), dtype="<i4") for chunks in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(load_ranks(path), pattern)


def bpe_encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None
) -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``ids_col``, the BPE ids of the whole text.

    ``path``: a ``.tiktoken`` rank file that every executor can open;
    ``pattern``: the split pattern.  No special tokens.  Null or empty text: an
    empty list.  Repeated rows give repeated results; every other column passes
    unchanged (an input column already named ``ids_col`` is replaced).  With ``decoded_col`` the
    ids are decoded again in the same task (:func:`bpe_decode` without a second Python worker).
    """
    kept = [c for c in docs.columns if c not in (text_col, ids_col, decoded_col)]
    fields = [docs.schema[c] for c in kept] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for part, texts in text_slices(batches, text_col, SLICE):
            ids = bpe.encode_batch(texts)
            ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
            columns = [part.column(part.schema.get_field_index(c)) for c in kept]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))))
            if decoded_col:
                columns.append(pa.array(map(bpe.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*kept, text_col).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with a binary column ``bytes_col``: the bytes the ids stand for.

    A null list gives null, an empty one empty bytes; an id that is not in the
    vocabulary raises.  An input column already named ``bytes_col`` is replaced.
    """
    kept = [c for c in encoded.columns if c != bytes_col]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(bytes_col, T.BinaryType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            valid = lists.is_valid().to_pylist()
            decoded = [bpe.decode(flat[a:b]) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], valid)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*kept, bytes_col])

    return encoded.select(*kept).mapInArrow(run, schema)


def with_digests(coded: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` (decimal ids joined by a space) and ``decoded_sha256``."""
    return coded.withColumns(
        {
            "n_tokens": F.size(ids_col).cast("long"),
            "ids_sha256": F.sha2(F.concat_ws(" ", F.col(ids_col).cast("array<string>")), 256),
            "decoded_sha256": F.sha2(F.col(bytes_col), 256),
        }
    )
