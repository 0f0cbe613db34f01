"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

1. The n-grams of the test items are counted over all documents (the places that hold one).  Those that no document holds
   cannot hit and are dropped.
2. *Rare seeds* join directly: every place of such an n-gram puts each of its items beside the words of the document.
   An n-gram is rare unless more than ``SHARED`` items hold it and places times items are more than ``PAIRS``: frequency within one item
   is no reason, as next to many exact copies the n-grams that an edited copy still holds are the item's most frequent ones.
3. The other n-grams (phrases that many items share, as "which of the following") would put every such item beside every
   place.  They are taken by blocks of a text: a block's shared n-grams, each once, name its items, and an item goes on only if
   the words around the block hold enough of *its* words for a copy (:func:`needed`), which is what an alignment needs at the least.
   So no copy is lost, and memory is bounded by one block.  Windows of one item that overlap are merged.
4. Each window is aligned with its item (local alignment over words: match +2, other word -1, gap -1).

A pair of document and item is reported if the score reaches :func:`needed`: half of the item's full
score, at least 8 matching words (or the whole of a shorter item), and never more than
the score of 13 matching words in a row.  Words are lower case, without ASCII punctuation.

A copy without ``ngram`` words of the item in a row is not seen, and items of fewer words match nothing.

Items are the stated query set: they are taken in blocks of at most ``block_words`` words (the bound of what is sent to
the tasks), each block against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from peerlens.llm.common import text_slices
from peerlens.llm.wordhash import shingle_hashes, word_hashes

NGRAM = 3
STRETCH = 4
MATCH, OTHER, GAP = 2, 1, 1
BLOCK_WORDS = 1_000_000
#: Items that may hold an n-gram that is rare however often texts do, and the place-item pairs from which on a shared one is taken by blocks.
SHARED = 16
PAIRS = 1000
_FILTER_BITS = 22
#: Cells of one alignment step; more pairs are aligned in several batches.
_CELLS = 1 << 20


def needed(words: int) -> int:
    """The least alignment score that makes a copy of an item of so many words."""
    return min(max(words * MATCH // 2, MATCH * min(words, 8)), MATCH * 13)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each (item, window), and the window position behind its last word."""
    score, end = np.zeros(len(items), dtype=np.int32), np.zeros(len(items), dtype=np.int64)
    order = np.argsort([len(w) for w in windows], kind="stable")
    at = 0
    while at < len(order):
        width, stop = 0, at
        while stop < len(order) and (stop == at or (stop - at + 1) * len(windows[order[stop]]) <= _CELLS):
            width = max(width, len(windows[order[stop]]))
            stop += 1
        lanes = order[at:stop]
        at = stop
        grid = np.zeros((len(lanes), width), dtype=np.uint64)
        valid = np.zeros(grid.shape, dtype=bool)
        for k, lane in enumerate(lanes):
            grid[k, : len(windows[lane])] = windows[lane]
            valid[k, : len(windows[lane])] = True
        rows = max(len(items[lane]) for lane in lanes)
        query = np.zeros((len(lanes), rows), dtype=np.uint64)
        length = np.array([len(items[lane]) for lane in lanes])
        for k, lane in enumerate(lanes):
            query[k, : length[k]] = items[lane]
        step = np.arange(width + 1, dtype=np.int32) * GAP
        last = np.zeros((len(lanes), width + 1), dtype=np.int32)
        best, best_at = np.zeros(len(lanes), dtype=np.int32), np.zeros(len(lanes), dtype=np.int64)
        for i in range(rows):
            hit = np.where((grid == query[:, i : i + 1]) & valid, MATCH, -OTHER).astype(np.int32)
            now = np.zeros_like(last)
            np.maximum(last[:, :-1] + hit, last[:, 1:] - GAP, out=now[:, 1:])
            np.maximum(now, 0, out=now)
            now = np.maximum.accumulate(now + step, axis=1) - step  # gaps in the item
            now[i >= length] = 0
            col = now.argmax(axis=1)
            top = now[np.arange(len(lanes)), col]
            better = top > best
            best[better], best_at[better] = top[better], col[better]
            last = now
        score[lanes], end[lanes] = best, best_at
    return score, end


class Seeds:
    """Items of one block with the hash table of their seeds.

    ``places``: how many places of the documents hold each n-gram (by its number as a signed integer); without it all are rare.
    """

    def __init__(
        self, ids: list, words: list[np.ndarray], grams: np.ndarray, item: np.ndarray, place: np.ndarray, places: dict[int, int] | None = None
    ):
        self.ids, self.words = ids, words
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.needed = np.array([needed(n) for n in self.length], dtype=np.int64)
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.place = grams[order], item[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.grams >> np.uint64(64 - _FILTER_BITS)] = True
        self.keys, self.low, self.count = np.unique(self.grams, return_index=True, return_counts=True)
        seen = np.array([(places or {}).get(k, 0) for k in self.keys.view(np.int64).tolist()], dtype=np.int64)
        self.common = (self.count > SHARED) & (self.count * seen > PAIRS)
        self.classes: list[int] = []
        if self.common.any():
            self._share()

    def _share(self) -> None:
        """Tables for the n-grams that are taken by blocks: words of items, and items by length class and n-gram."""
        flat = np.concatenate(self.words)
        self.vocabulary, self.word = np.unique(flat, return_inverse=True)
        self.start = np.cumsum(self.length) - self.length
        key = np.repeat(np.arange(len(self.keys)), self.count)
        mine = self.common[key]
        size = np.maximum(4, np.ceil(np.log2(np.maximum(1, self.length[self.item[mine]])))).astype(np.int64)
        code = np.unique((size * len(self.keys) + key[mine]) * len(self.words) + self.item[mine])
        self.shared_key, self.shared_item = code // len(self.words), code % len(self.words)  # key: class and n-gram
        self.classes = np.unique(size).tolist()

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``grams``, number of the seed n-gram) of those that are seeds."""
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - _FILTER_BITS)])
        key = np.minimum(np.searchsorted(self.keys, grams[at]), max(0, len(self.keys) - 1))
        same = self.keys[key] == grams[at] if len(self.keys) else np.zeros(0, dtype=bool)
        return at[same], key[same]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``grams``, index into the seed table) for every pair of equal n-grams, of the rare ones."""
        at, key = self.find(grams)
        at, key = at[~self.common[key]], key[~self.common[key]]
        n = self.count[key]
        seed = np.repeat(self.low[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), seed

    def shared_windows(
        self, words: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, at: np.ndarray, key: np.ndarray
    ) -> list[tuple[int, int, int, int]]:
        """(text, item, first word, word behind the last) where a shared n-gram stands among enough words of an item.

        ``at``: the words that such n-grams (``key``) begin at; ``doc``: their texts, whose words are ``start`` to ``stop``.
        """
        out: list[tuple[int, int, int, int]] = []
        number = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        number = np.where(self.vocabulary[number] == words, number, len(self.vocabulary))
        present = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        for size in self.classes:
            step = 2 << size  # two items of the class
            ahead = np.cumsum((stop - start) // step + 1) - ((stop - start) // step + 1)
            block = ahead[doc] + (at - start[doc]) // step
            code = np.unique(block * len(self.keys) + key)
            block, gram = code // len(self.keys), code % len(self.keys)
            low, high = (np.searchsorted(self.shared_key, size * len(self.keys) + gram, side=x) for x in ("left", "right"))
            for rows in np.split(np.arange(len(block)), np.flatnonzero(np.diff(block)) + 1) if len(block) else []:
                spans = [self.shared_item[a:b] for a, b in zip(low[rows], high[rows]) if b > a]
                if not spans:
                    continue
                items = np.unique(np.concatenate(spans))
                text = int(np.searchsorted(ahead, block[rows[0]], side="right")) - 1
                first = int(start[text] + (block[rows[0]] - ahead[text]) * step)
                begin, end = max(int(start[text]), first - step), min(int(stop[text]), first + 2 * step)
                inside = number[begin:end]
                present[inside] = True
                present[-1] = False
                length = self.length[items]
                own = np.repeat(self.start[items] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                equal = np.add.reduceat(present[self.word[own]].astype(np.int64), np.cumsum(length) - length)
                present[inside] = False
                out += [(text, int(i), begin, end) for i in items[MATCH * equal >= self.needed[items]]]
        return out


def _grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, words, index of the first word, n-gram hash) of texts, n-grams of whole length only."""
    owner, words, _ = word_hashes(texts, letters_only=True)
    if len(words) < n:
        return owner, words, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    first = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
    _, grams = shingle_hashes(np.zeros(len(words), dtype=np.int64), words, n)
    return owner, words, first, grams[first]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, n: int, block_words: int):
    """(ids, words) of the items, a bounded number of words at a time; items of fewer than n words are left out."""
    ids, words, held = [], [], 0
    for row in benchmark.select(item_col, text_col).distinct().toLocalIterator():
        w = word_hashes([row[1] or ""], letters_only=True)[1]
        if len(w) < n:
            continue
        if held and held + len(w) > block_words:
            yield ids, words
            ids, words, held = [], [], 0
        ids.append(row[0])
        words.append(w)
        held += len(w)
    if ids:
        yield ids, words


def _frequencies(docs: DataFrame, text_col: str, table: Seeds, spark: SparkSession, n: int) -> dict[int, int]:
    """The places that hold each of the block's n-grams, over all documents (at most one entry per n-gram of the block)."""
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        count = np.zeros(len(seeds.keys), dtype=np.int64)
        for _, texts in text_slices(batches, text_col):
            _, key = seeds.find(_grams(texts, n)[3])
            count += np.bincount(key, minlength=len(count))
        some = count > 0
        yield pa.RecordBatch.from_arrays([pa.array(seeds.keys[some].view(np.int64)), pa.array(count[some])], names=["gram", "n"])

    counted = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in counted.collect()}


def _rare(ids: list, words: list[np.ndarray], grams: list[np.ndarray], places: dict[int, int], stretch: int) -> Seeds:
    """Seeds: the n-grams that some document holds, told into rare and shared ones (``stretch`` is kept for callers)."""
    picked, item, place = [], [], []
    for k, g in enumerate(grams):
        at = np.flatnonzero([places.get(x, 0) > 0 for x in g.view(np.int64).tolist()])
        picked.append(g[at]), place.append(at), item.append(np.full(len(at), k))
    return Seeds(ids, words, *(np.concatenate(x).astype(t) for x, t in ((picked, np.uint64), (item, np.int64), (place, np.int64))), places)


def _copies(seeds: Seeds, texts: list[str], n: int) -> list[tuple[int, int, int, int, int]]:
    """(text, item, score, first word, word behind the last) of every copy in some texts."""
    owner, words, first, grams = _grams(texts, n)
    at, seed = seeds.hits(grams)
    text_start = np.searchsorted(owner, np.arange(len(texts)))
    text_stop = np.searchsorted(owner, np.arange(len(texts)), side="right")
    item, doc = seeds.item[seed], owner[first[at]]
    length = seeds.length[item]
    begin = first[at] - seeds.place[seed] - length // 2
    stop = np.minimum(begin + 2 * length, text_stop[doc])
    begin = np.maximum(begin, text_start[doc])
    if seeds.classes:
        some, key = seeds.find(grams)
        some, key = some[seeds.common[key]], key[seeds.common[key]]
        wide = seeds.shared_windows(words, owner[first[some]], text_start, text_stop, first[some], key)
        more = np.array(wide, dtype=np.int64).reshape(-1, 4).T
        doc, item, begin, stop = (np.concatenate(x) for x in zip((doc, item, begin, stop), more))
    if not len(doc):
        return []
    order = np.lexsort((begin, item, doc))
    windows: list[list[int]] = []
    for d, i, a, b in zip(*(x[order].tolist() for x in (doc, item, begin, stop))):
        if windows and windows[-1][:2] == [d, i] and a <= windows[-1][3]:
            windows[-1][3] = max(b, windows[-1][3])
        else:
            windows.append([d, i, a, b])
    # an alignment needs needed() / MATCH equal words; far cheaper to count than to align
    wide = [words[a:b] for _, _, a, b in windows]
    enough = [k for k, (w, x) in enumerate(zip(wide, windows)) if MATCH * np.isin(w, seeds.words[x[1]]).sum() >= needed(len(seeds.words[x[1]]))]
    queries, wide = [seeds.words[windows[k][1]] for k in enough], [wide[k] for k in enough]
    score, end = align(queries, wide)
    good = [k for k in range(len(enough)) if score[k] >= needed(len(queries[k]))]
    _, back = align([queries[k][::-1] for k in good], [wide[k][: end[k]][::-1] for k in good])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k, reach in zip(good, back.tolist()):
        d, i, a, _ = windows[enough[k]]
        found = (int(score[k]), a + int(end[k]) - reach - int(text_start[d]), a + int(end[k]) - int(text_start[d]))
        if (d, i) not in best or (found[0], -found[1]) > (best[d, i][0], -best[d, i][1]):
            best[d, i] = found
    return [(d, i, *v) for (d, i), v in sorted(best.items())]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    ngram: int = NGRAM,
    stretch: int = STRETCH,
    block_words: int = BLOCK_WORDS,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per (row of ``docs``, item) that holds a copy of the item.

    Columns: ``id_col``, ``item_id``, ``score`` (share of the item's full alignment score, best place), ``word_start``,
    ``word_end`` (word positions of the copy).  Null or empty texts and items of fewer than ``ngram`` words match
    nothing; repeated rows of ``docs`` give repeated rows, repeated items count once (items of equal id and
    different text each).  Ids may be of any type.  Empty tables give an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    carried = [docs.schema[c] for c in (carry or (id_col,))]
    names = [f.name for f in carried]
    schema = T.StructType(
        [*carried, T.StructField("item_id", benchmark.schema[item_col].dataType), T.StructField("score", T.DoubleType()),
         T.StructField("word_start", T.LongType()), T.StructField("word_end", T.LongType())]
    )
    source = docs.select(*dict.fromkeys((*names, text_col)))
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    def finder(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            for part, texts in text_slices(batches, text_col):
                found = _copies(seeds, texts, ngram)
                rows = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)).take(rows) for c in names]
                    + [pa.array([seeds.ids[f[1]] for f in found], item_type),
                       pa.array([f[2] / (MATCH * len(seeds.words[f[1]])) for f in found], pa.float64()),
                       pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                    names=schema.names,
                )

        return run

    out = None
    for ids, words in _blocks(benchmark, item_col, item_text_col, ngram, block_words):
        grams = [shingle_hashes(np.zeros(len(w), dtype=np.int64), w, ngram)[1] for w in words]
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        everything = Seeds(ids, words, np.concatenate(grams), item, place)
        seeds = _rare(ids, words, grams, _frequencies(docs, text_col, everything, spark, ngram), stretch)
        part = source.mapInArrow(finder(spark.sparkContext.broadcast(seeds)), schema)
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that hold a copy of a test item; all columns pass unchanged.

    Rows are told apart by id and text, so a null or repeated id takes no other row with it.
    """
    digest = F.xxhash64(F.col(text_col))
    marked = docs.select(F.col(id_col).alias("_gone_id"), digest.alias("_gone_text"), F.col(text_col).alias("_body"))
    found = contaminated(
        marked, benchmark, "_gone_id", "_body", carry=("_gone_id", "_gone_text"), **settings
    ).select("_gone_id", "_gone_text").distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["_gone_id"]) & (digest == found["_gone_text"]), "left_anti")
