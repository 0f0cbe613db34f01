"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

1. :func:`word_counts` counts the words of whole texts (pre-aggregated in every task, then one shuffle by word).
2. The vocabulary goes into blocked Bloom filters, one shard per word length (lengths from ``LAST_SHARD`` on share one): a
   word sets one bit in each of the eight 32-bit lanes of one 256-bit block.  Spark builds them with ``bit_or`` per block.
3. The filters are broadcast ``FILTER_BYTES`` at a time (a larger vocabulary takes more passes over itself, never a larger
   broadcast).  Every word generates its edits as hashes: all deletions, and all replacements by a greater letter of
   the target shard.  Of two words one edit apart one always generates the other so: the longer by a deletion, or the
   smaller by a replacement; insertions are the deletions of the other word.  An edit whose eight bits are set is a positive.
4. Only positives, as pairs of hashes, are shuffled to an exact join with the vocabulary; a comparison of the two words
   removes what the filter or the hash let through by chance.  No link is lost: a filter has no false negatives.
5. :func:`spelling_forms` picks every word's form among its near words and follows forms to the last by pointer doubling.

Nulls and edge cases: null texts hold no words, null ids count as empty text, repeated rows count again, null words of a
vocabulary are left out and repeated ones are added up; words are compared by code points; a very long text is cut at the ends of words only;
an empty table gives an empty result; columns beside those named are not read, so their names may clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.llm.common import shared_folder, text_slices, written
from peerlens.llm.wordhash import mix

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOT_RUN = re.compile("[^A-Za-zÀ-ÿ]")
#: Words of this many code points and more share a filter shard.
LAST_SHARD = 48
#: Words per 256-bit block of a filter: 16 bits a word, about one false positive in 1,500 probes.
WORDS_PER_BLOCK = 16
LANES = 8
#: Filter bytes broadcast at a time.
FILTER_BYTES = 64 << 20
#: Distinct words that a counting task holds before it passes them on.
HELD_WORDS = 200_000
#: Code points of vocabulary words that are edited together.
EDIT_CHARS = 200_000
_PIECE = 1_000_000
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)


# -- words -------------------------------------------------------------------
def _pieces(text: str) -> Iterator[str]:
    """A text in parts of about a million characters that cut no word."""
    start = 0
    while start < len(text):
        cut = NOT_RUN.search(text, start + _PIECE)
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop


def damaged(word: str, owner: bytes, every: int) -> str:
    """``word`` without one code point if ``every`` divides the crc32 of ``<owner>:<word>``."""
    h = zlib.crc32(word.encode(), zlib.crc32(owner + b":"))
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = None, least_size: int = 1
) -> DataFrame:
    """``word``, ``n``: occurrences of every word of at least ``least_size`` code points.

    A word is a maximal run of Latin letters (ASCII and U+00C0 to U+00FF), of which A-Z are lower-cased.
    ``every``: a run loses one code point where that number divides its hash with the document's id (:func:`damaged`), which plants misspellings.
    """

    def flush(counts: Counter) -> pa.RecordBatch:
        batch = pa.record_batch(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )
        counts.clear()
        return batch

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part, texts in text_slices(batches, "_text"):
            for owner, text in zip(part.column(0).to_pylist(), texts):
                owner = (owner or "").encode()
                for piece in _pieces(text):
                    for word, n in Counter(RUN.findall(piece.encode().lower().decode())).items():
                        if every:
                            word = damaged(word, owner, every)
                        if len(word) >= least_size:
                            counts[word] += n
                    if len(counts) >= HELD_WORDS:
                        yield flush(counts)
        if counts:
            yield flush(counts)

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# -- hashes of words and of their edits --------------------------------------
def _letter(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))


@lru_cache(maxsize=2)
def _powers(size: int) -> np.ndarray:
    up = np.full(size, _BASE, dtype=np.uint64)
    up[0] = 1
    return np.multiply.accumulate(up)


class Words:
    """Code points of some words one after the other, and the sums that hashes of edits are made of."""

    def __init__(self, words: list[str]):
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(words)), self.size)
        start = np.cumsum(self.size) - self.size
        place = np.arange(len(self.codes)) - start[self.owner]
        self.power = _powers(1 << (int(self.size.max(initial=1)) + 1).bit_length())[place]
        term = _letter(self.codes) * self.power
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term)])
        self.raw = total[start + self.size] - total[start]
        before = total[:-1] - total[start][self.owner]
        self.without = before + (self.raw[self.owner] - before - term) * np.uint64(_INVERSE)

    def hashes(self) -> np.ndarray:
        return finish(self.raw, self.size)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of all different words that lack one code point."""
        same_next = (self.codes[1:] == self.codes[:-1]) & (self.owner[1:] == self.owner[:-1])
        at = np.flatnonzero(~np.append(same_next, False)) if len(self.codes) else np.zeros(0, dtype=np.int64)
        return self.owner[at], finish(self.without[at], self.size[self.owner[at]] - 1)

    def replacements(self, letter: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) with one smaller code point replaced by ``letter``, for the words that are ``allowed``."""
        at = np.flatnonzero((self.codes < letter) & allowed[self.owner])
        own = self.owner[at]
        change = (_letter(np.array([letter])) - _letter(self.codes[at])) * self.power[at]
        return own, finish(self.raw[own] + change, self.size[own])


def finish(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(raw + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lane_source(h: np.ndarray) -> np.ndarray:
    """The number whose 5-bit groups name the bits of a hash in the lanes of its block."""
    return mix(h ^ np.uint64(0xA0761D6478BD642F))


def _word_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        held, chars = [], 0
        for word in batch.column(0).to_pylist():
            if held and chars + len(word) > EDIT_CHARS:
                yield held
                held, chars = [], 0
            held.append(word)
            chars += len(word)
        if held:
            yield held


def _vocabulary(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``h`` (hash), ``g`` (lanes), ``shard`` of the different words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, done = batch.column(1), 0
            for part in _word_slices(iter([batch])):
                sums = Words(part)
                h = sums.hashes()
                yield pa.record_batch(
                    [
                        pa.array(part, pa.string()),
                        n.slice(done, len(part)),
                        pa.array(h.view(np.int64)),
                        pa.array(lane_source(h).view(np.int64)),
                        pa.array(np.minimum(sums.size, LAST_SHARD).astype(np.int32)),
                    ],
                    names=["word", "n", "h", "g", "shard"],
                )
                done += len(part)

    rows = words.where("word is not null").groupBy("word").agg(F.sum(F.col("n").cast("bigint")).alias("n"))
    return written(rows.mapInArrow(hashed, "word string, n bigint, h bigint, g bigint, shard int"), "vocabulary")


# -- filters -----------------------------------------------------------------
def filter_blocks(vocabulary: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``shard``, ``block`` and the lanes ``l0`` to ``l7`` of every block that holds a word."""
    spark = vocabulary.sparkSession
    blocks = spark.createDataFrame(list(sizes.items()), "shard int, _blocks bigint")
    at = F.shiftright(F.shiftrightunsigned("h", 32) * F.col("_blocks"), 32)
    bits = [F.expr(f"bit_or(shiftleft(1, int(shiftrightunsigned(g, {5 * i}) & 31)))").alias(f"l{i}") for i in range(LANES)]
    # at most LAST_SHARD rows
    return vocabulary.join(F.broadcast(blocks), "shard").groupBy("shard", at.alias("block")).agg(*bits)


def passes(sizes: dict[int, int], most: int) -> list[dict[int, tuple[int, int]]]:
    """The shards, cut where needed, dealt into passes of at most ``most`` blocks: shard to (first block, end)."""
    out: list[dict[int, tuple[int, int]]] = []
    free = 0
    for shard, blocks in sorted(sizes.items()):
        first = 0
        while first < blocks:
            if not free:
                out.append({})
                free = most
            end = min(blocks, first + free)
            out[-1][shard] = (first, end)
            free -= end - first
            first = end
    return out


class Filters:
    """The blocks of one pass, as arrays that tasks probe."""

    def __init__(self, sizes: dict[int, int], held: dict[int, tuple[int, int]], table: pa.Table):
        self.blocks, self.first, self.end, self.base = (np.zeros(LAST_SHARD + 1, dtype=np.uint64) for _ in range(4))
        total = 0
        for shard, (first, end) in held.items():
            self.blocks[shard], self.first[shard], self.end[shard], self.base[shard] = sizes[shard], first, end, total
            total += end - first
        shard = table["shard"].to_numpy()
        at = (table["block"].to_numpy().astype(np.uint64) - self.first[shard] + self.base[shard]).astype(np.int64)
        self.lanes = np.zeros((LANES, total), dtype=np.uint32)
        for i in range(LANES):
            self.lanes[i, at] = table[f"l{i}"].to_numpy().view(np.uint32)

    def positives(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Indices of the hashes whose bits are all set (those of blocks of other passes are not)."""
        block = ((h >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32)
        left = np.flatnonzero((block >= self.first[shard]) & (block < self.end[shard]))
        own = shard[left]
        at = (block[left] - self.first[own] + self.base[own]).astype(np.int64)
        g = lane_source(h[left])
        for i in range(LANES):
            bit = (g >> np.uint64(5 * i)).astype(np.uint32) & np.uint32(31)
            hit = np.flatnonzero((self.lanes[i, at] >> bit) & np.uint32(1))
            left, at, g = left[hit], at[hit], g[hit]
        return left


def _probe(vocabulary: DataFrame, filters: Filters, letters: dict[int, list[int]]) -> DataFrame:
    """``h`` (hash of an edit that the filters hold), ``source`` (hash of the word it was made of)."""
    shared = vocabulary.sparkSession.sparkContext.broadcast((filters, letters))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, letters = shared.value
        for part in _word_slices(batches):
            words = Words(part)
            source, shard = words.hashes(), np.minimum(words.size, LAST_SHARD)
            found = []

            def test(owner: np.ndarray, h: np.ndarray, target: np.ndarray) -> None:
                hit = filters.positives(h, target[owner])
                found.append((h[hit], source[owner[hit]]))

            test(*words.deletions(), np.minimum(words.size - 1, LAST_SHARD))
            for letter in sorted({a for held in letters.values() for a in held}):
                allowed = np.zeros(LAST_SHARD + 1, dtype=bool)
                allowed[[s for s, held in letters.items() if letter in held]] = True
                test(*words.replacements(letter, allowed[shard]), shard)
            yield pa.record_batch(
                [pa.array(np.concatenate(a).view(np.int64)) for a in zip(*found)], names=["h", "source"]
            )

    near = [s for s in filters.blocks.nonzero()[0].tolist()]
    rows = vocabulary.where(F.col("shard").isin(sorted({*near, *(min(s + 1, LAST_SHARD) for s in near)})))
    return rows.select("word").mapInArrow(probe, "h bigint, source bigint")


def _letters(vocabulary: DataFrame) -> dict[int, list[int]]:
    """The code points that occur in the words of every shard (distinct in every task first)."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for part in _word_slices(batches):
            words = Words(part)
            code = np.unique(words.codes.astype(np.int64) * 64 + np.minimum(words.size, LAST_SHARD)[words.owner])
            seen.update(zip((code % 64).tolist(), (code // 64).tolist()))
        shards, codes = zip(*sorted(seen)) if seen else ((), ())
        yield pa.record_batch([pa.array(shards, pa.int32()), pa.array(codes, pa.int64())], names=["shard", "code"])

    out: dict[int, list[int]] = {}
    for row in vocabulary.select("word").mapInArrow(distinct, "shard int, code bigint").distinct().collect():
        out.setdefault(row.shard, []).append(row.code)
    return out


# -- links and forms ---------------------------------------------------------
def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """The different words with their summed counts (``word``, ``n``), and all pairs one edit apart.

    The pairs (``word``, ``n``, ``near``, ``near_n``) are listed in both directions, each once.
    """
    spark = words.sparkSession
    vocabulary = _vocabulary(words)
    counted = vocabulary.groupBy("shard").count().collect()  # at most LAST_SHARD rows
    sizes = {r["shard"]: math.ceil(r["count"] / WORDS_PER_BLOCK) for r in counted if r["shard"] > 0}
    letters = _letters(vocabulary)
    blocks = written(filter_blocks(vocabulary, sizes), "filters") if sizes else None
    folder = shared_folder(spark, "positives")
    kind = "h bigint, source bigint"
    spark.createDataFrame([], kind).write.parquet(f"{folder}/pass=none")
    for k, held in enumerate(passes(sizes, max(1, filter_bytes // (4 * LANES)))):
        mine = F.lit(False)
        for shard, (first, end) in held.items():
            mine |= (F.col("shard") == shard) & (F.col("block") >= first) & (F.col("block") < end)
        filters = Filters(sizes, held, blocks.where(mine).toArrow())
        _probe(vocabulary, filters, letters).write.parquet(f"{folder}/pass={k}")
    positives = spark.read.schema(kind).parquet(f"{folder}/pass=*").distinct()
    one = vocabulary.select(F.col("h").alias("source"), F.col("word").alias("_a"), F.col("n").alias("_na"))
    two = vocabulary.select("h", F.col("word").alias("_b"), F.col("n").alias("_nb"))
    pairs = positives.join(two, "h").join(one, "source").where(F.levenshtein("_a", "_b", 1) == 1)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("_a").alias("word"), F.col("_na").alias("n"), F.col("_b").alias("near"), F.col("_nb").alias("near_n")),
        F.struct(F.col("_b").alias("word"), F.col("_nb").alias("n"), F.col("_a").alias("near"), F.col("_na").alias("near_n")),
    )).alias("_p")).select("_p.*")
    return vocabulary.select("word", "n"), written(both.distinct(), "near-words")


def spelling_forms(words: DataFrame, ratio: int = 2, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per word of ``words`` (columns ``word``, ``n``): ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    ``n_near`` is the number of words one inserted, deleted or replaced code point away.  ``form`` is the near word of
    largest ``n`` (ties: smallest in code-point order) if that is at least ``ratio`` (at least 2) times the word's, else
    null.  ``root`` follows forms to the last one (the word itself if it has none).
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: counts must grow along a chain of forms")
    spark = words.sparkSession
    vocabulary, links = near_words(words, filter_bytes)
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    formed = F.when(-F.col("_best.less") >= ratio * F.col("n"), F.col("_best.near"))
    table = written(
        vocabulary.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), formed.alias("form"),
            F.when(formed.isNotNull(), -F.col("_best.less")).alias("form_n"),
        ),
        "forms",
    )
    # n at least doubles with every step, so the longest chain is bounded by the spread of n
    ends = table.where("n > 0").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    steps = int(math.log2(ends.hi / ends.lo)) + 1 if ends.lo else 1
    up = table.where("form is not null").select("word", F.col("form").alias("_up"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        over = up.select(F.col("word").alias("_up"), F.col("_up").alias("_over"))
        up = written(up.join(over, "_up", "left").select("word", F.coalesce("_over", "_up").alias("_up")), "roots")
    return table.join(up, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("_up", "word").alias("root")
    )
