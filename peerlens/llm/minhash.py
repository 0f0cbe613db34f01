"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

Signature.  A text is a weighted set of word shingles.  Every element owns a region of the
(weight, rank) plane; a Poisson number of darts, drawn from a hash of the element, lands in each
unit of weight and rank interval, so equal elements throw the same darts in every text and a
heavier element keeps more of them.  A dart has a coordinate of the signature, a rank and a
place on the weight axis; it counts if that place lies within the element's weight.  The signature
keeps the earliest dart of each coordinate.  Rank intervals double in length and a text goes on to
the next interval only while a coordinate is still empty, so the work per text is its shingles plus a
constant, not shingles times coordinates.  Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity (plain Jaccard with weights of 1).

Joining.  Texts with equal words form a class first, so copies never meet in a bucket.  Class
representatives that share all coordinates of a band share a bucket.  With the default 24 bands of 4, a pair of similarity
0.8 misses all buckets with a probability of 3e-6.  Candidates are verified exactly on the words themselves.

A group of near copies has too many pairs to verify them all, so its pairs are cut down without losing links:

* a shingle that no other candidate text has cannot be shared, which bounds the similarity of a pair from
  above exactly (:func:`_possible`); a text that can reach no partner leaves its buckets;
* every member of a bucket is compared with the member of which most is shared (nearly always the original of the copies);
  what the found links connect needs no further comparison;
* in buckets that still hold several components the same is done with the best member outside of the first one's component;
* then all pairs that are still in different components are compared, each in the first bucket the
  two share, and only if 1024 bits of their long signatures agree as a similarity within five standard deviations of
  the limit would (a true link fails that with a probability below 1e-6).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import connected_components, free_name, give_back, text_slices, written
from peerlens.llm.wordhash import mix, normal_words, shingle_hashes, word_hashes
from peerlens.operators.hot_keys import hot_keys, spread_join

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 4
#: One-bit coordinates of the long signature.
BITS = 1024
#: Members of a bucket that are compared with each other, or with as many others, in one group.
BUCKET_BLOCK = 512
#: Rows per Arrow batch where rows hold one text, and where they hold two.
TEXT_ROWS = 2000
PAIR_ROWS = 200
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


@lru_cache(maxsize=64)
def _poisson(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts."""
    top = int(mean + 12 * mean**0.5 + 20)
    n = np.arange(top)
    log = n * np.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, top)))])
    return np.cumsum(np.exp(log))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


@np.errstate(over="ignore")  # hashes wrap around
def dart_signatures(
    owner: np.ndarray, element: np.ndarray, weight: np.ndarray | None, texts: int, coordinates: int
) -> np.ndarray:
    """Signatures (texts x coordinates, uint64) of weighted sets given as (owner, element hash, weight).

    ``weight`` None stands for 1 each; then repeats of an element change nothing.  Otherwise
    the elements of one owner must differ.  Rows of owners without elements stay at the largest value.
    """
    out = np.full(texts * coordinates, _EMPTY)
    element = mix(element)
    cell = np.zeros(len(owner), dtype=np.uint64)  # unit of weight within the element's region
    if weight is not None:
        units = np.ceil(weight).astype(np.int64)
        start = np.repeat(np.cumsum(units) - units, units)
        cell = (np.arange(len(start)) - start).astype(np.uint64)
        owner, element, weight = (np.repeat(x, units) for x in (owner, element, weight))
    for level in range(48):
        if not len(owner):
            break
        mean = 1.0 if level == 0 else 2.0 ** (level - 1)
        region = mix(element + cell * _ODD[0] + np.uint64(level + 1) * _ODD[1])
        darts = np.searchsorted(_poisson(mean), _unit(region), side="right")
        who = np.repeat(np.arange(len(owner)), darts)
        nth = np.arange(len(who)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(region[who] + (nth + 1).astype(np.uint64) * _ODD[2])
        if weight is not None:
            inside = cell[who] + _unit(mix(dart + _ODD[4])) < weight[who]
            who, dart = who[inside], dart[inside]
        place = owner[who] * coordinates + (mix(dart ^ _ODD[3]) % np.uint64(coordinates)).astype(np.int64)
        np.minimum.at(out, place, (np.uint64(level) << np.uint64(57)) | (dart >> np.uint64(7)))
        unfilled = (out.reshape(texts, coordinates) == _EMPTY).any(axis=1)
        go_on = unfilled[owner]
        owner, element, cell = owner[go_on], element[go_on], cell[go_on]
        weight = weight if weight is None else weight[go_on]
    return out.reshape(texts, coordinates)


def signatures(texts: list[str], coordinates: int, n: int = SHINGLE, weights: str = "set") -> np.ndarray:
    """DartMinHash signatures of texts; ``weights``: 1 per different shingle ("set") or its number of occurrences ("count")."""
    owner, words, _ = word_hashes(texts)
    with np.errstate(over="ignore"):
        owner, element = shingle_hashes(owner, words, n)
        if weights == "set":
            return dart_signatures(owner, element, None, len(texts), coordinates)
        order = np.lexsort((element, owner))
        owner, element = owner[order], element[order]
        first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])]) if len(owner) else np.zeros(0, int)
        count = np.diff(np.r_[first, len(owner)]).astype(np.float64)
        return dart_signatures(owner[first], element[first], count, len(texts), coordinates)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket number (int64) per text and band."""
    with np.errstate(over="ignore"):
        grid = signature.reshape(len(signature), bands, rows)
        h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[0], grid.shape[:2]).copy()
        for k in range(rows):
            h = mix(h * _ODD[1] + grid[:, :, k])
    return h.view(np.int64)


def text_key(text: str) -> bytes | None:
    """128-bit key of the words of a text; None without words."""
    words = normal_words(text)
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")) if words else None


def shingle_counts(text: str, n: int, weights: str) -> dict | set:
    """The weighted set of a text, from the words themselves."""
    words = normal_words(text)
    runs = list(zip(*(words[k:] for k in range(n)))) if len(words) >= n else [tuple(words)]
    if weights == "set":
        return set(runs)
    counts: dict = {}
    for r in runs:
        counts[r] = counts.get(r, 0) + 1
    return counts


def similarity(a: dict | set, b: dict | set) -> float:
    """(Weighted) Jaccard similarity."""
    if isinstance(a, set):
        both = len(a & b)
        return both / (len(a) + len(b) - both)
    both = sum(min(v, b[k]) for k, v in a.items() if k in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def _signed(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int, weights: str) -> DataFrame:
    schema = T.StructType([docs.schema[id_col], T.StructField("_key", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            buckets = band_hashes(signatures(texts, bands * rows, n, weights), bands, rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands), pa.array(buckets.ravel()))
            ids = part.column(part.schema.get_field_index(id_col))
            yield pa.RecordBatch.from_arrays([ids, pa.array(map(text_key, texts), pa.binary()), lists], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _keyed_texts(docs: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, text_col):
            yield pa.RecordBatch.from_arrays([pa.array(map(text_key, texts), pa.binary()), pa.array(texts)], names=["_key", "_text"])

    keyed = docs.select(text_col).mapInArrow(run, "_key binary, _text string")
    return keyed.where("_key is not null").groupBy("_key").agg(F.any_value("_text").alias("_text"))


def _traits(texts: DataFrame, n: int, weights: str) -> DataFrame:
    """Per candidate text: weight of its shingles, of those that no other candidate has, and BITS one-bit coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in text_slices(batches, "_text", 1_000_000):
            owner, words, _ = word_hashes(own)
            with np.errstate(over="ignore"):
                owner, element = shingle_hashes(owner, words, n)
            order = np.lexsort((element, owner))
            owner, element = owner[order], element[order]
            first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])])
            count = np.diff(np.r_[first, len(owner)]).astype(np.int64)
            keys = part.column(part.schema.get_field_index("_key")).take(pa.array(owner[first]))
            weight = count if weights == "count" else np.ones_like(count)
            yield pa.RecordBatch.from_arrays([keys, pa.array(element[first].view(np.int64)), pa.array(weight)], names=["_key", "_h", "_w"])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in text_slices(batches, "_text", 1_000_000):
            low = (signatures(own, BITS, n, weights) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(low, axis=1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * (BITS // 64)), pa.array(packed.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("_key")), lists], names=["_key", "_bits"])

    shingles = texts.mapInArrow(run, "_key binary, _h long, _w long")
    alone = shingles.groupBy("_h").agg(F.count(F.lit(1)).alias("_c"), F.min("_key").alias("_key"), F.min("_w").alias("_w")).where("_c = 1")
    alone = alone.groupBy("_key").agg(F.sum("_w").alias("_alone"))
    whole = shingles.groupBy("_key").agg(F.sum("_w").alias("_size"))
    signed = texts.mapInArrow(bits, "_key binary, _bits array<long>")
    return signed.join(whole, "_key").join(alone, "_key", "left").select(
        "_key", "_size", F.coalesce("_alone", F.lit(0)).alias("_alone"), "_bits"
    )


def _possible(size_a: str, alone_a: str, size_b: str, alone_b: str, least: float) -> Column:
    """Whether the similarity of two texts can reach ``least``, given what each shares with no other text."""
    a, b = F.col(size_a) - F.col(alone_a), F.col(size_b) - F.col(alone_b)
    return F.least(a, b) >= F.lit(least - 1e-9) * (F.greatest(a, b) + F.col(alone_a) + F.col(alone_b))


def _close(bits_a: str, bits_b: str, least: float) -> Column:
    """Whether so many one-bit coordinates agree as a similarity of ``least`` less five standard deviations gives."""
    agree = (1 + least) / 2
    most = BITS * (1 - agree) + 5 * (BITS * agree * (1 - agree)) ** 0.5
    differing = [F.bit_count(F.col(bits_a)[k].bitwiseXOR(F.col(bits_b)[k])) for k in range(BITS // 64)]
    return sum(differing[1:], differing[0]) <= math.ceil(most)


def _verified(pairs: DataFrame, texts: DataFrame, n: int, least: float, weights: str, label: tuple[str, str]) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``least`` similar: the columns named in ``label``."""
    left = texts.select(F.col("_key").alias("a"), F.col("_text").alias("_left"))
    right = texts.select(F.col("_key").alias("b"), F.col("_text").alias("_right"))
    joined = pairs.join(right, "b").join(left, "a").select("_left", "_right", *label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, None  # rows come sorted by the left text, of which a hub has many
        for batch in batches:
            ok = []
            for a, b in ((x.as_py(), y.as_py()) for x, y in zip(batch.column(0), batch.column(1))):
                if a != last_text:
                    last_text, last = a, shingle_counts(a, n, weights)
                ok.append(similarity(last, shingle_counts(b, n, weights)) >= least)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[2:]], names=["a", "b"])
        give_back()

    return joined.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    weights: str = "set",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``_key``, ``class_id``, ``kept``.

    Texts (words: lower case, split at white space) are linked if the Jaccard similarity of their
    sets of ``shingle`` words in a row is at least ``least``; a text of fewer words is one shingle.  Classes are what is reachable
    by links; ``class_id`` is the smallest id in the class, and ``kept`` marks its row.  Texts without words (null, empty, white space) link with nothing: each is
    a class of its own.  Null ids come after all others; rows with equal id and words share ``kept``.  ``_key`` is the key of the words
    (null without words).  Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    signed = written(_signed(docs, id_col, text_col, shingle, bands, rows, weights), "signed", TEXT_ROWS)
    owner = F.struct(F.col(id_col).isNull().alias("late"), F.col(id_col).alias("id"), F.col("_key").alias("key"))
    classes = written(
        signed.where("_key is not null").groupBy("_key").agg(F.min(owner).alias("_owner"), F.any_value("_bands").alias("_bands")), "classes"
    )
    banded = classes.select("_key", F.explode("_bands").alias("_bucket"))
    shared = banded.groupBy("_bucket").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi")).where("_lo < _hi")
    linked = written(banded.join(shared.select("_bucket"), "_bucket"), "buckets")

    wanted = linked.select("_key").distinct().join(classes, "_key").select(F.col("_owner.id").alias("_id"))
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_body"))
    source = source.join(wanted, F.col("_doc").eqNullSafe(F.col("_id")), "left_semi")
    texts = written(_keyed_texts(source, "_body"), "texts", TEXT_ROWS)

    traits = written(_traits(texts, shingle, weights), "traits", TEXT_ROWS)
    reachable = traits.where(F.col("_size") - F.col("_alone") >= F.lit(least - 1e-9) * F.col("_size"))
    share = F.struct((F.col("_alone") / F.col("_size")).alias("share"), "_key", "_size", "_alone", "_comp")
    linked = written(
        linked.select("_bucket", "_key").join(reachable, "_key").join(classes.select("_key", "_bands"), "_key"), "reachable"
    )
    hot = hot_keys(linked, ["_bucket"])  # their members are dealt over several tasks
    components = spark.createDataFrame([], "node binary, comp binary")
    for step in ("best", "second", "rest"):
        tagged = linked.join(components.withColumnRenamed("node", "_key"), "_key", "left").withColumn("_comp", F.coalesce("comp", "_key")).drop("comp")
        leads = tagged.groupBy("_bucket").agg(
            F.min("_comp").alias("_first"), F.max("_comp").alias("_last"), F.min(share).alias("_lead"), F.count(F.lit(1)).alias("_members")
        ).where("_first < _last").select("_bucket", "_lead", "_members")
        open_ = written(spread_join(tagged, leads, ["_bucket"], "inner", hot, ["_key"]), "open")
        if open_.isEmpty():
            break
        if step == "second":  # the best member outside of the best one's component
            others = open_.where("_comp != _lead._comp").groupBy("_bucket").agg(F.min(share).alias("_lead"))
            open_ = spread_join(open_.drop("_lead"), others, ["_bucket"], "inner", hot, ["_key"])
        if step == "rest":
            columns = ["_key", "_comp", "_size", "_alone", "_bits", "_bands"]
            # a large bucket is compared block by block, each pair of blocks a group of its own
            blocks = F.ceil(F.col("_members") / BUCKET_BLOCK)
            own, every = F.pmod(F.xxhash64("_key"), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
            one = open_.select("_bucket", own.alias("_x"), every.alias("_y"), *(F.col(c).alias(c + "_a") for c in columns))
            two = open_.select("_bucket", every.alias("_x"), own.alias("_y"), *(F.col(c).alias(c + "_b") for c in columns))
            pairs = one.join(two, ["_bucket", "_x", "_y"]).where(
                (F.col("_key_a") < F.col("_key_b")) & (F.col("_comp_a") != F.col("_comp_b"))
                & _possible("_size_a", "_alone_a", "_size_b", "_alone_b", least) & _close("_bits_a", "_bits_b", least)
                & (F.array_min(F.array_intersect("_bands_a", "_bands_b")) == F.col("_bucket"))
            )
            pairs = pairs.select(F.col("_key_a").alias("a"), F.col("_key_b").alias("b"), F.col("_comp_a").alias("_a"), F.col("_comp_b").alias("_b"))
        else:
            pairs = open_.select(
                F.col("_lead._key").alias("a"), F.col("_key").alias("b"), F.col("_lead._comp").alias("_a"), F.col("_comp").alias("_b"),
                F.col("_lead._size").alias("_size_a"), F.col("_lead._alone").alias("_alone_a"), F.col("_size").alias("_size_b"), F.col("_alone").alias("_alone_b"),
            ).where("_a != _b").where(_possible("_size_a", "_alone_a", "_size_b", "_alone_b", least)).select("a", "b", "_a", "_b").distinct()
        found = written(_verified(pairs, texts, shingle, least, weights, ("_a", "_b")), "links", PAIR_ROWS)
        if found.isEmpty():
            continue
        joined = connected_components(found).select(F.col("node").alias("comp"), F.col("comp").alias("_wider"))
        known = components.union(components.select("comp", "comp").distinct()).union(joined.select("comp", "comp")).toDF("node", "comp").distinct()
        components = written(
            known.join(joined, "comp", "left").select("node", F.coalesce("_wider", "comp").alias("comp")).distinct(), "components"
        )

    member = classes.join(components.withColumnRenamed("node", "_key"), "_key", "left").select(
        "_key", "_owner", F.coalesce("comp", "_key").alias("_comp")
    )
    heads = member.groupBy("_comp").agg(F.min("_owner").alias("_head"))
    owners = member.join(heads, "_comp").select("_key", "_head")
    ids = F.col(id_col)
    return signed.select(id_col, "_key").join(owners, "_key", "left").select(
        id_col,
        "_key",
        F.when(F.col("_key").isNull(), ids).otherwise(F.col("_head.id")).alias("class_id"),
        (F.col("_key").isNull() | (ids.eqNullSafe(F.col("_head.id")) & (F.col("_key") == F.col("_head.key")))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: that of the smallest id (see :func:`near_duplicates`).

    All columns pass unchanged.  Repeated rows (equal id and words) stay once.  Rows without words stay, but of
    those that are equal in all columns, with an id, one (all, if a column's type cannot be compared: maps).
    """
    found = near_duplicates(docs, id_col, text_col, **settings)
    near_key, gone_id, gone_key = (free_name(docs, c) for c in ("near_key", "gone_id", "gone_key"))
    dropped = found.where("not kept").select(F.col(id_col).alias(gone_id), F.col("_key").alias(gone_key)).distinct()
    schema = T.StructType([*docs.schema.fields, T.StructField(near_key, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(text_key, texts), pa.binary())], names=schema.names)

    keyed = docs.mapInArrow(run, schema)
    gone = keyed[id_col].eqNullSafe(dropped[gone_id]) & (keyed[near_key] == dropped[gone_key])
    kept = keyed.where(F.col(near_key).isNotNull()).join(dropped, gone, "left_anti").dropDuplicates([id_col, near_key])
    # a text with a letter or digit has words, so few rows are read for the others
    bare = docs.where(~F.coalesce(F.col(text_col), F.lit("")).rlike("[0-9A-Za-z]")).mapInArrow(run, schema).where(F.col(near_key).isNull())
    if not any(x in docs.schema.simpleString() for x in ("map<", "variant")):
        bare = bare.where(F.col(id_col).isNull()).union(bare.where(F.col(id_col).isNotNull()).dropDuplicates())
    return kept.union(bare).drop(near_key)
