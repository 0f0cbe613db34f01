"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from peerlens.llm import spelling
from peerlens.llm.spelling import RUN


def _near(a, b):
    """One inserted, deleted or replaced code point, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _forms(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if _near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] < ratio * n:
            best = None
        out[w] = [n, len(near), best, counts[best] if best else None]
    rows = []
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.append((w, *row, root))
    return sorted(rows)


@pytest.fixture(scope="module")
def counts():
    """Families of edits with accents, runs of one letter, chains, ties and long words."""
    rng = random.Random(3)
    letters = "abcdeéÀÿ×÷z"
    found = Counter()
    for base in ("garden", "aaaaaa", "éàéàéà", "x" * 47, "y" * 48, "z" * 300, "banana", "abcde"):
        for _ in range(25):
            word = base
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(word))
                word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])
            found[word] += rng.choice([1, 1, 2, 4, 8, 16, 64])
    found["日本語の"], found["日本語を"], found["𝒳abcd"], found["abcd"] = 4, 9, 5, 5
    return dict(found)


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 64])
def test_forms_equal_brute_force(spark, counts, filter_bytes):
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    got = spelling.spelling_forms(df, filter_bytes=filter_bytes)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert sorted(map(tuple, got.collect())) == _forms(counts)


def test_hashes_of_edits_are_those_of_the_words():
    words = ["garden", "aab", "é" * 5, "x" * 60]
    sums = spelling.Words(words)
    for own, h in zip(*sums.deletions()):
        at = [w[:i] + w[i + 1 :] for w in [words[own]] for i in range(len(w))]
        assert h in spelling.Words(at).hashes()
    assert len(sums.deletions()[0]) == 6 + 2 + 1 + 1  # runs of a letter once
    own, h = sums.replacements(ord("f"), np.array([True, True, True, False]))
    assert sorted(h) == sorted(spelling.Words(["gfrden", "garfen", "gardfn", "fab", "afb", "aaf"]).hashes())


def test_filters_hold_all_words_and_few_others(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(5, 9))) for _ in range(6000)]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    vocabulary = spelling._vocabulary(df)
    sizes = {r["shard"]: -(-r["count"] // spelling.WORDS_PER_BLOCK) for r in vocabulary.groupBy("shard").count().collect()}
    filters = spelling.Filters(sizes, {s: (0, n) for s, n in sizes.items()}, spelling.filter_blocks(vocabulary, sizes).toArrow())

    def passed(words):
        sums = spelling.Words(words)
        return len(filters.positives(sums.hashes(), np.minimum(sums.size, spelling.LAST_SHARD)))

    assert passed(words) == len(words)
    others = ["".join(rng.choices("klmnopqrst", k=rng.randint(5, 9))) for _ in range(60000)]
    assert passed(others) < 300
    parts = spelling.passes(sizes, 40)
    assert all(sum(b - a for a, b in p.values()) <= 40 for p in parts)
    assert sum(b - a for p in parts for a, b in p.values()) == sum(sizes.values())


def test_words_and_damage_as_stated(spark):
    texts = [
        (1, "The THE the, ÉTÉ été İstanbul naïve×x don't"), (2, None), (3, ""), (None, "the Garden"), (4, "1 2 _ ßİ"),
        (1, "The THE the, ÉTÉ été İstanbul naïve×x don't"),
    ]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    for every in (None, 2, 97):
        want = Counter()
        for i, text in texts:
            for run in RUN.findall(text or ""):
                word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
                if every and h % every == 0:
                    k = h % len(word)
                    word = word[:k] + word[k + 1 :]
                if word:
                    want[word] += 1
        got = {r.word: r.n for r in spelling.word_counts(df, every=every).collect()}
        assert got == dict(want)


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_PIECE", 7)
    text = "alpha beta " * 50 + "x" * 100 + " omega"
    assert "".join(spelling._pieces(text)) == text
    assert [w for p in spelling._pieces(text) for w in RUN.findall(p)] == RUN.findall(text)


def test_empty_tables_repeats_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "word string, n bigint")
    assert spelling.spelling_forms(empty).collect() == []
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.word_counts(docs).collect() == []
    rows = [("garden", 5), ("garden", 5), (None, 7), ("gardan", 1), ("", 2)]
    df = spark.createDataFrame(rows, "word string, n int").selectExpr("*", "1 AS h", "2 AS shard", "3 AS near", "4 AS _up")
    got = {r.word: tuple(r)[1:] for r in spelling.spelling_forms(df).collect()}
    assert got == {"garden": (10, 1, None, None, "garden"), "gardan": (1, 1, "garden", 10, "garden"), "": (2, 0, None, None, "")}
    text_ids = spark.createDataFrame([("a", "hello hello", 1)], "doc_id string, text string, word int")
    assert [tuple(r) for r in spelling.word_counts(text_ids).collect()] == [("hello", 2)]
