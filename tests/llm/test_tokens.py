"""BPE, token counts and token files against the libraries, and their edge cases."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from peerlens.llm import bpe, queries, tokencount, tokenfile
from tests.conftest import SF_SMOKE

RANKS, WORDS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b \n\n c\t", "don't we'll I'M 's", "a" * 3000, "ab" * 4000, "=" * 700, "x\x1cy\x1d z\x85w  v",
    "ﬁ😀😀 日本語テキスト" * 30, "<s> </s><unk> ▁▁a <|endoftext|>x<|startoftext|>", "J̌ Σας İstanbul ÅÄ ½²³ ªº", "Çétait ñ über\r\n\r\nß",
    "nul\x00   ﻿ é",
]


def _texts(seed=3, n=150):
    rng = random.Random(seed)
    some = ["".join(rng.choice("ab cdeth\n .,'é😀在\t0123-_") for _ in range(rng.randint(1, 800))) for _ in range(n)]
    return ODD + some + ["".join(rng.choice("aeiounrstl") for _ in range(3000))]


def _docs(spark):
    rows = [(1, "one two"), (2, None), (3, ""), (None, "no id"), (1, "one two"), (4, "long " * 30_000), (1, "another text of the same id")]
    return spark.createDataFrame([(i, t, "x", [7]) for i, t in rows], "doc_id long, text string, n_tokens string, ids array<int>")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_library(spark, encoding):
    texts = _texts() + [r.text for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("text").collect()]
    coder = bpe.load(RANKS, P.PATTERN)
    for _ in range(2):  # cold and warm table
        got = coder.encode_batch(texts)
        assert [g.tolist() for g in got] == [encoding.encode_ordinary(t) for t in texts]
    assert [coder.decode(g) for g in got] == [t.encode() for t in texts]


def test_merges_where_one_round_must_not_take_all_places():
    """A vocabulary in which a pair with a merged token ranks before that token."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 400, b"ab": 300, b"abab": 299}
    coder = bpe.ByteBpe(ranks, r"\S+|\s+")

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            best = min(((ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(10**9, 0))
            if best[0] == 10**9:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    rng = random.Random(1)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    assert [np.frombuffer(x, "<i4").tolist() for x in coder.merge(words)] == [plain(w) for w in words]


def test_bpe_frames(spark, encoding):
    rows = bpe.bpe_decode(bpe.bpe_encode(_docs(spark), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(rows) == 7 and rows[0].n_tokens == "x"
    by_text = {(r.doc_id, len(r.ids)): bytes(r.decoded) for r in rows}
    assert by_text[2, 0] == b"" and by_text[3, 0] == b""
    assert sorted(len(r.ids) for r in rows if r.doc_id == 1)[:2] == [2, 2]
    assert {bytes(r.decoded) for r in rows if r.doc_id == 4} == {b"long " * 30_000}
    digests = bpe.with_digests(bpe.bpe_encode(_docs(spark), RANKS, P.PATTERN, decoded_col="decoded"))
    assert {r.n_tokens for r in digests.where("doc_id = 2").collect()} == {0}
    assert bpe.bpe_encode(_docs(spark).limit(0), RANKS, P.PATTERN).count() == 0


def test_counts_equal_library(spark):
    texts = _texts(5) + [r.text for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("text").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    machine = tokencount.Transducer(PIECES)
    want = [len(x) for x in library.encode(texts)]
    assert machine.counts(texts).tolist() == want
    machine._empty()  # a flushed table changes no count
    assert machine.counts(texts[::-1]).tolist() == want[::-1]


def test_chunk_maps_compose(monkeypatch):
    """Any chunk length gives the same counts, also where a chunk has no cut point."""
    texts = ["e" * 2000, "internationalisation" * 80, "a b " * 300, "在e" * 90]
    machine = tokencount.Transducer(PIECES)
    want = machine.counts(texts).tolist()
    for size in (1, 3, 17):
        monkeypatch.setattr(tokencount, "CHUNK", size)
        assert machine.counts(texts).tolist() == want


def test_count_frames(spark):
    rows = tokencount.token_counts(_docs(spark).drop("n_tokens"), PIECES, 100).collect()
    assert len(rows) == 7
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in rows if r.doc_id in (2, 3)} == {(0, 0, False)}
    assert [r.over_limit for r in rows if r.doc_id == 4] == [True]
    assert tokencount.token_counts(_docs(spark).limit(0), PIECES, 100).count() == 0


def test_word_encoder_equals_library():
    library, own = Tokenizer.from_file(WORDS), tokenfile.WordEncoder(WORDS)
    texts = _texts(9) + ["".join(chr(random.Random(k).choice([39, 65, 97, 0x17F, 0xB5, 0x2019, 32, 0x130, 0x3A3])) for k in range(60))]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


@pytest.mark.parametrize("bits", [False, True])
def test_plane_files(bits):
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (0, 1, 999, 1000, 2500, 7)]
    out = io.BytesIO()
    writer = tokenfile.PlaneWriter(out, chunk_ids=1000, bits=bits)
    for p in parts:
        writer.add(p)
    total = writer.close()
    everything = np.concatenate(parts)

    class File:
        def __init__(self, raw):
            self.raw, self.at = raw, 0

        def size(self):
            return len(self.raw)

        def seek(self, at):
            self.at = at

        def read(self, n):
            return self.raw[self.at : self.at + n]

    reader = tokenfile.PlaneReader(File(out.getvalue()))
    assert total == len(everything)
    for start, n in ((0, total), (0, 0), (995, 10), (3000, 1507), (total - 1, 1), (total, 0)):
        assert (reader.read(start, n) == everything[start : start + n]).all()
    with pytest.raises(ValueError):
        tokenfile.PlaneReader(File(out.getvalue()[:-3]))


def test_token_file_frames(spark):
    index = tokenfile.write_token_files(_docs(spark), WORDS, 2, chunk_ids=64)
    rows = sorted(tokenfile.read_token_files(index).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(WORDS)
    texts = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in _docs(spark).collect()))
    assert [r.doc_id for r in rows] == [None, 1, 1, 1, 2, 3, 4]
    at = 0
    for row, (_, text) in zip(rows, texts):
        want = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == want and (row.start, row.n_tokens) == (at, len(want))
        at += len(want)
    assert tokenfile.write_token_files(_docs(spark).limit(0), WORDS, 2).count() == 0


def test_registered_token_queries(spark, encoding):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()}
    coded = {r.doc_id: r for r in queries.op3_byte_bpe(spark, SF_SMOKE).collect()}
    counted = {r.doc_id: r for r in queries.op9_token_counts(spark, SF_SMOKE).collect()}
    filed = sorted(queries.op7_token_files(spark, SF_SMOKE).collect())
    assert set(coded) == set(counted) == {r.doc_id for r in filed} == set(docs)
    pieces, words, at = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS), 0
    for r in filed:
        text = docs[r.doc_id]
        ids = encoding.encode_ordinary(text)
        assert coded[r.doc_id].n_tokens == len(ids)
        assert coded[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert coded[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert counted[r.doc_id].n_tokens == len(pieces.encode(text)) and counted[r.doc_id].n_bytes == len(text.encode())
        own = np.array([*words.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    assert dict(queries.op9_token_counts(spark, SF_SMOKE).dtypes)["over_limit"] == "boolean"


# -- long pieces, runs without cut points ------------------------------------
def _alphabets(rng):
    yield "a" * 30_000
    yield "ab" * 9_000 + "é" * 9_000
    yield "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30_000))
    yield "".join(rng.choices("etaoin", k=25_000))
    yield "=" * 20_000 + "-" * 9_000
    yield "日本語" * 4_000
    yield "x" + " " * 20_000 + "y"


def test_long_pieces_equal_library_and_matrix(encoding, monkeypatch):
    coder = bpe.load(RANKS, P.PATTERN)
    rng = random.Random(4)
    for text in _alphabets(rng):
        assert coder.encode_batch([text])[0].tolist() == encoding.encode_ordinary(text)
    pieces = ["".join(rng.choices("ehitsraonl", k=rng.randint(2, 90))).encode() for _ in range(1500)]
    assert [coder._merge_long(p) for p in pieces] == coder.merge(pieces)


def test_long_piece_takes_its_length(encoding):
    import time

    coder = bpe.load(RANKS, P.PATTERN)
    text = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=300_000))
    begun = time.time()
    ids = coder.encode_batch([text])[0]
    assert time.time() - begun < 10 and coder.decode(ids).decode() == text


def test_long_merges_where_one_round_must_not_take_all_places():
    """A vocabulary with tokens whose pair ranks below them."""
    ranks = {bytes([b]): 1000 + b for b in range(256)}
    ranks |= {b"ab": 5, b"aba": 2, b"bab": 1, b"abab": 0, b"aa": 7, b"aaa": 3, b"ca": 9, b"cab": 4, b"bb": 6}
    coder = bpe.ByteBpe(ranks, P.PATTERN)
    rng = random.Random(6)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            best = min(((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    assert coder.one_by_one.any()
    for _ in range(400):
        piece = "".join(rng.choices("abc", k=rng.randint(1, 40))).encode()
        assert np.frombuffer(coder._merge_long(piece), dtype="<i4").tolist() == plain(piece) == np.frombuffer(coder.merge([piece])[0], dtype="<i4").tolist()


def test_other_patterns_split_whole_texts():
    ranks = bpe.load_ranks(RANKS)
    pattern = r"""[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.ByteBpe(ranks, pattern)
    for text in ("a.\n\nb c", "x =\n\n  y 12345 ...\n", "end!\r\n\r\n", ""):
        assert coder.encode_batch([text])[0].tolist() == own.encode_ordinary(text)
    assert bpe.CHUNKED == P.PATTERN


def test_runs_without_cut_points_equal_library(monkeypatch):
    import time

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    transducer = tokencount.load(PIECES)
    rng = random.Random(7)
    texts = [t for t in _alphabets(rng)] + ["a" * n for n in (511, 512, 513, 1024, 1025)] + ["the " + "e" * 5_000 + " end " + "n" * 3_000, "", "abc" * 3_000]
    want = [len(x) for x in library.encode(texts, num_threads=1)]
    assert transducer.counts(texts).tolist() == want
    begun = time.time()
    assert transducer.counts(["a" * 500_000])[0] == len(library.encode("a" * 500_000)) and time.time() - begun < 2
    # a table that is too small is widened, too few starting places are made up for
    monkeypatch.setattr(tokencount, "TABLE_BITS", 6)
    monkeypatch.setattr(tokencount, "WARM", (1,))
    small = tokencount.Transducer(PIECES)
    assert small.counts(texts).tolist() == want and small.bits > 6
    assert small.counts(texts[:3]).tolist() == want[:3]


def test_scan_resolves_runs_in_few_rounds(monkeypatch):
    """Chunks of a long run are told by the scan, not one after the other."""
    transducer = tokencount.load(PIECES)
    calls = []
    run = transducer._run
    monkeypatch.setattr(transducer, "_run", lambda *a: calls.append(len(a[1])) or run(*a))
    transducer.counts(["a" * 200_000])
    assert len(calls) < 20


def test_other_models_are_refused(monkeypatch):
    monkeypatch.setattr(tokencount.Transducer, "counts", lambda self, texts: np.zeros(len(texts), dtype=np.int64))
    tokencount.load.cache_clear()
    with pytest.raises(ValueError, match="no BPE model with identity"):
        tokencount.load(PIECES)
    tokencount.load.cache_clear()


def test_other_tokenizers_get_whole_texts():
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    coder = tokenfile.WordEncoder(path)
    texts = [*ODD, "Upper and lower", "a  b"]
    assert not coder.apart and tokenfile.load(WORDS).apart
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode_batch(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
