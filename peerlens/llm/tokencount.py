"""Token counts by a finite-state tokenizer with emitted-token counts on its transitions.

A BPE vocabulary whose merges are ranked by the merged piece has this property:
a sequence of pieces is the encoding of a text exactly if every two neighbours
are (that is, encoding the two pieces alone gives the two pieces back).  So the
last piece of the encoding of every prefix is decided by the last pieces of
shorter prefixes, and a deterministic transducer can count tokens while it
reads characters:

* a *state* holds, for every suffix of what was read that begins some longer
  piece, the place in the trie of pieces, the piece the encoding ended with
  before that suffix, and how many tokens fewer that encoding had;
* a *transition* carries the change of the number of tokens (it can be
  negative: a character may join pieces counted before).

After two characters that stand next to each other in no piece the state does
not depend on anything before them.  Texts are cut into chunks of a fixed
number of characters; all chunks step through the transducer together.  Behind
its first such *cut point* the state map of a chunk is a constant (one exit
state, one count); in front of it, it is the run over a short head.  A chunk
without a cut point has a proper map, from entry states to exit states and counts.  It is
taken for the states that the characters before the chunk lead to from some starting
places (``WARM``; what is far back hardly matters, so these hold the true one nearly always), all chunks at once; the
maps are composed by a parallel prefix scan, in rounds that double the number of chunks a map stands for.  A
chunk whose true entry state is not among them is run from it once it is known, which changes no count.  Then the heads run from
the exit state of the chunk before.  Transitions are compiled when first met; the table is emptied
when it is full, which changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peerlens.llm.common import text_slices

CHUNK = 512
#: Bytes of text stepped through together.
SLICE = 4_000_000
#: Entries of the transition table of one worker (16 bytes each); it is widened while a slice needs more.
TABLE_BITS = 22
#: Compiled states of one worker (some hundred bytes each); the table is emptied beyond.
MAX_STATES = 300_000
#: Starting places of a chunk without a cut point, at first and where these were too few; the characters from the nearest of them to the chunk.
WARM = (8, 64)
WARM_CHARS = 48
_MUL = np.uint64(0x9E3779B97F4A7C15)
SPACE = "▁"


class Transducer:
    """The counting transducer of a sentencepiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rank: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.rank[sp.id_to_piece(i)] = -round(sp.get_score(i))
        long_ = [p for p in self.rank if len(p) > 1]
        chars = sorted({c for p in long_ for c in p})
        if any(c not in self.rank for c in chars):
            raise ValueError("a piece holds a character that is no piece itself")
        if any(SPACE in p.lstrip(SPACE) for p in long_):
            raise ValueError("a piece goes on after a word ended")
        # Classes of characters: 0-3 stand alone and fall back to 1-4 bytes, 4 is a piece that
        # stands alone, then the characters that occur in longer pieces.
        self.class_of = np.zeros(0x110000, dtype=np.int16)
        for n, low in enumerate((0, 0x80, 0x800, 0x10000)):
            self.class_of[low:] = n
        for p in self.rank:
            if len(p) == 1:
                self.class_of[ord(p)] = 4
        for k, c in enumerate(chars):
            self.class_of[ord(c)] = 5 + k
        self.class_of[ord(" ")] = self.class_of[ord(SPACE)]
        self.space = int(self.class_of[ord(SPACE)])
        self.symbols = ["", "", "", "", "", *chars]
        self.n = len(self.symbols)
        self.joins = np.zeros((self.n, self.n), dtype=bool)
        at = {c: 5 + k for k, c in enumerate(chars)}
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[str | None] = [None]
        for p in long_ + chars:
            node = 0
            for a, b in zip(p, p[1:]):
                self.joins[at[a], at[b]] = True
            for c in p:
                if at[c] not in self.trie[node]:
                    self.trie[node][at[c]] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(None)
                node = self.trie[node][at[c]]
            self.ends[node] = p
        self.pair_ok: dict[tuple[str, str], bool] = {}
        self._empty()

    # -- compilation -------------------------------------------------------
    def _empty(self) -> None:
        self.bits, self.filled = TABLE_BITS, 0
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits, dtype=np.int64)
        self.states: list[tuple] = [((0, None, 0),)]
        self.last: list[int] = [-1]  # class of the character read last
        self.state_id = {(self.states[0], -1): 0}

    def _pieces(self, symbols: list[str]) -> list[str]:
        """Plain BPE over a few symbols: lowest rank first, leftmost on ties."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min((self.rank.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best[0] == 1 << 60:
                break
            symbols[best[1] : best[1] + 2] = [symbols[best[1]] + symbols[best[1] + 1]]
        return symbols

    def _neighbours(self, left: str | None, right: str) -> bool:
        if left is None:
            left = ""
        ok = self.pair_ok.get((left, right))
        if ok is None:
            if len(self.pair_ok) > 2_000_000:
                self.pair_ok.clear()
            ok = self._pieces([*left, *right]) == ([left, right] if left else [right])
            self.pair_ok[left, right] = ok
        return ok

    def _compile(self, state: int, c: int) -> tuple[int, int]:
        """The transition of a state on a class: (next state, change of the count)."""
        if c < 5:
            return self._intern(((0, None, 0),), c), max(1, c + 1 if c < 4 else 1)
        joins = self.last[state] >= 0 and self.joins[self.last[state], c]
        here, ends = [], []
        for node, piece, less in self.states[state]:
            if node == 0 and not joins:
                piece = None
            elif node and not joins:
                continue
            child = self.trie[node].get(c)
            if child is None:
                continue
            token = self.ends[child]
            if token is not None and self._neighbours(piece, token):
                ends.append((less + 1, token))
            if self.trie[child]:
                here.append((child, piece, less))
        if len(ends) != 1:
            raise AssertionError("the encoding of a prefix has one last piece")
        change, token = ends[0]
        after = tuple((node, piece, less - change) for node, piece, less in here) + ((0, token, 0),)
        return self._intern(after, c), change

    def _intern(self, entries: tuple, c: int) -> int:
        key = (entries, c)
        i = self.state_id.get(key)
        if i is None:
            i = self.state_id[key] = len(self.states)
            self.states.append(entries)
            self.last.append(c)
        return i

    def _widen(self) -> None:
        """Twice the table, for a slice of texts that needs so many transitions; the next slice begins with the usual one."""
        keys, values = self.keys, self.values
        self.bits += 1
        mask = (1 << self.bits) - 1
        self.keys, self.values = np.full(mask + 1, -1, dtype=np.int64), np.zeros(mask + 1, dtype=np.int64)
        todo = np.flatnonzero(keys >= 0)
        slot = ((keys[todo].astype(np.uint64) * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = self.keys[slot] == -1
            _, one = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[one]
            self.keys[slot[won]], self.values[slot[won]] = keys[todo[won]], values[todo[won]]
            left = np.setdiff1d(np.arange(len(todo)), won, assume_unique=True)
            todo, slot = todo[left], (slot[left] + 1) & mask

    # -- running -----------------------------------------------------------
    def _step(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lanes read one character."""
        key = state * self.n + c
        mask = (1 << self.bits) - 1
        slot = ((key.astype(np.uint64) * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64)
        at = self.keys[slot]
        value = self.values[slot]
        open_ = np.flatnonzero(at != key)
        while len(open_):
            slot_ = slot[open_]
            found = self.keys[slot_]
            fresh = found == -1
            if fresh.any():  # not compiled yet
                if self.filled > 1 << (self.bits - 1):
                    self._widen()
                    return self._step(state, c)
                for k in np.unique(key[open_[fresh]]).tolist():
                    after, change = self._compile(k // self.n, k % self.n)
                    s = int(((k * int(_MUL)) & ((1 << 64) - 1)) >> (64 - self.bits))
                    while self.keys[s] != -1:
                        s = (s + 1) & mask
                    self.keys[s], self.values[s] = k, (after << 8) | (change + 128)
                    self.filled += 1
                found = self.keys[slot_]
            hit = found == key[open_]
            value[open_[hit]] = self.values[slot_[hit]]
            slot[open_[~hit]] = (slot_[~hit] + 1) & mask
            open_ = open_[~hit]
        return value >> 8, (value & 255) - 128

    def _run(self, text: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lanes read ``text[begin : begin + length]`` from their states: (exit states, counts)."""
        state, count = state.copy(), np.zeros(len(begin), dtype=np.int64)
        order = np.argsort(-length, kind="stable")
        alive = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")
        s, n, b = state[order], count[order], begin[order]
        for k, m in enumerate(alive):
            s[:m], change = self._step(s[:m], text[b[:m] + k])
            n[:m] += change
        state[order], count[order] = s, n
        return state, count

    def _scan(
        self, text: np.ndarray, begin: np.ndarray, length: np.ndarray, start: np.ndarray, chunk: np.ndarray, starts: int,
        exit_: np.ndarray, count: np.ndarray, known: np.ndarray,
    ) -> None:
        """Exit states and counts of the chunks without a cut point (``chunk``), as far as their entry states can be told."""
        follows = ~known[chunk - 1]  # behind another such chunk
        # entry states: the true one for the first of a run, else what the characters before lead to
        first = np.flatnonzero(~follows)
        rows, state = [first], [exit_[chunk[first] - 1]]
        later = np.flatnonzero(follows)
        for k in range(starts if len(later) else 0):
            from_ = np.maximum(begin[chunk[later]] - WARM_CHARS - k, start[chunk[later]])
            rows.append(later)
            state.append(self._run(text, from_, begin[chunk[later]] - from_, np.zeros(len(later), dtype=np.int64))[0])
        code = np.unique(np.concatenate(rows) << 40 | np.concatenate(state))
        row, state = code >> 40, code & ((1 << 40) - 1)
        out, tokens = self._run(text, begin[chunk[row]], length[chunk[row]], state)
        # where a chunk's exit state is among the entry states of the chunk behind it
        low = np.searchsorted(row, np.arange(len(chunk) + 1))
        onward = np.minimum(row + 1, len(chunk) - 1)
        wanted = onward << 40 | out
        to = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        linked = (code[to] == wanted) & (row + 1 < len(chunk)) & follows[onward]
        to = np.where(linked, to, -1)
        # prefix scan: after k rounds ``to`` is the entry 2**k chunks on, ``reached`` holds the true entries of 2**k chunks of each run
        reached = np.zeros(len(code), dtype=bool)
        reached[low[first]] = True
        while (to >= 0).any():
            at = np.flatnonzero(reached & (to >= 0))
            reached[to[at]] = True
            to = np.where(to >= 0, to[to], -1)
        true = np.flatnonzero(reached)
        place = chunk[row[true]]
        exit_[place], known[place] = out[true], True
        count[place] += tokens[true]

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        if len(self.states) > MAX_STATES or self.filled > 1 << (TABLE_BITS - 2):
            self._empty()
        raw = [np.frombuffer((SPACE + t if t else "").encode("utf-32-le"), dtype="<u4") for t in texts]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        text = self.class_of[np.concatenate(raw)].astype(np.int64) if len(raw) else np.zeros(0, np.int64)
        if not len(text):
            return np.zeros(len(texts), dtype=np.int64)
        doc_start = np.cumsum(size) - size
        cut = np.ones(len(text), dtype=bool)  # characters read the same way from any state
        cut[1:] = ~self.joins[text[:-1], text[1:]]
        cut[doc_start[size > 0]] = True
        chunks = -(-size // CHUNK)
        owner = np.repeat(np.arange(len(texts)), chunks)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = doc_start[owner] + within * CHUNK
        length = np.minimum(CHUNK, doc_start[owner] + size[owner] - begin)
        # head: the characters in front of a chunk's first cut point
        next_cut = np.append(np.flatnonzero(cut), len(text))
        head = np.minimum(next_cut[np.searchsorted(next_cut, begin)] - begin, length)
        exit_, count = self._run(text, begin + head, length - head, np.zeros(len(begin), dtype=np.int64))
        known = head < length
        for starts in WARM:
            whole = np.flatnonzero(~known)
            if len(whole):
                self._scan(text, begin, length, doc_start[owner], whole, starts, exit_, count, known)
        todo = np.flatnonzero((head > 0) & ~(known & (head == length)))
        while len(todo):
            ready = todo[known[todo - 1]]
            out, more = self._run(text, begin[ready], head[ready], exit_[ready - 1])
            count[ready] += more
            whole = head[ready] == length[ready]
            exit_[ready[whole]] = out[whole]
            known[ready] = True
            todo = np.setdiff1d(todo, ready, assume_unique=True)
        return np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)


#: Texts that a model of another kind (normalising, without a leading space, splitting otherwise) counts differently.
_PROBES = ["a", " a", "a  b", "ﬁne ＡＢ é e\u0301", "tab\tand\nline", "Ünïcode 日本語 😀", "123 4567", "<s> </s>", "x" * 40, "\u00a0nbsp "]


@lru_cache(maxsize=2)
def load(model_file: str) -> Transducer:
    """The transducer of a model file; raises if the model counts some probes otherwise (another algorithm or normalisation)."""
    transducer = Transducer(model_file)
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    want = [len(ids) for ids in sp.encode(_PROBES, num_threads=1)]
    if transducer.counts(_PROBES).tolist() != want:
        raise ValueError(f"{model_file} is no BPE model with identity normalisation and a leading space")
    return transducer


def token_counts(
    docs: DataFrame, model_file: str, limit: int, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Counts what the sentencepiece model at ``model_file`` (a BPE model with
    identity normalisation that every executor can open) gives for the whole
    text, without begin or end tokens; strings that look like control tokens are
    ordinary text.  Null or empty text: 0 bytes, 0 tokens.  Repeated rows give
    repeated results; columns outside ``keep`` are not read.
    """
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = load(model_file)
        for part, texts in text_slices(batches, text_col, SLICE):
            n = transducer.counts(texts)
            size = np.array([len(t.encode()) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in keep] + [pa.array(size), pa.array(n), pa.array(n > limit)],
                names=schema.names,
            )

    return docs.select(*dict.fromkeys((*keep, text_col))).mapInArrow(run, schema)
