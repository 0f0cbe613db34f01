"""Hashes of the words of many texts at once, in numpy.

A word is a run of non-white-space characters of the lower-cased text.  The
hash of a word depends on its bytes alone, so it is the same in every task and
for a text of any length.  Words of a very long text are hashed block by block.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, b, dtype=np.uint64) for b in (_BASE, _INVERSE))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def normal_words(text: str) -> list[str]:
    """The words of a text: lower case, split at white space."""
    return text.lower().split()


def _blocks(texts: list[str]):
    """(owners, joined words) pieces of at most about _BLOCK bytes; a longer text gives several."""
    owners, lines, held = [], [], 0
    for i, t in enumerate(texts):
        words = normal_words(t)
        step = 50_000
        for k in range(0, len(words), step):
            line = " ".join(words[k : k + step])
            if held and held + len(line) > _BLOCK:
                yield owners, lines
                owners, lines, held = [], [], 0
            owners.append(i)
            lines.append(line)
            held += len(line) + 1
    if lines:
        yield owners, lines


@lru_cache(maxsize=1)
def _punctuation() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
    return table


def word_hashes(
    texts: list[str], prefixes: tuple[int, ...] = (), letters_only: bool = False
) -> tuple[np.ndarray, np.ndarray, list]:
    """(owner, hash, prefix hashes) for every word of ``texts`` in order.

    ``letters_only`` takes ASCII punctuation out first (words of nothing else vanish).

    ``owner`` is the index of the text.  For each length in ``prefixes`` there
    is one more array: the hash of the first so many bytes of a longer word, 0 for
    words no longer than that.
    """
    owner_parts, hash_parts, prefix_parts = [], [], [[] for _ in prefixes]
    table = _bytes_table()
    for owners, lines in _blocks(texts):
        raw = np.frombuffer(("\n".join(lines) + "\n").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if letters_only:
            raw = raw[~_punctuation()[raw]]
        size = 1 << (len(raw) + 1).bit_length()
        up, down = _powers(size)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(table[raw] * up[: len(raw)], out=total[1:])
        stop = np.flatnonzero((raw == 32) | (raw == 10))
        start = np.empty_like(stop)
        start[0], start[1:] = 0, stop[:-1] + 1
        line_of = np.cumsum(raw[stop] == 10) - (raw[stop] == 10)
        full = stop > start
        start, stop, line_of = start[full], stop[full], line_of[full]
        owner_parts.append(np.asarray(owners, dtype=np.int64)[line_of])
        hash_parts.append(mix((total[stop] - total[start]) * down[start]))
        for part, n in zip(prefix_parts, prefixes):
            end = np.minimum(start + n, stop)
            h = mix((total[end] - total[start]) * down[start] + np.uint64(n))
            part.append(np.where(stop - start > n, h, np.uint64(0)))
    if not hash_parts:
        none = np.zeros(0, dtype=np.uint64)
        return np.zeros(0, dtype=np.int64), none, [none for _ in prefixes]
    return np.concatenate(owner_parts), np.concatenate(hash_parts), [np.concatenate(p) for p in prefix_parts]


def shingle_hashes(owner: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of every run of ``n`` words of one text; a text of 1 to n-1 words gives one run of all its words."""
    if not len(words):
        return owner, words
    out = words.copy()
    length = len(words)
    for k in range(1, n):
        cut = max(0, length - k)
        out[:cut] = out[:cut] * np.uint64(_BASE) + words[k:]
        out[cut:] = out[cut:] * np.uint64(_BASE)
    same = np.zeros(length, dtype=bool)
    if length >= n:
        same[: length - n + 1] = owner[n - 1 :] == owner[: length - n + 1]
    # texts shorter than a run: chain the words they have
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    count = np.diff(np.r_[first, length])
    for s, c in zip(first[count < n], count[count < n]):
        h = words[s]
        for k in range(1, n):
            h = np.multiply(h, np.uint64(_BASE), dtype=np.uint64) + (words[s + k] if k < c else np.uint64(c))
        out[s], same[s] = h, True
    return owner[same], mix(out[same])
