"""Toxicity: a counterfactual-regularised logistic classifier over hashed words and word beginnings.

Features of a text: the presence of its words (lower case, without ASCII punctuation) and of their
first 4, 5 and 6 bytes, hashed to 2^20 numbers.  A feature is used if it is in at least ``min_texts`` training texts and
clearly more frequent in one class; it is scaled by its log odds ratio.

Counterfactuals.  In the labelled training sentences each identity term (:data:`IDENTITY_TERMS`) is swapped for the
next one of its kind; a text without any gets, in one of its sentences, a
term put in front.  The loss is the logistic loss plus ``penalty`` times the squared change of the score (its logit) between a
sentence and its counterfactual, so that the naming of a group does not make a text toxic; a feature of an identity
term is always used, as only then its weight is learned to be small.

The classifier is fitted on the driver on a bounded sample of labelled rows (``sample``, at most that many texts, taken
by a hash of the id); every row is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerlens.llm.common import SLICE_CHARS, bounded_sample, give_back, text_slices
from peerlens.llm.wordhash import word_hashes

#: Terms that name groups of people, by kind: within a kind one stands for another.
IDENTITY_TERMS: dict[str, list[str]] = {
    "gender": ["women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"],
    "faith": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "christen", "muslime", "juden", "chrétiens", "musulmans", "juifs", "cristianos", "musulmanes", "judíos"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "transgender", "schwule", "lesben", "homosexuels", "homosexuales"],
    "origin": ["black", "white", "asian", "latino", "african", "european", "arab", "immigrants", "refugees", "einwanderer", "flüchtlinge", "immigrés", "réfugiés", "inmigrantes", "refugiados"],
    "age and health": ["elderly", "young", "disabled", "deaf", "blind", "autistic", "alte", "behinderte", "vieux", "handicapés", "ancianos", "discapacitados"],
}

BITS = 20
SAMPLE = 12_000
PREFIXES = (4, 5, 6)
_SWAP = {t: kind[(k + 1) % len(kind)] for kind in IDENTITY_TERMS.values() for k, t in enumerate(kind)}
_TERM = re.compile(r"\b(" + "|".join(map(re.escape, _SWAP)) + r")\b", re.IGNORECASE)
#: Letters that an ASCII letter matches when case is ignored, and that one.
_PLAIN = str.maketrans({"ſ": "s", "İ": "i", "ı": "i", "\u212a": "k"})
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(owner, feature number) of the words and word beginnings of texts, with repeats."""
    owner, words, starts = word_hashes(texts, PREFIXES, letters_only=True)
    shift = np.uint64(64 - BITS)
    parts = [(owner, words)] + [(owner[h != 0], h[h != 0]) for h in starts]
    return np.concatenate([o for o, _ in parts]), np.concatenate([(h >> shift).astype(np.int32) for _, h in parts])


def swapped(term: str) -> str:
    """What stands for an identity term as a text spells it; letters that only match regardless of case are told by their plain ones."""
    return _SWAP.get(term.translate(_PLAIN).lower(), term)


def counterfactual(text: str) -> tuple[str, str] | None:
    """A sentence of the text and its counterfactual: all sentences with identity terms, swapped; else one term put in front of a sentence."""
    sentences = _SENTENCE.findall(text)
    named = [s for s in sentences if _TERM.search(s)]
    if named:
        before = ". ".join(named)
        return before, _TERM.sub(lambda m: swapped(m[1]), before)
    if not sentences:
        return None
    terms = list(_SWAP)
    return sentences[0], terms[len(text) % len(terms)] + " " + sentences[0]


@dataclass
class Model:
    """Weights by feature number, and the bias."""

    weights: np.ndarray
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        owner, feature = features(texts)
        used = self.weights[feature] != 0
        once = np.unique((owner[used] << BITS) | feature[used])
        return self.bias + np.bincount(once >> BITS, weights=self.weights[once & ((1 << BITS) - 1)], minlength=len(texts))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Between 0 and 1, higher: toxic likelier."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -50, 50)))


def _unique_rows(texts: list[str]) -> list[np.ndarray]:
    owner, feature = features(texts)
    once = np.unique((owner << BITS) | feature)
    cut = np.searchsorted(once >> BITS, np.arange(1, len(texts)))
    return np.split((once & ((1 << BITS) - 1)).astype(np.int32), cut)


def fit(
    rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
    penalty: float = 1.0, min_texts: int = 3, l2: float = 1e-4, rounds: int = 150,
) -> Model:
    """Fit on texts (feature numbers, each once) and counterfactual pairs of feature numbers.

    Without texts every score is 0.
    """
    size = 1 << BITS
    if not len(rows):
        return Model(np.zeros(size), -50.0)
    y = labels.astype(np.float64)
    flat, length = np.concatenate(rows), np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), length)
    of1 = np.bincount(flat, weights=y[owner], minlength=size)
    of0 = np.bincount(flat, minlength=size) - of1
    n1, n0 = y.sum(), len(y) - y.sum()
    ratio = np.log((of1 + 0.5) / (n1 + 1)) - np.log((of0 + 0.5) / (n0 + 1))
    ratio[(of1 + of0 < min_texts) | (np.abs(ratio) < 1)] = 0
    # per counterfactual pair: features that appear (+1) or vanish (-1)
    change = [(np.setdiff1d(b, a), np.setdiff1d(a, b)) for a, b in pairs]
    moved = [np.concatenate(c) for c in change]
    sign = [np.concatenate([np.ones(len(p)), -np.ones(len(m))]) for p, m in change]
    pair = np.repeat(np.arange(len(moved)), [len(m) for m in moved])
    moved = np.concatenate(moved).astype(np.int64) if len(moved) else np.zeros(0, np.int64)
    sign = np.concatenate(sign) if len(sign) else np.zeros(0)
    named = np.unique(moved)
    ratio[named] = np.where(ratio[named] == 0, np.where(of1[named] + of0[named] >= min_texts, 1e-3, 0), ratio[named])
    used = np.flatnonzero(ratio)
    column = np.full(size, -1)
    column[used] = np.arange(len(used))
    hit = column[flat] >= 0
    r, c = owner[hit], column[flat[hit]]
    v = ratio[used][c]
    ok = column[moved] >= 0
    pr, pc = pair[ok], column[moved[ok]]
    pv = sign[ok] * ratio[used][pc]
    # both classes weigh the same: the score is a probability at even odds
    mass = np.where(y > 0, 0.5 / max(n1, 1.0), 0.5 / max(n0, 1.0))
    w, bias = np.zeros(len(used)), 0.0 if n1 else -5.0
    # Nesterov steps with a step length that shrinks when the loss rises
    step, w_last, bias_last, momentum, last_loss = 0.5, w.copy(), bias, 0.0, np.inf
    for k in range(rounds):
        momentum = k / (k + 3.0)
        wm, bm = w + momentum * (w - w_last), bias + momentum * (bias - bias_last)
        z = bm + np.bincount(r, weights=v * wm[c], minlength=len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        d = np.bincount(pr, weights=pv * wm[pc], minlength=max(1, len(pairs)))
        loss = float(mass @ (np.logaddexp(0, z) - y * z) + penalty * np.mean(d * d) + l2 * (wm @ wm))
        if loss > last_loss * 1.05:
            step, w_last, bias_last = step / 2, w.copy(), bias
        last_loss = min(loss, last_loss)
        g = (p - y) * mass
        grad = np.bincount(c, weights=v * g[r], minlength=len(used)) + 2 * l2 * wm
        if len(pc):
            grad += 2 * penalty / len(pairs) * np.bincount(pc, weights=pv * d[pr], minlength=len(used))
        w_last, bias_last = w, bias
        w, bias = wm - step * grad, bm - step * float(g.sum())
    weights = np.zeros(size)
    weights[used] = w * ratio[used]
    return Model(weights, bias)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE, **settings,
) -> Model:
    """Fit a :class:`Model` on the labelled rows of ``docs``.

    ``labels``: ``id_col``, ``label_col`` (0 or 1; null counts as unlabelled; of several labels of an id the
    largest holds).  At most ``sample`` ids, the smallest by a hash of the id, are learned from, each with two of its rows at most.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = bounded_sample(known.groupBy(id_col).agg(F.max(label_col).alias("_label")), id_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text"):
            pairs = [counterfactual(t) or ("", "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("_label")).cast(pa.int32())]
                + [pa.array(_unique_rows(list(x)), pa.list_(pa.int32())) for x in (texts, [a for a, _ in pairs], [b for _, b in pairs])]
                + [part.column(part.schema.get_field_index("_order"))],
                names=["label", "features", "before", "after", "order"],
            )

    learned = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(chosen), id_col)
    learned = learned.withColumn("_order", F.xxhash64(id_col, F.coalesce("_text", F.lit(""))))
    # of an id that is repeated two rows, the first by that hash: the same in every run
    place = F.row_number().over(Window.partitionBy(id_col).orderBy("_order"))
    learned = learned.withColumn("_place", place).where(F.col("_place") <= 2).select("_label", "_text", "_order")
    # Bounded by ``sample``: this is the only thing that goes to the driver.
    kind = "label int, features array<int>, before array<int>, after array<int>, order bigint"
    table = learned.mapInArrow(run, kind).toArrow().sort_by("order")

    def lists(name: str) -> list[np.ndarray]:
        out = []
        for chunk in table.column(name).chunks:
            out += np.split(chunk.flatten().to_numpy(), chunk.offsets.to_numpy()[1:-1] - chunk.offsets[0].as_py()) if len(chunk) else []
        return out

    pairs = list(zip(lists("before"), lists("after")))
    return fit(lists("features"), (table.column("label").to_numpy() > 0), pairs, **settings)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the model's score of the whole text (null texts as empty ones).

    Other columns pass unchanged; one already named ``score_col`` is replaced.
    """
    used = np.flatnonzero(model.weights)
    small = docs.sparkSession.sparkContext.broadcast((used, model.weights[used], model.bias))
    held: list[Model] = []

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        if not held:
            at, values, bias = small.value
            weights = np.zeros(1 << BITS)
            weights[at] = values
            held.append(Model(weights, bias))
        column = [t or "" for t in texts]
        parts, start, size = [], 0, 0
        for k, t in enumerate(column):
            if k > start and size + len(t) > SLICE_CHARS:
                parts.append(held[0].scores(column[start:k]))
                start, size = k, 0
            size += len(t)
        if start < len(column):
            parts.append(held[0].scores(column[start:]))
        del column
        give_back()
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(score_col, score(F.col(text_col)))
