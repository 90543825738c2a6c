"""Toxicity with counterfactual regularisation.

A logistic model over words and word beginnings. For labelled texts that mention a group of people, a second version
swaps the mention for another group of the same sort, and training penalises a change of the score, so mentions alone
do not make a text toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import fresh, id_fold, labelled_sample

THRESHOLD = 0.7
#: Labelled texts that the model is fitted on, at most; those of smallest id hash.
FIT_TEXTS = 4000
#: Features that the model looks at, at most; those that tell most about the label.
FEATURES = 6000
#: Terms of one line replace each other.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("boys", "girls"), ("he", "she"),
    ("immigrants", "refugees", "foreigners", "natives"), ("blind", "deaf", "disabled"),
)
_EDGES = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum()) + "«»“”„¿¡…"


def _features_of(word: str) -> list[str]:
    """The word, and its beginnings of three to eight letters marked as such."""
    return [word, *(word[:n] + "*" for n in range(3, min(8, len(word)) + 1))]


def _distinct_words(text: str | None) -> set[str]:
    return {w.strip(_EDGES) for w in set((text or "").lower().split())} - {""}


def _swapped(words: set[str], groups: tuple[tuple[str, ...], ...]) -> set[str] | None:
    """The words with every identity term replaced by the next of its line; None if there is none."""
    follow = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return {follow.get(w, w) for w in words} if any(w in follow for w in words) else None


def _train(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], features: int,
           penalty: float, ridge: float = 0.02, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept: log loss + ridge + ``penalty`` times the mean squared change of the score between pairs."""
    flat = lambda lists: (np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
    (ids, at), (left, left_at), (right, right_at) = flat(rows), flat([a for a, _ in pairs]), flat([b for _, b in pairs])
    n, m = max(1, len(y)), max(1, len(pairs))
    w, b = np.zeros(features), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    first, second, t = np.zeros(features + 1), np.zeros(features + 1), 0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, w[ids], len(y)) + b, -30, 30)))
        g = np.bincount(ids, (p - y)[at], features) / n + ridge * w / n
        if pairs:
            change = np.bincount(left_at, w[left], m) - np.bincount(right_at, w[right], m)
            g = g + 2 * penalty / m * (np.bincount(left, change[left_at], features) - np.bincount(right, change[right_at], features))
        g = np.append(g, (p - y).sum() / n)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g  # Adam
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, text: str = "text", doc_id: str = "doc_id",
        label: str = "toxic", groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = 5.0) -> dict:
    """A model from rows of ``labels`` for which ``keep`` holds; null labels and texts do not count.

    Features are chosen by how surely they stand more often in toxic texts (log odds over their error), and identity
    terms always belong to them, so the penalty can reach them. Without labelled texts every score is 0.5.
    """
    sample = labelled_sample(docs, labels, label, FIT_TEXTS, keep, text, doc_id)
    y = np.array([r.label for r in sample], float)
    words = [_distinct_words(r.text) for r in sample]
    toxic, other = Counter(), Counter()
    for own in (w for w, is_toxic in zip(words, y, strict=True) if is_toxic):
        toxic.update({f for w in own for f in _features_of(w)})
    toxic = Counter({f: n for f, n in toxic.items() if n >= 3})  # only these are counted in the other texts
    for own in (w for w, is_toxic in zip(words, y, strict=True) if not is_toxic):
        other.update({f for w in own for f in _features_of(w) if f in toxic})
    n_toxic, n_other = y.sum(), len(y) - y.sum()

    def sureness(f: str) -> float:
        a, b = toxic[f] + 0.5, other[f] + 0.5
        return (np.log(a / (n_toxic - a + 1)) - np.log(b / (n_other - b + 1))) / np.sqrt(1 / a + 1 / b)

    told = sorted(((-sureness(f), f) for f in toxic))
    index: dict[str, int] = {}
    for f in [f for z, f in told if z <= -3.0][:FEATURES] + [t for g in groups for t in g]:
        index.setdefault(f, len(index))
    encode = lambda own: np.unique([index[f] for w in own for f in _features_of(w) if f in index]).astype(np.int64)
    rows = [encode(own) for own in words]
    swaps = [(r, encode(s)) for r, own in zip(rows, words, strict=True) if (s := _swapped(own, groups)) is not None]
    w, b = _train(rows, y, swaps, len(index), penalty)
    return {"weights": {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, "intercept": b}


def scorer(model: dict):
    """A column function of a text: the probability that it is toxic. A null or empty text gets the base value."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, known = model["weights"], {}
        for texts in batches:
            out = []
            for t in texts:
                found = set()
                for token in set((t or "").lower().split()):
                    own = known.get(token)
                    if own is None:
                        if len(known) > 200_000:
                            known.clear()
                        word = token.strip(_EDGES)
                        own = known[token] = tuple(f for f in _features_of(word) if f in weights) if word else ()
                    if own:
                        found.update(own)
                out.append(model["intercept"] + sum(weights[f] for f in sorted(found)))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -500, 500))))

    return score


def remove_toxic(docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with the columns of ``docs``. Rows of equal text go the same way."""
    score = fresh(docs, "_toxicity")
    return docs.withColumn(score, scorer(model)(F.col(text))).where(F.col(score) < threshold).drop(score)


def held_out(doc_id: str = "doc_id") -> Column:
    return id_fold(doc_id, 3) == 1
