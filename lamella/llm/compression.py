"""Quality by compression: which dictionary, of good or of bad texts, makes a text shorter.

Two zstandard dictionaries are built from labelled texts. A text is compressed with either, in pieces so that all of it
profits from the dictionary. The difference of the sizes over their sum, and how far the text shrinks at all (text that
repeats itself shrinks with any dictionary), are turned into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import id_fold, labelled_sample

#: Labelled texts that the model is fitted on, at most; those of smallest id hash.
FIT_TEXTS = 4000
#: Characters of a text that one training sample holds; longer texts give several samples.
PIECE = 1000
DICTIONARY_BYTES = 64 * 1024


def _pieces(text: str | None) -> list[bytes]:
    text = text or ""
    return [text[i : i + PIECE].encode("utf-8", "surrogatepass") for i in range(0, len(text), PIECE)]


def _compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    made = []
    for raw in dictionaries:
        data = zstandard.ZstdCompressionDict(raw)
        data.precompute_compress(level=3)
        made.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def _measures(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> list[float]:
    """[size difference, logarithm of the shrinkage, its square, 1]; zeros but for the last for an empty or null text.

    The difference goes from -10 (the bad dictionary fits) to 10 (the good one).
    """
    g = b = raw = 0
    for piece in _pieces(text):
        g += len(good.compress(piece))
        b += len(bad.compress(piece))
        raw += len(piece)
    if not raw:
        return [0.0, 0.0, 0.0, 1.0]
    shrunk = float(np.log((g + b) / (2 * raw)))
    return [10 * (b - g) / (b + g), shrunk, shrunk * shrunk, 1.0]


def _calibrate(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Weights of a logistic model (Newton's method, weak pull to zero)."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(len(w)), x.T @ (p - y) + 1e-1 * w)
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> dict:
    """A model from rows of ``labels`` for which ``keep`` holds. Null labels and texts do not count.

    Two thirds of the sample make the dictionaries, the rest the calibration, so the model sees sizes of texts that the
    dictionaries do not contain. With no text of one label the score is the share of label 1 for every text.
    """
    sample = labelled_sample(docs, labels, label, FIT_TEXTS, keep, text, doc_id)
    texts, y = [r.text for r in sample], np.array([r.label for r in sample], float)
    share = float((y.sum() + 1) / (len(y) + 2))
    build = [i for i in range(len(y)) if i % 3]
    sides = [[p for i in build if y[i] == side for p in _pieces(texts[i])] for side in (1, 0)]
    if min(map(len, sides)) < 20:
        return {"dictionaries": None, "weights": [0.0, 0.0, 0.0, float(np.log(share / (1 - share)))]}
    # equally many bytes on either side, or the larger class would get the better dictionary
    room = min(sum(map(len, s)) for s in sides)
    made = []
    for side in sides:
        order = np.random.default_rng(7).permutation(len(side))
        sizes = np.cumsum([len(side[i]) for i in order])
        made.append(zstandard.train_dictionary(DICTIONARY_BYTES, [side[i] for i in order[: max(20, int(np.searchsorted(sizes, room)))]]).as_bytes())
    pair = _compressors((made[0], made[1]))
    rest = [i for i in range(len(y)) if i % 3 == 0]
    return {"dictionaries": (made[0], made[1]), "weights": _calibrate(np.array([_measures(texts[i], *pair) for i in rest]), y[rest])}


def scorer(model: dict):
    """A column function of a text: the probability of label 1. Whole texts; empty and null ones get the base value."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = _compressors(model["dictionaries"]) if model["dictionaries"] else None
        for texts in batches:
            x = np.array([_measures(t, *pair) if pair else [0.0, 0.0, 0.0, 1.0] for t in texts]).reshape(-1, 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(model["weights"]), -500, 500))))

    return score


def held_out(doc_id: str = "doc_id") -> Column:
    return id_fold(doc_id, 5) == 0
