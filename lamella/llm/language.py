"""Language identification by rank-order profiles.

The most frequent n-grams of a text are compared with those of each language: the out-of-place distance adds up how far
each n-gram stands from its place in the profile. N-grams have one to three characters of lower-cased words with a blank
before and after each word; everything but letters separates words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import id_fold

#: Places in a profile, of a language and of a text.
PLACES = 400
#: Texts from which a language's profile is made, at most; those of smallest hash are taken.
TEXTS_A_LANGUAGE = 1500
UNKNOWN = "und"


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters than letters one blank; blank at both ends."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.unique(points)
    letters = np.array([chr(p).isalpha() for p in kinds.tolist()])
    is_letter = letters[np.searchsorted(kinds, points)]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one separator after each word
    keep[0] = True
    return np.where(is_letter, points, 32)[keep].astype(np.int64)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams as numbers (21 bits a character) and their counts; empty if the text has no letters."""
    c = _codes(text)
    if len(c) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = c[:-1] << 21 | c[1:]
    triples = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
    inner = c[1:-1] != 32  # no n-gram reaches over a blank
    return np.unique(np.concatenate([c[c != 32], pairs, triples[inner[: len(triples)]]]), return_counts=True)


def _ranked(grams: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """The most frequent n-grams, best first; ties by n-gram, so repeated runs agree."""
    return grams[np.lexsort((grams, -counts))[:places]]


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", keep: Column | None = None) -> dict[str, list[int]]:
    """Profiles (n-grams, most frequent first) of each language of ``docs``, from rows where ``keep`` holds.

    Rows without language or text are not used. Of a language with more than TEXTS_A_LANGUAGE texts those of smallest
    id hash are taken; n-grams are counted in Python workers, and what comes to the driver is a profile a language.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows if keep is None else rows.where(keep)
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id)).alias("h"))
    # how many there are tells below which hash about the wanted number lies; only then are texts read
    n = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    span = 2.0**64
    below = F.lit(None).cast("double")
    for name, count in n.items():
        below = F.when(F.col("lang") == name, F.lit(span * min(1.0, TEXTS_A_LANGUAGE / count) - span / 2)).otherwise(below)
    sample = rows.where(F.col("h").cast("double") <= below).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, own in batch.groupby("lang"):
                grams, counts = [], []
                for t in own["text"]:
                    g, c = ngrams(t)
                    grams.append(g)
                    counts.append(c)
                g, at = np.unique(np.concatenate(grams), return_inverse=True)
                yield pd.DataFrame({"lang": name, "gram": g, "n": np.bincount(at, np.concatenate(counts), len(g)).astype(np.int64)})

    counted = sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PLACES)
    profiles: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "place").collect():
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


def predictor(profiles: dict[str, list[int]]):
    """A column function of a text: struct(lang_pred, score).

    The language of least out-of-place distance, where an n-gram that a profile lacks is PLACES away; the first by name
    in a tie. The score is 0.5 for a tie with the next language and goes to 1 as that one falls behind. A null text, a
    text without letters, or no profile at all: ``und`` with score 0.
    """
    names = sorted(profiles)
    tables = []
    for name in names:
        grams = np.array(profiles[name], np.int64)
        order = np.argsort(grams)
        tables.append((grams[order], order))

    def one(text: str | None) -> tuple[str, float]:
        grams, counts = ngrams(text) if text else ((), ())
        if not len(grams) or not names:
            return UNKNOWN, 0.0
        own = _ranked(grams, counts, PLACES)
        places, distances = np.arange(len(own)), []
        for known, rank in tables:
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            distances.append(np.where(known[at] == own, np.abs(rank[at] - places), PLACES).sum() / (PLACES * len(own)))
        first, *others = sorted(range(len(names)), key=lambda i: (distances[i], i))
        gap = distances[others[0]] - distances[first] if others else 1.0
        return names[first], float(1 / (1 + np.exp(-20 * gap)))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``; repeated rows are each returned, other columns are not read."""
    return docs.select(F.col(doc_id).alias("doc_id"), predictor(profiles)(F.col(text)).alias("p")).select("doc_id", "p.*")


def held_out(doc_id: str = "doc_id") -> Column:
    return id_fold(doc_id, 4) == 2
