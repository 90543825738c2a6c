"""Benchmark decontamination: BM25 over test items, evaluated block by block with block-max WAND.

The inverted index of the test items goes to every worker; each passage of each training text is a query. Passages are
windows twice as long as the longest item, moved by half their length, so every item lies whole in one of them. Impacts
are divided by an item's score against itself, so one threshold holds for all items. Retrieved items are then verified:
the question and the answer must both overlap with the passage: short ones by their words in a stretch of it, long ones by
4-grams, so that a few changed words lose neither.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from lamella.llm.common import fresh, slices, staged
from lamella.llm.words import PUNCTUATION, WordHasher, mix64

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
#: Parts of at most so many words are compared by words; in a longer one three changed words spare half of the 4-grams.
SHORT = 26
#: Items of one block of the index, and of one index; more items make several indexes with the statistics of all items, each
#: asked by every passage.
BLOCK, ITEMS_AN_INDEX = 64, 20_000
_LEAKS = "array<struct<item_id:long,score:double,question:double,answer:double>>"


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: its last line, else its last sentence, else its last quarter is the answer."""
    text = text.strip()
    for mark in ("\n", ". ", "? ", "! "):
        head, found, tail = text.rpartition(mark)
        if found and head.strip() and tail.strip():
            return head + mark.strip(), tail
    words = text.split()
    cut = max(1, len(words) * 3 // 4)
    return " ".join(words[:cut]), " ".join(words[cut:]) or text


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-grams of word hashes; a shorter sequence is one gram."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix64(out + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(out)


def _words_share(want: np.ndarray, passage: np.ndarray, length: int) -> float:
    """The greatest share of the distinct words ``want`` in any stretch of ``passage`` of twice ``length`` words."""
    spot = np.minimum(np.searchsorted(want, passage), len(want) - 1)
    at = np.flatnonzero(want[spot] == passage)
    if not len(at):
        return 0.0
    word, hits = spot[at], np.zeros(len(at), np.int64)
    for w in np.unique(word):
        own = np.append(at[word == w], len(passage) + 2 * length)
        # the next stand of the word from each start on
        hits += own[np.searchsorted(own, at)] < at + 2 * length
    return float(hits.max() / len(want))


class Statistics(NamedTuple):
    """Of all items of a benchmark, for an index that holds a part of them: frequencies of the part's terms, in their order."""

    items: int
    mean_length: float
    longest: int
    frequency: np.ndarray


class Index:
    """Postings by term and block of items, with the greatest impact of a term in each block.

    Without ``whole`` the items are the whole benchmark.
    """

    def __init__(self, items: list[tuple[int, str]], whole: Statistics | None = None):
        hasher = WordHasher(PUNCTUATION)
        hashes, counts = hasher([t for _, t in items])
        ends = np.cumsum(counts)
        own = [hashes[e - c : e] for e, c in zip(ends, counts, strict=True)]
        self.ids = [i for i, _ in items]
        self.window = 2 * (whole.longest if whole else int(max(counts, default=1)))
        parts = [split_item(t or "") for _, t in items]
        # a short part of an item is verified by its distinct words, a long one by its 4-grams
        self.parts = [tuple((len(h), np.unique(h) if len(h) <= SHORT else _grams(h, 4)) for h in (hasher([p])[0] for p in qa)) for qa in parts]
        self.terms, at = np.unique(hashes, return_inverse=True)
        item = np.repeat(np.arange(len(items)), counts)
        pairs, tf = np.unique(at * max(1, len(items)) + item, return_counts=True)
        term, doc = pairs // max(1, len(items)), pairs % max(1, len(items))
        df = whole.frequency if whole else np.bincount(term, minlength=len(self.terms))
        idf = np.log(1 + ((whole.items if whole else len(items)) - df + 0.5) / (df + 0.5))
        length = counts / max(1.0, whole.mean_length if whole else counts.mean()) if len(items) else counts
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc]))
        impact = impact / np.bincount(doc, impact, len(items))[doc]
        # sorted by term, then item: a term's postings, and inside them its blocks, are slices
        self.item, self.impact = doc, impact
        self.begin = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.bound = np.zeros(len(self.terms))
        np.maximum.at(self.bound, term, impact)
        keys, first = np.unique(term * (len(items) // BLOCK + 1) + doc // BLOCK, return_index=True)
        self.block, self.block_bound = doc[first] // BLOCK, np.maximum.reduceat(impact, first) if len(first) else impact
        self.block_begin = np.searchsorted(keys // (len(items) // BLOCK + 1), np.arange(len(self.terms) + 1))

    @staticmethod
    def _gather(begin: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Positions of all entries of the given terms."""
        starts, sizes = begin[terms], begin[terms + 1] - begin[terms]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)

    def search(self, terms: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Items scoring at least ``threshold`` for the distinct ``terms`` of a passage, and their scores.

        Blocks whose summed block bounds stay below the threshold are skipped; so are terms that occur in none of the
        other blocks. What is left is scored in full, so no item above the threshold is lost.
        """
        at = self._gather(self.block_begin, terms)
        bounds = np.bincount(self.block[at], self.block_bound[at], len(self.ids) // BLOCK + 1)
        alive = bounds >= threshold - 1e-9
        if not alive.any():
            return np.empty(0, np.int64), np.empty(0)
        at = self._gather(self.begin, terms)
        at = at[alive[self.item[at] // BLOCK]]
        scores = np.bincount(self.item[at], self.impact[at], len(self.ids))
        hits = np.flatnonzero(scores >= threshold - 1e-9)
        return hits, scores[hits]


def _scan(texts: list, index: Index, hasher: WordHasher, threshold: float, overlap: float) -> list[list[tuple]]:
    """For each text its verified leaks (item, score, question share, answer share), best passage each."""
    found: list[dict[int, tuple]] = [{} for _ in texts]
    hashes, counts = hasher(texts)
    if not len(hashes) or not len(index.terms):
        return [[] for _ in texts]
    half = max(1, index.window // 2)
    spot = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = index.terms[spot] == hashes
    # global position of each half window, of which a text has at least one
    text_of = np.repeat(np.arange(len(texts)), counts)
    begins = np.cumsum(counts) - counts
    place = np.arange(len(hashes)) - begins[text_of]
    halves = np.maximum(1, -(-counts // half))
    half_of = (np.cumsum(halves) - halves)[text_of] + place // half
    term, half_of, text_of_known = spot[known], half_of[known], text_of[known]
    # a term's first stand in each half; a passage is two halves, whose sum bounds it (a common term counts twice)
    keys = np.unique(half_of * len(index.terms) + term)
    half_key, term_key = keys // len(index.terms), keys % len(index.terms)
    total = int(halves.sum())
    sums = np.bincount(half_key, index.bound[term_key], total + 1)
    last = np.zeros(total, bool)
    last[np.cumsum(halves) - 1] = True
    pair = sums[:-1] + np.where(last, 0, sums[1:])
    owner = np.repeat(np.arange(len(texts)), halves)
    edges = np.searchsorted(half_key, np.arange(total + 2))
    for h in np.flatnonzero(pair >= threshold - 1e-9):
        terms = np.unique(term_key[edges[h] : edges[h + (1 if last[h] else 2)]])
        if index.bound[terms].sum() < threshold - 1e-9:
            continue
        items, scores = index.search(terms, threshold)
        if not len(items):
            continue
        t = owner[h]
        start = begins[t] + (h - (np.cumsum(halves) - halves)[t]) * half
        passage = hashes[start : min(start + 2 * half, begins[t] + counts[t])]
        grams = None
        for item, score in zip(items.tolist(), scores.tolist(), strict=True):
            shares = []
            for length, want in index.parts[item]:
                if length <= SHORT:
                    shares.append(_words_share(want, passage, length) if len(want) else 1.0)
                    continue
                if grams is None:
                    grams = _grams(passage, 4)
                shares.append(float(np.isin(want, grams).mean()))
            if min(shares) >= overlap and (item not in found[t] or found[t][item][1] < score):
                found[t][item] = (index.ids[item], score, *shares)
    return [[own[i] for i in sorted(own)] for own in found]


def _searcher(index: Index, threshold: float, overlap: float):

    @F.pandas_udf(_LEAKS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = WordHasher(PUNCTUATION)
        for texts in batches:
            out: list[list[dict]] = []
            every = texts.tolist()
            for a, b in slices(every):
                for leaks in _scan(every[a:b], index, hasher, threshold, overlap):
                    out.append([dict(zip(("item_id", "score", "question", "answer"), x, strict=True)) for x in leaks])
            yield pd.Series(out)

    return search


@F.pandas_udf(ArrayType(LongType()))
def _hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The word hashes of each text, as the index makes them."""
    hasher = WordHasher(PUNCTUATION)
    for texts in batches:
        hashes, counts = hasher(texts.tolist())
        yield pd.Series(np.split(hashes.view(np.int64), np.cumsum(counts)[:-1])) if len(texts) else pd.Series([], dtype=object)


def _indexes(items: DataFrame, parts: int) -> Iterator[Index]:
    """One index a part. Frequencies and lengths are counted by Spark over all items; a part's own share comes back."""
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    words = staged(items.select("item_id", "text", part.alias("part"), _hashed("text").alias("words")), "benchmark-words")
    total, mean, longest = words.select(F.count(F.lit(1)), F.avg(F.size("words")), F.max(F.size("words"))).first()
    terms = words.select("part", F.explode(F.array_distinct("words")).alias("term"))
    counted = staged(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.collect_set("part").alias("parts")), "benchmark-terms")
    for p in range(parts):
        own = sorted((r.item_id, r.text) for r in words.where(F.col("part") == p).select("item_id", "text").collect())
        table = counted.where(F.array_contains("parts", F.lit(p).cast("long"))).select("term", "df").toPandas()
        order = np.argsort(table["term"].to_numpy(np.int64).view(np.uint64))
        yield Index(own, Statistics(total, mean, longest, table["df"].to_numpy(np.int64)[order]))


def _searchers(benchmark: DataFrame, threshold: float, overlap: float) -> list:
    """One search function for each ITEMS_AN_INDEX items. Items without text or id are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND trim(text) <> ''").distinct()
    parts = max(1, -(-items.count() // ITEMS_AN_INDEX))
    if parts == 1:
        return [_searcher(Index(sorted((r.item_id, r.text) for r in items.collect())), threshold, overlap)]
    return [_searcher(index, threshold, overlap) for index in _indexes(items, parts)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
               threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): every item found in a row of ``docs``, best passage.

    Null and empty texts hold nothing; a repeated row repeats its findings; an empty benchmark or table gives no rows;
    other columns are not looked at. Case, blanks and ASCII punctuation make no difference.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = [slim.select("doc_id", F.explode(s(F.col("text"))).alias("leak")) for s in _searchers(benchmark, threshold, overlap)]
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    return every.select("doc_id", "leak.item_id", "leak.score", F.col("leak.question").alias("question_overlap"), F.col("leak.answer").alias("answer_overlap"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Rows of ``docs`` in which no test item is found, with the columns of ``docs``."""
    leaks = fresh(docs, "_leaks")
    for search in _searchers(benchmark, threshold, overlap):
        docs = docs.withColumn(leaks, F.size(search(F.col(text)))).where(F.col(leaks) == 0).drop(leaks)
    return docs
