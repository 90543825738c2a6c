"""Exact n-gram Jaccard join by vertical partitioning, and the groups that its links form.

The global order of n-grams (by hash) is cut into fragments. Sets that link differ in a bounded number of n-grams, so
with more fragments than that at least one fragment is the same on both sides: texts are compared if they agree in a
whole fragment. Fragments that hold nothing but n-grams of many texts are not looked up, unless a set has so many of
them that it might share no others; and a text must agree with others in as many fragments as any link brings about. So
passages that texts share do not make candidates. Candidate groups are then compared in blocks, large ones only with
blocks of sets of similar size: overlaps are counted in each fragment of their common n-grams and summed per pair. Sets that are equal count as one class all
along, and a block returns a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import components, discard, slices, staged
from lamella.llm.words import BLANKS, WordHasher, mix64

#: Frequent n-grams that one task reports, and that are known to all, at most. They change the candidates only.
FREQUENT_A_TASK, FREQUENT = 8192, 131_072
#: Sets, or gathered sets, of a fragment whose pairs are counted, at most.
CROWD = 64
#: Classes of a block, and n-grams that they have together, about; groups of more are compared block against block.
BLOCK, VOLUME = 512, 2_000_000
#: N-grams of a fragment in which overlaps are counted.
FRAGMENT = 4096


class NgramSets:
    """Sorted distinct n-gram hashes of texts; fewer words than ``n`` are one n-gram, no words none."""

    def __init__(self, n: int):
        self.n, self.hasher = n, WordHasher(BLANKS)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        words, counts = self.hasher(texts)
        rolled = np.zeros(max(0, len(words) - self.n + 1), np.uint64)
        for i in range(self.n):
            rolled = mix64(rolled + words[i : i + len(rolled)])
        sets, at = [], 0
        for c in counts.tolist():
            if c >= self.n:
                sets.append(np.unique(rolled[at : at + c - self.n + 1]))
            else:
                short = np.full(min(c, 1), 0x5EED + c, np.uint64)
                for w in words[at : at + c]:
                    short = mix64(short + w)
                sets.append(short)
            at += c
        return sets


def _signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over mixed members: equal for equal sets."""
    return tuple(int(mix64(s ^ np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for k in (0x243F6A8885A308D3, 0x13198A2E03707344))


class _Frequent:
    """Lossy counting: the most frequent n-grams of a task in bounded memory."""

    def __init__(self, room: int = 2_000_000):
        self.room, self.held, self.size = room, [], 0
        self.grams, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, s: np.ndarray) -> None:
        self.held.append(s)
        self.size += len(s)
        if self.size > self.room:
            self._settle()

    def _settle(self) -> None:
        grams, at = np.unique(np.concatenate([self.grams, *self.held]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([self.counts, np.ones(len(at) - len(self.counts), np.int64)]), len(grams)).astype(np.int64)
        keep = np.argsort(-counts, kind="stable")[: self.room // 8]
        self.grams, self.counts, self.held, self.size = grams[keep], counts[keep], [], 0

    def most(self) -> tuple[np.ndarray, np.ndarray]:
        self._settle()
        top = np.flatnonzero(self.counts[:FREQUENT_A_TASK] >= 3)
        return self.grams[top], self.counts[top]


def _signatures(slim: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, n, c1, c2), the size and signature of every text's set, and (gram, hits) of each task's frequent
    n-grams; staged."""
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "c1", "c2", "gram", "hits"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, frequent, seen, id_type = NgramSets(n), _Frequent(), set(), pa.int64()
        for batch in batches:
            texts, out, id_type = batch.column(1).to_pylist(), [], batch.column(0).type
            for a, b in slices(texts):
                for s in sets(texts[a:b]):
                    sign = _signature(s)
                    out.append((len(s), *sign))
                    if sign not in seen:  # copies inside a task count once
                        seen.add(sign)
                        frequent.add(s)
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            none = pa.nulls(len(out), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, none, none], names=names)
        grams, counts = frequent.most()
        none = pa.nulls(len(grams), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(grams), id_type), pa.nulls(len(grams), pa.int32()), none, none, pa.array(grams.view(np.int64)), pa.array(counts)], names=names)

    return staged(slim.mapInArrow(work, f"doc_id {kind}, n int, c1 long, c2 long, gram long, hits long"), "ngram-sets")


class Fragments:
    """Which fragments of a set are looked up, so that any two sets that link agree in one.

    Sizes fall into classes, each reaching three times as far (in powers of 100 / percent) as linked sizes can lie apart.
    A set is cut for its own class, and for the one below if it can link with a set there. For a class, ``differ`` is the
    most n-grams in which linked sets of it can differ; there are ``spare`` more fragments than that, and at least so many
    are the same in linked sets. So a set with fewer than ``spare`` fragments that are empty leaves these out, and one with
    fewer than ``spare`` that are empty or hold only ``frequent`` n-grams leaves out all of those.
    """

    def __init__(self, percent: int, frequent: np.ndarray):
        self.percent, self.frequent = percent, frequent
        self.bounds = [1]  # first size of each class

    def _class_of(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * (100 / self.percent) ** 3)))
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def __call__(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the fragments of a set, their classes, and in how many of a class it must agree with any linked set.

        That number is negative if frequent fragments are looked up too: then it holds for linked sets with a negative
        number, and for others their own does. It is 0, which is unknown, if empty fragments are looked up.
        """
        own, out, of, need = self._class_of(len(s)), [], [], []
        spread = mix64(s ^ np.uint64(0x452821E638D01377))
        rare = np.ones(len(s), np.int64)
        if len(self.frequent):
            rare[self.frequent[np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)] == s] = 0
        for c in (own, own - 1):
            if c < 0 or (c < own and self.percent * len(s) > 100 * (self.bounds[own] - 1)):
                continue
            small = self.bounds[c + 1] - 1  # linked sets: the smaller has at most so many, the larger 100 / percent times that
            differ = (100 - self.percent) * (small + small * 100 // self.percent) // (100 + self.percent)
            spare = 1 + (differ > 0) + differ // 4
            count = differ + spare
            spare = max(spare, count - (100 - self.percent) * len(s) // self.percent)  # fewer n-grams differ in a linked set of this one
            place = ((s >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            sums, places, telling = np.add.reduceat(spread, first), place[first], np.add.reduceat(rare, first) > 0
            if count - telling.sum() < spare:
                sums, places = sums[telling], places[telling]
                least = spare - (count - len(sums))
            elif count - len(first) >= spare:
                empty = np.setdiff1d(np.arange(count, dtype=np.uint64), places)
                sums, places = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([places, empty])
                least = 0
            else:
                least = (count - len(sums)) - spare
            out.append(mix64(mix64(sums + places) + np.uint64(c + 1)))
            of.append(np.full(len(sums), c, np.int32))
            need.append(np.full(len(sums), least, np.int32))
        return np.concatenate(out), np.concatenate(of), np.concatenate(need)


def _fragments(slim: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(fragment, c1, size_class, need): the fragments that every class of sets is looked up by, once a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, fragments, seen = NgramSets(n), Fragments(percent, frequent), set()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                found, classes = [(np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32))], [np.empty(0, np.int64)]
                for s in sets(texts[a:b]):
                    sign = _signature(s)
                    if len(s) and sign not in seen:
                        seen.add(sign)
                        found.append(fragments(s))
                        classes.append(np.full(len(found[-1][0]), sign[0], np.int64))
                out, of, need = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out.view(np.int64)), pa.array(np.concatenate(classes)), pa.array(of), pa.array(need)],
                    names=["fragment", "c1", "size_class", "need"])

    return slim.mapInArrow(work, "fragment long, c1 long, size_class int, need int")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose fragment other sets have too."""
    own = rows.select("fragment", "c1", "size_class", "need", F.expr("min(c1) OVER (PARTITION BY fragment)").alias("first"),
                      F.expr("max(c1) OVER (PARTITION BY fragment)").alias("last"))
    return staged(own.where("first <> last").drop("last"), "ngram-shared")


def _plausible(rows: DataFrame, rounds: int = 4) -> DataFrame:
    """Shared fragments of the sets that agree with others in enough of them, looked at again as others drop out.

    Sets that link never drop out, however many rounds there are; a round that drops less than 1 % is the last.
    """
    shared = _shared(rows)
    for _ in range(rounds):
        enough = shared.groupBy("c1", "size_class").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("least")).where("n >= least")
        fewer = _shared(shared.join(enough.select("c1", "size_class"), ["c1", "size_class"]))
        before, after = shared.count(), fewer.count()
        discard(shared)
        shared = fewer
        if after > 0.99 * before:
            break
    return shared


def _stars(shared: DataFrame) -> DataFrame:
    """(a, b): sets that agree with the first set of their fragments in as many fragments as any link brings about.

    Near copies mostly do, whatever their number, at one row for each set and fragment.
    """
    rows = shared.where((F.col("c1") != F.col("first")) & (F.col("need") != 0)).groupBy("size_class", "c1", "first").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("need")).alias("need"))
    return rows.where("n >= need").select(F.col("c1").alias("a"), F.col("first").alias("b"))


def _candidates(shared: DataFrame) -> DataFrame:
    """(a, b): links that join all sets which may be alike into one group.

    Sets are first gathered around the first sets of their fragments; what is gathered is one node from then on and needs no
    pairs. In fragments of few nodes the pairs are counted, and a pair needs as many as the least that a link of their sets
    can bring about, less the fragments of more nodes that both have. Nodes hang on the smallest one of a fragment of more
    nodes only if they have so many of those that a link might bring about no others.
    """
    stars = staged(_stars(shared).distinct(), "ngram-stars")
    gathered = components(stars, "ngram-gathered")
    nodes = shared.select("fragment", "size_class", "c1", "need").join(gathered, F.col("c1") == F.col("node"), "left").groupBy(
        "fragment", "size_class", F.coalesce("label", "c1").alias("c1")).agg(
        F.expr("CASE WHEN min(need) > 0 THEN min(need) WHEN max(need) < 0 THEN max(need) ELSE 0 END").alias("need"))
    crowds = nodes.groupBy("fragment").agg(
        F.count(F.lit(1)).alias("crowd"), F.min("c1").alias("first"), F.max("c1").alias("last"), (F.max("need") > 0).alias("telling"))
    crowds = crowds.where("first <> last").select("fragment", "telling", (F.col("crowd") > CROWD).alias("crowded"))
    nodes = staged(nodes.join(crowds, "fragment"), "ngram-nodes")
    held = nodes.where("crowded").groupBy("size_class", "c1").agg(F.count(F.lit(1)).alias("held"))
    held = nodes.join(held, ["size_class", "c1"], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    few = held.where("NOT crowded").select("fragment", "size_class", "c1", "need", "held")
    other = few.select("fragment", F.col("c1").alias("c2"), F.col("need").alias("need_2"), F.col("held").alias("held_2"))
    least = F.expr("CASE WHEN greatest(need, need_2) > 0 THEN greatest(need, need_2) WHEN greatest(need, need_2) < 0 THEN -least(need, need_2) ELSE 1 END")
    pairs = (
        few.join(other.hint("merge"), "fragment").where("c1 < c2").groupBy("size_class", "c1", "c2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(least - F.least("held", "held_2")).alias("least")).where("n >= least")
    )
    heavy = held.where("crowded AND (need = 0 OR need > 0 AND held >= need OR need < 0 AND (telling OR held >= -need))")
    firsts = heavy.groupBy("fragment").agg(F.min("c1").alias("first"))
    hung = heavy.join(firsts, "fragment").where("c1 <> first").select(F.col("c1").alias("a"), F.col("first").alias("b"))
    return pairs.select(F.col("c1").alias("a"), F.col("c2").alias("b")).unionByName(hung).unionByName(stars).distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``, fragment by fragment."""
    grams = np.concatenate([*left, *right])
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    distinct, at, hits = np.unique(grams, return_inverse=True, return_counts=True)
    shared = hits > 1  # an n-gram of one set overlaps with nothing
    column = np.cumsum(shared) - 1
    keep = shared[at]
    rows, at = rows[keep], column[at[keep]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    total = np.zeros((len(left), len(right)), np.float64)
    for begin in range(0, int(shared.sum()), FRAGMENT):
        a, b = np.searchsorted(at, [begin, begin + FRAGMENT])
        part = np.zeros((len(left) + len(right), FRAGMENT), np.float32)
        part[rows[a:b], at[a:b] - begin] = 1
        total += part[: len(left)] @ part[len(left) :].T  # exact: counts stay far below 2**24
    return np.rint(total).astype(np.int64)


def _forest(links: np.ndarray, size: int) -> list[tuple[int, int]]:
    """A spanning forest of the given links among ``size`` nodes."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in links.tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _compare(block: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """Rows (positions) of ``block`` that link: rows of side 0 with rows of side 1, or all with all if there is one side."""
    sets = [np.frombuffer(b, np.uint64) for b in block["grams"]]
    side = block["side"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    common = overlaps([sets[i] for i in left], [sets[i] for i in right])
    sizes = np.array([len(s) for s in sets])
    union = sizes[left][:, None] + sizes[right][None, :] - common
    a, b = np.nonzero(100 * common >= percent * union)
    pairs = np.column_stack([left[a], right[b]])
    return iter(_forest(pairs[pairs[:, 0] != pairs[:, 1]], len(sets)))


def _cells(members: DataFrame, percent: int) -> DataFrame:
    """``members`` with the cell they are in, all cells they must be compared with, and whether that is their group alone.

    A cell is a block of a size band. Bands are as wide as linked sizes can lie apart, so links stay in a band or lead to
    the next one. Groups of up to three blocks are one band.
    """
    def blocks(count: str, volume: str) -> Column:
        return F.greatest(F.ceil(F.col(count) / BLOCK), F.ceil(F.col(volume) / VOLUME)).cast("long")

    def cell(band: Column, block: Column) -> Column:
        return band * (1 << 20) + block

    width = max(math.log(100 / percent) * 1.0001, 0.01)
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("v")).withColumn("in_all", blocks("m", "v"))
    banded = members.join(sizes.select("label", "in_all"), "label").withColumn(
        "band", F.when(F.col("in_all") > 3, F.floor(F.log(F.col("n").cast("double")) / width)).otherwise(0).cast("long"))
    bands = banded.groupBy("label", "band").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("v"))
    bands = bands.select("label", "band", blocks("m", "v").alias("blocks"))
    near = (
        bands.select("label", F.col("band").alias("of"), "blocks", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"))
        .groupBy("label", "band").agg(
            F.max(F.when(F.col("of") == F.col("band"), F.col("blocks"))).alias("blocks"),  # null: no sets of this band
            F.collect_list(F.struct("of", "blocks")).alias("near"))
        .where("blocks IS NOT NULL")
    )
    others = F.flatten(F.transform("near", lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["blocks"] - 1), lambda b: cell(x["of"], b))))
    return banded.join(near, ["label", "band"]).select(
        "rep", "c1", "c2", "label", cell(F.col("band"), F.pmod(F.xxhash64("c1"), F.col("blocks"))).alias("own"),
        others.alias("others"), (F.col("in_all") == 1).alias("alone"))


def group_by_ngrams(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Words are runs of anything but blanks, ASCII letters lower-cased. Sets link when their intersection has at least
    ``percent`` % of their union; the component is the smallest id that links reach. A text without words links with
    nothing. Rows of equal id count as one document with several texts; a row without id takes part in nothing and has a
    null component. An empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with_id = slim.where("doc_id IS NOT NULL")
    both = _signatures(slim, n)
    sets = both.where("gram IS NULL").select("doc_id", "n", "c1", "c2")
    common = both.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("hits").alias("hits")).orderBy(F.desc("hits"), "gram").limit(FREQUENT)
    frequent = np.sort(np.array([r.gram for r in common.select("gram").collect()], np.int64).view(np.uint64))
    shared = _plausible(_fragments(with_id, n, percent, frequent))
    edges = staged(_candidates(shared), "ngram-candidates")
    discard(shared)
    groups = components(edges, "ngram-groups")

    classes = sets.where("doc_id IS NOT NULL AND n > 0").groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"))
    members = staged(classes.join(groups, F.col("c1") == F.col("node")).select("rep", "n", "c1", "c2", "label"), "ngram-members")
    bins = 1 + members.count() // 1000
    placed = _cells(members, percent)
    kept = ("rep", "label", "own", "others", "alone")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = NgramSets(n)
        for batch in batches:
            texts, c1, c2 = batch.column("text").to_pylist(), batch.column("c1").to_pylist(), batch.column("c2").to_pylist()
            for a, b in slices(texts):
                own = made(texts[a:b])
                # an id that has several texts keeps the one of this class
                right = [i for i, s in enumerate(own, a) if _signature(s) == (c1[i], c2[i])]
                rows = batch.take(pa.array(right, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(x) for x in kept] + [pa.array([own[i - a].tobytes() for i in right], pa.binary())], names=[*kept, "grams"])

    # members grow with the documents, so they are never broadcast, not even where they happen to be few
    found = with_id.join(placed.withColumn("doc_id", F.col("rep")).hint("merge"), "doc_id").select("text", "c1", "c2", *kept)
    found = found.mapInArrow(read_sets, f"rep {kind}, label long, own long, others array<long>, alone boolean, grams binary")
    spread = (
        found.withColumn("other", F.explode("others"))
        .select(
            "rep", "label", "grams", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            # small groups share a task, each pair of blocks of a large one has its own
            F.when(F.col("alone"), F.pmod(F.xxhash64("label"), F.lit(bins)))
            .otherwise(F.xxhash64("label", F.least("own", "other"), F.greatest("own", "other"))).alias("task"),
        )
    )

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, block in rows.groupby(["label", "low", "high"], sort=False):
            reps = block["rep"].tolist()
            out += [(reps[i], reps[j]) for i, j in _compare(block, percent)]
        return pd.DataFrame(out, columns=["a", "b"])

    links = staged(spread.groupBy("task").applyInPandas(link, f"a {kind}, b {kind}"), "ngram-links")
    labels = components(links, "ngram-components").select(F.col("node").alias("rep"), F.col("label").alias("component_id"))
    for done in (edges, members):
        discard(done)
    known = sets.join(classes, ["n", "c1", "c2"], "left").join(labels, "rep", "left")
    return known.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id")).alias("component_id"))


def keep_one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group, that of the smallest id; columns stay. Rows without id or words all stay.

    Of several rows of one id the first by text (null first) stays.
    """
    grouped = staged(group_by_ngrams(docs, n, percent, text, doc_id), "ngram-grouped")
    gone = grouped.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = staged(
        grouped.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"), "ngram-repeated")
    kept = docs.join(gone.withColumnRenamed("doc_id", "_gone").hint("merge"), F.col(doc_id) == F.col("_gone"), "left_anti")
    if repeated.isEmpty():
        return kept
    repeated = repeated.withColumnRenamed("doc_id", "_again")
    again = kept.join(repeated, F.col(doc_id) == F.col("_again"), "left_semi")
    first = again.groupBy(F.col(doc_id).alias("_id")).agg(F.min_by(F.struct(*again.columns), F.coalesce(F.concat(F.lit("t"), F.col(text)), F.lit(""))).alias("_row"))
    return kept.join(repeated, F.col(doc_id) == F.col("_again"), "left_anti").unionByName(first.select("_row.*"))
