"""Prefix trie of conversations from sorted, padded matrices of turn ids.

Every turn becomes a 120-bit id of role and text, so a conversation is a row of ids. Equal conversations count once, with
their number. The distinct rows are dealt to shards by ranges of the lexicographic order. Inside a shard numpy sorts
padded matrices of ids (blocks of 32 columns, so that a few long conversations do not widen the rest), marks where a column
differs from the row above, and accumulates the marks from left to right with OR: a mark at column d is the start of a
node of depth d. All figures of a node are sums or minima over the rows between two starts, for every depth one reduceat.

A shard also sees the last row before and the first row after it. So starts, leaves and children are counted once in all,
and only nodes on the path of such a neighbour can lie in several shards: these are added up by the digest of their prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import WORD, hex_number, join_small, staged

#: Turns of a padded matrix; turns that a shard holds, about; turns by which conversations are dealt to shards.
BLOCK, CELLS, RANGE_TURNS = 32, 1_000_000, 64
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, key string, parent_key string")


def digest_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, hi, lo, words): the turns of every conversation numbered from 0, with their id and number of words.

    Turns stand by ``turn`` (null first), then role, then text, so that ties and repeated rows have one order. Null roles
    and texts count as empty. Rows without conversation id are left out. Numbering is a window over the turns of a
    conversation, which Spark sorts on disk if need be; texts end here.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    name = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("at"), name.alias("id"), F.regexp_count("text", F.lit(WORD)).alias("words")).select(
        "conv_id", "at", hex_number(F.substring("id", 1, 15)).alias("hi"), hex_number(F.substring("id", 16, 15)).alias("lo"), "words")


def share_openings(slim: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """Digested turns in which each conversation opens with the first ``taken`` turns of the conversation ``base`` (all if
    that has fewer, none if it is absent), followed by its own turns after its first ``taken``.

    ``base`` and ``taken`` are expressions of ``conv_id``; ``taken`` is at most ``most``. A conversation that is left
    without turns keeps a row with a null ``hi``, so it still counts.
    """
    convs = slim.where("at = 0").select("conv_id", base.alias("base"), taken.alias("taken"))
    opening = slim.where(F.col("at") < most).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(opening, "base").where("at < taken").select("conv_id", "at", "hi", "lo", "words")
    own = slim.where(F.col("at") >= taken)
    marks = convs.select("conv_id", F.lit(-1).alias("at"), *(F.lit(None).cast(t).alias(c) for c, t in (("hi", "long"), ("lo", "long"), ("words", "int"))))
    return own.unionByName(borrowed).unionByName(marks)


def _ends(convs: DataFrame) -> DataFrame:
    """(key, n, conv_id, ends_sha256): number and smallest id of the conversations of a key, and the digest of their ids.

    A digest is read from front to back, so the ids of one key pass one task, as a sorted stream that is never held whole.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n, least = None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids, out = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), []
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                run = ",".join(map(str, ids[a:b].tolist())).encode()
                if keys[a] == key:
                    held.update(b"," + run)
                else:
                    if key is not None:
                        out.append((key, n, least, held.hexdigest()))
                    key, held, n, least = keys[a], hashlib.sha256(run), 0, int(ids[a])
                n += b - a
            yield _batch(out)
        yield _batch([] if key is None else [(key, n, least, held.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"key": pa.string(), "n": pa.int64(), "conv_id": pa.int64(), "ends_sha256": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    dealt = convs.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(work, "key string, n long, conv_id long, ends_sha256 string")


class _Rows:
    """Turn ids of many conversations, as padded matrices of some of their columns; -1 pads and is below all ids."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, turns: np.ndarray):
        self.flat, self.starts, self.turns = flat, starts, turns
        self.blocks = -(-int(turns.max(initial=0)) // BLOCK)

    def matrix(self, rows: np.ndarray, block: int, wide: int = 2) -> np.ndarray:
        """Columns of a block, ``wide`` numbers a turn."""
        place = block * BLOCK * wide + np.arange(BLOCK * wide)
        there = place[None, :] < self.turns[rows, None] * wide
        out = np.full(there.shape, -1, np.int64)
        out[there] = self.flat[(self.starts[rows, None] * wide + place[None, :])[there]]
        return out

    def order(self) -> np.ndarray:
        """Row numbers in lexicographic order: blocks are ranked from the last to the first."""
        deeper, rows = np.zeros(len(self.turns), np.int64), np.empty(0, np.int64)
        for b in reversed(range(self.blocks)):
            rows = np.flatnonzero(self.turns > b * BLOCK)
            keys = np.column_stack([self.matrix(rows, b), deeper[rows]])
            at = np.lexsort(keys.T[::-1])
            rows, keys = rows[at], keys[at]
            deeper[rows] = 1 + np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).any(axis=1)]))
        return np.concatenate([np.flatnonzero(self.turns == 0), rows])

    def starts_of_nodes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of sorted rows, for each block: the rows that reach it, and where a node starts at each of its columns."""
        out, changed = [], np.zeros(len(self.turns), bool)
        for b in range(self.blocks):
            rows = np.flatnonzero(self.turns > b * BLOCK)
            ids = self.matrix(rows, b)
            differ = np.ones((len(rows), BLOCK), bool)
            differ[1:] = (ids[1:, ::2] != ids[:-1, ::2]) | (ids[1:, 1::2] != ids[:-1, 1::2])
            differ[1:] |= (rows[1:] - rows[:-1] > 1)[:, None]  # the row above ends before this block
            differ[:, 0] |= changed[rows]
            marks = np.logical_or.accumulate(differ, axis=1)
            changed[rows] = marks[:, -1]
            out.append((rows, marks))
        return out


def _prefix_keys(ids: np.ndarray) -> list[str]:
    """Digests of all prefixes of a row, the empty one first."""
    held, out = hashlib.md5(), []
    for turn in [b"", *(ids[i : i + 2].tobytes() for i in range(0, len(ids), 2))]:
        held.update(turn)
        out.append(held.hexdigest())
    return out


def shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of the rows of one shard (side 0), seen between its neighbours (sides -1 and 1); keys on their paths only."""
    table = table.combine_chunks()
    lists = {c: table.column(c).chunk(0) for c in ("ids", "words")}
    flat, words = (lists[c].flatten().to_numpy() for c in ("ids", "words"))
    turns = np.diff(lists["ids"].offsets.to_numpy()) // 2
    starts = np.cumsum(turns) - turns
    order = _Rows(flat, starts, turns).order()
    rows = _Rows(flat, starts[order], turns[order])
    turns = rows.turns
    side, n, conv = (table.column(c).to_numpy()[order] for c in ("side", "n", "conv_id"))
    ends = table.column("ends_sha256").to_numpy()[order]
    own = side == 0
    conv = np.where(own, conv, np.iinfo(np.int64).max)
    first, last = np.flatnonzero(own)[[0, -1]]
    paths = [_prefix_keys(flat[2 * rows.starts[i] : 2 * (rows.starts[i] + turns[i])]) for i in (first, last)]

    # what the rows above and below share with a row, and tokens saved along a row (a node's first member saves nothing)
    marked = rows.starts_of_nodes()
    shared, saved, blocks = np.zeros(len(turns), np.int64), np.zeros(len(turns), np.int64), []
    for b, (reach, marks) in enumerate(marked):
        there = b * BLOCK + np.arange(BLOCK)[None, :] < turns[reach, None]
        shared[reach] += (~marks & there).sum(axis=1)
        cost = np.zeros(there.shape, np.int64)
        cost[there] = words[(rows.starts[reach, None] + b * BLOCK + np.arange(BLOCK)[None, :])[there]]
        cost *= (n[reach, None] - marks) * own[reach, None]
        saved[reach] += cost.sum(axis=1)
        blocks.append(cost)
    below = np.append((shared[1:] >= turns[:-1]) & (turns[1:] > turns[:-1]), False)
    leaf = (own & ~below).astype(np.int64)

    out = []
    run, parents = np.zeros(len(turns), np.int64), None
    for d in range(int(turns[own].max()) + 1):
        at = np.flatnonzero(turns >= d)
        if d:
            reach, marks = marked[(d - 1) // BLOCK]
            column, place = (d - 1) % BLOCK, np.searchsorted(reach, at)
            mark = marks[place, column].copy()
        else:
            mark = np.zeros(len(at), bool)
        mark[0] = True
        begin = np.flatnonzero(mark)
        count, least = np.add.reduceat(n[at], begin), np.minimum.reduceat(conv[at], begin)
        opens = own[at] & (turns[at] > d) & (shared[at] <= d)
        outside = np.add.reduceat((~own[at]).astype(np.int64), begin) > 0
        before = np.minimum.reduceat(side[at], begin) < 0
        path = [paths[0][d] if d < len(paths[0]) else None, paths[1][d] if d < len(paths[1]) else None]
        keys = np.where(outside, np.where(before, path[0], path[1]), None)
        ended = own[at][begin] & (turns[at][begin] == d)
        kept = count > 0
        parent = run[at[begin]]
        out.append({
            "depth": np.full(len(begin), d), "conv_id": least, "parent_conv_id": parents[0][parent] if d else np.zeros(len(begin), np.int64),
            "n_convs": count, "n_children": np.add.reduceat(opens.astype(np.int64), begin), "n_leaves": np.add.reduceat(leaf[at], begin),
            "saved_tokens": np.add.reduceat(saved[at], begin), "ends_sha256": np.where(ended, ends[at][begin], None), "key": keys,
            "parent_key": parents[1][parent] if d else np.full(len(begin), None)})
        out[-1] = {c: v[kept] for c, v in out[-1].items()}
        run[at], parents = np.cumsum(mark) - 1, (least, keys)
        if d:
            saved[at] -= blocks[(d - 1) // BLOCK][place, column]
    columns = {c: np.concatenate([o[c] for o in out]) for c in out[0]}
    texts = ("ends_sha256", "key", "parent_key")
    return pa.table({c: pa.array(v.tolist(), pa.string()) if c in texts else pa.array(v.astype(np.int64)) for c, v in columns.items()})


def trie(slim: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``slim`` has digested turns; a row with null ``hi`` stands for a conversation that may have none. A node is named by
    its smallest member and its depth. No rows give no nodes, not even a root. A conversation is one row of 20 bytes a
    turn. Distinct conversations that agree in all of their first 64 turns are dealt to one shard.
    """
    turn = F.when(F.col("hi").isNotNull(), F.struct("at", "hi", "lo", "words"))
    convs = slim.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")).select(
        "conv_id", F.flatten(F.transform("turns", lambda t: F.array(t["hi"], t["lo"]))).alias("ids"), F.col("turns.words").alias("words"))
    convs = staged(convs.withColumn("key", F.md5(F.array_join(F.col("ids").cast("array<string>"), " "))), "trie-conversations")
    distinct = convs.groupBy("key").agg(F.first("ids").alias("ids"), F.first("words").alias("words"))
    distinct = staged(distinct.join(_ends(convs), "key").select("ids", "words", "n", "conv_id", "ends_sha256"), "trie-distinct")

    cells = distinct.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    dealt = distinct.repartitionByRange(1 + cells // CELLS, F.slice("ids", 1, 2 * RANGE_TURNS))
    shards = staged(dealt.withColumn("shard", F.spark_partition_id()), "trie-shards")
    # one row a shard: its first and last conversation go to the shards beside it
    by_shard = Window.orderBy("shard")
    edges = shards.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last")).select(
        "shard", F.lag("last").over(by_shard).alias("before"), F.lead("first").over(by_shard).alias("after"))
    no_words = F.transform(F.sequence(F.lit(1), F.floor(F.size("ids") / 2).cast("int")), lambda _: F.lit(0))
    beside = edges.select("shard", F.explode(F.array(
        F.struct(F.lit(-1).alias("side"), F.col("before").alias("ids")), F.struct(F.lit(1).alias("side"), F.col("after").alias("ids")))).alias("x"))
    beside = beside.select("shard", "x.*").where("ids IS NOT NULL").select(
        "shard", "side", "ids", F.when(F.size("ids") > 0, no_words).otherwise(F.expr("array()").cast("array<int>")).alias("words"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("conv_id"), F.lit("").alias("ends_sha256"))
    rows = shards.withColumn("side", F.lit(0)).unionByName(beside)
    nodes = staged(rows.groupBy("shard").applyInArrow(shard_nodes, NODE), "trie-nodes")

    split = staged(nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"), F.max("parent_key").alias("parent_key")), "trie-split")
    known = nodes.where("key IS NULL").unionByName(split)
    # nodes below a split node learn its smallest member; all others know their parent
    names = split.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    hung = join_small(known.where("parent_key IS NOT NULL"), names, "parent_key").withColumn("parent_conv_id", F.col("named")).drop("named")
    every = known.where("parent_key IS NULL").unionByName(hung)
    return every.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of conversations as they are; other columns are not looked at."""
    return trie(digest_turns(turns, conv_id, turn, role, text))
