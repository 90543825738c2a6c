"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamella.llm import queries, trie

WORDS = re.compile("[^\x20\x09-\x0d]+")


def plain_trie(convs: dict) -> list:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        below = [totals[k] for k in children[p]]
        totals[p] = (sum(x for x, _ in below) or 1, own + sum(y for _, y in below))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *totals[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items())


def found(nodes) -> list:
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(r[n] for n in names) for r in nodes.collect())


def by_key(rows: list) -> list:
    return sorted(rows, key=lambda r: (r[0], r[1]))


def table(spark, convs: dict):
    rows = [(c, i, role, text, "extra", 1) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, n_convs int")


@pytest.fixture
def many():
    rng = random.Random(5)
    turns = [(r, t) for r in ("user", "assistant", "") for t in ("a", "b c", "", "d\te f", "  g")]
    convs = {c: [rng.choice(turns[: 2 + c % 9]) for _ in range(rng.choice((1, 2, 3, 5, 8)))] for c in range(-30, 400)}
    hot = [("user", "same start"), ("assistant", "same answer now")]
    convs |= {c: hot * 2 for c in range(1000, 1200)}  # copies of one conversation
    convs |= {c: hot + [("user", f"turn {c % 7}")] for c in range(1200, 1300)}
    long = [("user" if i % 2 else "assistant", f"t{i % 5}") for i in range(150)]
    convs |= {2000 + i: long[: 150 - i] for i in (0, 1, 50, 86, 118, 119)}  # beyond several matrices
    convs |= {3000: [*long[:70], ("user", "other")], 3001: [*long[:33], ("user", "other")]}
    return convs


@pytest.mark.parametrize("cells", [10**6, 200])
def test_nodes_against_plain(spark, many, monkeypatch, cells):
    """Also in many shards, whose borders cut through nodes."""
    monkeypatch.setattr(trie, "CELLS", cells)
    nodes = trie.prefix_trie(table(spark, many))
    assert by_key(found(nodes)) == by_key(plain_trie(many))


def test_query_against_plain(spark, sf):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role or "", r.text or ""))
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    assert by_key(found(queries.op13_prefix_trie(spark, sf))) == by_key(plain_trie(rebuilt))


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (1, 0, None, "w"),
        (2, 0, "user", "word " * 50_000), (3, 5, "user", ""), (41, 0, "user", "only own turn"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {1: [("user", ""), ("", "w"), ("", "x"), ("", "x")], 2: [("user", "word " * 50_000)], 3: [("user", "")], 41: [("user", "only own turn")]}
    assert by_key(found(trie.prefix_trie(df))) == by_key(plain_trie(convs))
    empty = trie.prefix_trie(df.limit(0))
    assert empty.count() == 0 and len(empty.columns) == 8


def test_openings(spark):
    """Conversation 41 has no base and loses its only turns, yet it counts; 2 and 3 open like 0."""
    convs = {0: [("u", "zero"), ("a", "one"), ("u", "two")], 2: [("u", "p"), ("a", "q"), ("u", "r")], 3: [("u", "p")], 41: [("u", "gone")]}
    slim = trie.digest_turns(table(spark, convs))
    conv = F.col("conv_id")
    nodes = trie.trie(trie.share_openings(slim, base=conv - conv % 20, taken=F.lit(2), most=3))
    want = {0: convs[0], 2: [*convs[0][:2], ("u", "r")], 3: convs[0][:2], 41: []}
    assert by_key(found(nodes)) == by_key(plain_trie(want))
