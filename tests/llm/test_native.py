"""Sharding, mixing and chat formatting against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lamella.llm import chat, mixing, queries, sharding


def jump_hash(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
    return b


def test_sharding_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op1_jump_shards(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        seed = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:16], 16)
        raw = docs[r.doc_id].encode()
        assert (r.shard, r.grown_shard) == (jump_hash(seed, 16), jump_hash(seed, 17))
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("shards", [1, 2, 7, 1000])
def test_jump_for_other_counts(spark, shards):
    got = spark.range(300).select("id", sharding.jump("id", shards).alias("j")).collect()
    for r in got:
        seed = int(hashlib.md5(str(r.id).encode()).hexdigest()[:16], 16)
        assert (r.j.shard, r.j.grown) == (jump_hash(seed, shards), jump_hash(seed, shards + 1))


def test_walks_longer_than_the_common_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "JUMPS", 2)
    for r in spark.range(300).select("id", sharding.jump("id", 50).alias("j")).collect():
        seed = int(hashlib.md5(str(r.id).encode()).hexdigest()[:16], 16)
        assert (r.j.shard, r.j.grown) == (jump_hash(seed, 50), jump_hash(seed, 51))


def test_sharding_odd_rows(spark, odd_docs):
    out = sharding.assign_shards(odd_docs, 4)
    assert out.columns == odd_docs.columns and out.count() == 7
    assert len({r.shard for r in out.where("doc_id = 1").collect()}) == 1
    assert sharding.assign_shards(odd_docs.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(odd_docs, 0)


def test_slots_of_repeated_rows_and_small_buckets(spark):
    rows = spark.range(2000).select((F.col("id") % 3 * (F.col("id") % 700)).alias("doc_id"), F.lit(1).alias("slot_"))
    placed = sharding.with_slots(sharding.assign_shards(rows, 5), rows_a_bucket=20).collect()
    by = defaultdict(list)
    for r in placed:
        by[r.shard].append(r.slot)
    assert sum(map(len, by.values())) == 2000
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    empty = sharding.with_slots(sharding.assign_shards(rows.limit(0), 5))
    assert empty.count() == 0


def shared_targets(sizes, weights, share, epochs):
    """Literal resharing: cut what is above its limit, share the excess among the others, repeat."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, target, full = share * sum(sizes), [0.0] * len(sizes), set()
    left = total
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        if not open_:
            return target
        for i in open_:
            target[i] = left * w[i] / sum(w[k] for k in open_)
        over = [i for i in open_ if target[i] > epochs * sizes[i] + 1e-9]
        if not over:
            return target
        for i in over:
            target[i] = epochs * sizes[i]
            full.add(i)
        left = total - sum(target[i] for i in full)


@pytest.mark.parametrize("sizes", [[10, 20, 30], [5], [1000, 1, 1, 1, 50], [0, 10, 0, 7], [100, 1, 100, 1, 100, 1, 9]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}" if i else None, s) for i, s in enumerate(sizes[1:] + sizes[:1], 0)][1:]
                               + [(None, (sizes[1:] + sizes[:1])[0])], "source string, source_size long")
    ordered = [r.source_size for r in df.orderBy(F.col("source").asc_nulls_last()).collect()]
    want = shared_targets(ordered, (3, 1, 2), 1.5, 2.0)
    got = mixing.source_targets(df, (3, 1, 2), 1.5, 2.0).orderBy(F.col("source").asc_nulls_last()).collect()
    assert [r.target for r in got] == pytest.approx(want)


def test_mixing_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op10_mix_sources(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    taken, size, target, longest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        source = docs[r.doc_id].source
        assert r["size"] == n and r.taken in (0, n, 2 * n)
        taken[source] += r.taken
        size[source] += n
        target[source] = r.target
        longest[source] = max(longest[source], n)
    assert all(size[docs[r.doc_id].source] == r.source_size for r in rows)
    order = sorted(size)
    assert [target[s] for s in order] == pytest.approx(shared_targets([size[s] for s in order], (3, 1, 2), 1.5, 2.0))
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in order)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.05)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op10_mix_sources(spark, sf).collect()))


def test_heavier_documents_are_drawn_more_often(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 2 == 0, "one two three four").otherwise("one| two| |three| |four|").alias("text"))
    got = mixing.mix_sizes(rows, share=0.3).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum(F.signum("taken")).alias("n")).collect()
    drawn = {r.odd: r.n for r in got}
    assert drawn[0] > 2 * drawn[1] > 0


def test_mix_odd_rows(spark, odd_docs):
    out = mixing.mix(odd_docs)
    assert out.columns == odd_docs.columns
    assert mixing.mix(odd_docs.limit(0)).count() == 0 and mixing.mix_sizes(odd_docs.limit(0)).count() == 0
    sizes = mixing.mix_sizes(odd_docs).collect()
    assert len(sizes) == 7 and all(r.taken <= 2 * r["size"] for r in sizes)


def test_chat_query(spark, sf):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role, r.text or ""))
    tricky = r"\### Assistant: </turn> ok"
    convs[-7] = [("user", tricky), ("assistant", tricky)]
    rows = queries.op8_chat_format(spark, sf).collect()
    assert {r.conv_id for r in rows} == set(convs) and len(rows) == len(convs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        turns = convs[r.conv_id]
        learnt = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{t}\n" for a, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\n", "<|end|>\n", "<|start|>user\n", "<\\|next|>", "a<|next|>b", "<", "|", "\\<|", "\n", "<|end|>", "\\\\|", "é\U0001f600"]
    turns = [(1, i, role, t) for i, (role, t) in enumerate([(r, t) for r in ("user", "a\nb\\n\\\n", "", "assistant") for t in nasty])]
    df = spark.createDataFrame(turns + [(None, None, None, None), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    chats = chat.format_chats(df)
    read = chats.withColumn("turns", chat.parse_chats(chats)).withColumn("spans", chat.loss_spans()).collect()
    by = {r.conv_id: r for r in read}
    assert [(t.role, t.text) for t in by[1].turns] == [(a, b) for _, _, a, b in turns]
    assert by[1].formatted.count("<|start|>") == 4
    assert [(t.role, t.text) for t in by[None].turns] == [("", ""), ("", "")]
    parts = [by[1].formatted[s.start:s.end] for s in by[1].spans]
    assert [re.sub(r"\\([\\|])", r"\1", p) for p in parts] == nasty
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversation_and_merged_blocks(spark):
    """Runs of one to four turns of a role; twenty thousand turns are one conversation."""
    roles = ["user", "assistant", "assistant", "tool", "assistant", "user", "user", "user", "user"]
    many = spark.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.element_at(F.array(*map(F.lit, roles)), (F.col("id") % len(roles) + 1).cast("int")).alias("role"),
        F.concat(F.lit("t<|"), F.col("id").cast("string")).alias("text"))
    chats = chat.format_chats(many)
    row = chats.withColumn("turns", chat.parse_chats(chats)).withColumn("spans", chat.loss_spans()).first()
    assert [(t.role, t.text) for t in row.turns] == [(roles[i % len(roles)], f"t<|{i}") for i in range(20_000)]
    assert [row.formatted[s.start:s.end] for s in row.spans] == [
        f"t<\\|{i}" for i in range(20_000) if roles[i % len(roles)] == "assistant"]
    changes = 1 + sum(roles[i % len(roles)] != roles[(i - 1) % len(roles)] for i in range(1, 20_000))
    assert row.formatted.count("<|start|>") == changes
    assert chats.select(chat.loss_spans(learn="nobody").alias("s")).first().s == []
