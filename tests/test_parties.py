"""Parties over several batches against one comparison of all names."""

import random

import pytest
from pyspark.sql import functions as F

from lamella.operators.parties import PartyRegistry, spanning_forest

ROLES = ["PLAINTIFF", "DEFENDANT", "DEBTOR", "CREDITOR"]


def plain_parties(rows: list) -> list:
    """Groups of (name, state) rows: same block and token Jaccard of 60 %, or equal forms."""
    forms = [" ".join(n.lower().replace(",", " ").replace(".", " ").removesuffix(" llc").split()) for n, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = set(forms[i].split()), set(forms[j].split())
            near = rows[i][1] == rows[j][1] and forms[i][:3] == forms[j][:3] and 100 * len(a & b) >= 60 * len(a | b)
            if forms[i] == forms[j] or near:
                parent[root(i)] = root(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root(i), []).append(row)
    return sorted(sorted({n for n, _ in g}) + sorted({s for _, s in g}) + [len(g)] for g in groups.values())


def found(registry) -> list:
    return sorted([*r.party_name_variants, *r.states_appeared, r.records] for r in registry.master().collect())


@pytest.fixture
def mentions(spark):
    rng = random.Random(4)
    words = ["bank", "of", "ohio", "north", "river", "steel", "josé", "núñez", "東京", "trading", "sons"]
    rows = []
    for i in range(160):
        name = " ".join(["bank" if i % 3 else "josé", *rng.sample(words, rng.choice((1, 2, 3)))]) + rng.choice(("", ", LLC"))
        rows.append((i, name, rng.choice(("TX", "OH")), ROLES[i % 4]))
    rows += [(1000 + i, "hot name one", "TX", "DEBTOR") for i in range(60)] + [(2000, None, "TX", "DEBTOR"), (2001, "...", "TX", "DEBTOR")]
    return spark.createDataFrame(rows, "id long, name string, state string, role string")


def test_batches_equal_one_run(spark, tmp_path, mentions):
    rows = [(r.name, r.state) for r in mentions.collect() if r.name and r.name != "..."]
    want = plain_parties(rows)
    steps = PartyRegistry(spark, str(tmp_path / "steps"))
    alive = {}
    for b in range(2):
        before = {tuple(r[:2]): r.party_id for r in steps.names().collect()} if b else {}
        steps.add(mentions.where(F.col("id") % 2 == b), f"batch {b}")
        aliases = {r.party_id: r.into for r in steps.aliases().collect()}
        alive = {tuple(r[:2]): r.party_id for r in steps.names().collect()}
        for name, party in before.items():
            assert alive[name] == aliases.get(party, party)
        assert not set(aliases.values()) & set(aliases), "aliases lead to living parties"
        if b:
            assert set(aliases.values()) <= set(before.values()), "an old id survives"
    assert found(steps) == want
    assert steps.add(mentions, "batch 1") == 0 and found(steps) == want
    totals = steps.master().agg(*[F.sum(c) for c in ("total_as_plaintiff", "total_as_defendant", "total_liens_as_debtor", "total_liens_as_creditor", "records")]).first()
    assert sum(totals[:4]) == totals[4] == len(rows)
    steps.compact()
    assert found(steps) == want and len(steps.batches()) == 2
    resolved = steps.resolve(mentions, "name", "state").collect()
    assert len(resolved) == mentions.count() and all((r.party_id is None) == (r.name in (None, "...")) for r in resolved)


def test_ids_survive_merges(spark, tmp_path):
    """Two parties of the first batch are joined by a name of the second; the older id of the two lives on."""
    registry = PartyRegistry(spark, str(tmp_path / "r"))

    def add(batch, *names):
        registry.add(spark.createDataFrame([(n, "TX", "PLAINTIFF") for n in names], "name string, state string, role string"), batch)
        return {r.key: r.party_id for r in registry.names().collect()}

    first = add("1", "acme north steel")
    second = add("2", "acme west steel trade")
    assert second["acme north steel"] == first["acme north steel"] != second["acme west steel trade"]
    third = add("3", "acme north steel trade", "acme west north steel trade")
    assert set(third.values()) == {first["acme north steel"]}
    assert [tuple(r) for r in registry.aliases().collect()] == [(second["acme west steel trade"], first["acme north steel"])]
    fourth = add("4", "zeta holdings")
    assert len(set(fourth.values())) == 2 and registry.aliases().count() == 1


def test_a_lost_batch_is_added_again(spark, tmp_path, monkeypatch):
    registry = PartyRegistry(spark, str(tmp_path / "r"))
    rows = spark.createDataFrame([("a b c", "TX", "DEBTOR"), ("a b d", "TX", "DEBTOR")], "name string, state string, role string")
    registry.add(rows, "1")
    commit = PartyRegistry._commit
    monkeypatch.setattr(PartyRegistry, "_commit", lambda self, table, *a: (_ for _ in ()).throw(OSError("lost")) if table == "batches" else commit(self, table, *a))
    more = rows.withColumn("name", F.concat("name", F.lit(" e")))
    with pytest.raises(OSError, match="lost"):
        registry.add(more, "2")
    monkeypatch.undo()
    assert registry.batches() == ["1"] and registry.master().agg(F.sum("records")).first()[0] == 2
    registry.add(more, "2")
    assert registry.master().agg(F.sum("records")).first()[0] == 4
    empty = PartyRegistry(spark, str(tmp_path / "e"))
    assert empty.add(rows.limit(0), "none") == 0 and empty.master().count() == 0


def test_forest_keeps_groups(spark):
    pairs = [(f"n{i}", f"n{j}") for i in range(30) for j in range(i) if (i + j) % 3 == 0]
    left = spanning_forest(spark.createDataFrame(pairs, "a_id string, b_id string").coalesce(1)).collect()
    def groups(edges):
        out = [{f"n{i}"} for i in range(30)]
        for a, b in edges:
            x = next(g for g in out if a in g) | next(g for g in out if b in g)
            out = [g for g in out if not g & x] + [x]
        return sorted(map(sorted, out))
    assert groups(pairs) == groups(left) and len(left) < 30
