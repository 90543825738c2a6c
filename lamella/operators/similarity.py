"""Names that mean the same party: similar pairs, clusters, the master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import text
from lamella.operators.dedupe import keep_first
from lamella.operators.skew import salted_join
from lamella.staging import stage


def name_block(state: Column, key: Column, letters: int = 3) -> Column:
    """Names are compared inside a state if they begin with the same ``letters``; other pairs are never seen."""
    return F.concat_ws(":", state, F.substring(key, 1, letters))


def distinct_names(records: DataFrame, record_id: str, name: str, state: str, letters: int = 3) -> DataFrame:
    """One row per (block, compared form of the name): smallest id, number of records, tokens.

    Copies of a name meet here in a partial aggregate and take part in pairing once.
    """
    keyed = records.select(record_id, text.match_name(F.col(name)).alias("key"), F.col(state).alias("_state"))
    keyed = keyed.where(text.is_filled(F.col("key"))).withColumn("block", name_block(F.col("_state"), F.col("key"), letters))
    names = keyed.groupBy("block", "key").agg(F.min(record_id).alias("node"), F.count(F.lit(1)).alias("records"))
    return names.withColumn("tokens", F.array_sort(F.array_distinct(F.split("key", " "))))


def similar_pairs(names: DataFrame, merge_pct: int = 60, review_pct: int = 40) -> DataFrame:
    """Pairs of distinct names in one block whose token sets have a Jaccard similarity of ``review_pct`` or more.

    Sets of ``m`` and ``n`` tokens that similar have ``o = ceil(review * (m + n) / (1 + review))`` tokens in common, so
    with tokens ordered by their frequency in the block they share one of the rarest ``m - o + 1`` and ``n - o + 1``.
    Every set is looked up once per size of partner that it can have, and candidates meet on (block, both sizes, rare
    token): two-token names meet on their rarer token only, never on a word that a whole block has. A pair that shares
    several rare tokens is tested only for the first of them. Nothing is left out.
    """
    words = names.select("node", "block", F.explode("tokens").alias("token"))
    frequency = words.groupBy("block", "token").agg(F.count(F.lit(1)).alias("_df"))
    weighed = salted_join(words, frequency, ["block", "token"], "_df", ["node"], how="inner")
    ordered = weighed.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("_df", "token"))).alias("_t"))
    ranked = ordered.select("node", F.transform("_t", lambda t: t["token"]).alias("ranked"))
    sets = stage(names.select("node", "block", "key").join(ranked, "node"), "name_sets")

    def overlap(sizes: Column) -> Column:
        return F.floor((sizes * review_pct + 99 + review_pct) / (100 + review_pct)).cast("int")

    def prefix(tokens: str) -> Column:
        return F.slice(tokens, 1, F.size(tokens) - overlap(F.col("small") + F.col("large")) + 1)

    def side(s: str, own: str, partner: str, least: Column, most: Column) -> DataFrame:
        """The prefixes of all sets, as the smaller (or larger) set of a pair."""
        sized = sets.withColumn(own, F.size("ranked")).withColumn(partner, F.explode(F.sequence(least, most)))
        return sized.select(
            "block", "small", "large", F.explode(prefix("ranked")).alias("token"), F.col("node").alias(f"{s}_id"),
            F.col("key").alias(f"{s}_name"), F.col("ranked").alias(f"_{s}"))

    m = F.size("ranked")
    smaller = side("a", "small", "large", m, F.floor(m * 100 / review_pct).cast("int"))
    larger = side("b", "large", "small", F.ceil(m * review_pct / 100).cast("int"), m)
    shared = F.size(F.array_intersect("_a", "_b"))
    either = F.size("_a") + F.size("_b") - shared
    first_common = F.get(F.array_intersect(prefix("_a"), prefix("_b")), F.lit(0)) == F.col("token")
    # of two sets of one size, that of the smaller id is the first
    once = (F.col("small") < F.col("large")) | (F.col("a_id") < F.col("b_id"))
    met = smaller.join(larger, ["block", "small", "large", "token"]).where(
        once & first_common & (shared * 100 >= either * review_pct))
    swapped = F.col("a_id") > F.col("b_id")
    met = met.select(
        F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id"),
        F.when(swapped, F.col("b_name")).otherwise(F.col("a_name")).alias("a_name"),
        F.when(swapped, F.col("a_name")).otherwise(F.col("b_name")).alias("b_name"), "block", "_a", "_b")
    return met.select(
        "a_id", "b_id", "a_name", "b_name", "block",
        (shared / either).alias("similarity"),
        F.when(shared * 100 >= either * merge_pct, "MERGE").otherwise("REVIEW").alias("decision"),
    )


def cluster(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Connected groups of ``nodes(node)`` under ``pairs(a_id, b_id)``; the label is the smallest member.

    Every round each node takes the smallest label among itself and its neighbours, and then the label of
    that label, which makes long chains shrink quickly. Rounds go on until nothing changes. Labels are
    written once per round, so neither the plan nor the lineage grows. Messages to a node are combined
    before they are shuffled; the join of labels to edges is split for nodes with very many neighbours. Only nodes
    with links take part in the rounds.
    """
    edges = stage(
        pairs.select(F.col("a_id").alias("src"), F.col("b_id").alias("dst")).unionByName(
            pairs.select(F.col("b_id").alias("src"), F.col("a_id").alias("dst"))
        ),
        "edges",
    )
    degrees = stage(edges.groupBy("src").agg(F.count(F.lit(1)).alias("_degree")), "degrees")
    labels = degrees.select(F.col("src").alias("node"), F.col("src").alias("label"))
    while True:
        sending = degrees.join(labels, degrees["src"] == labels["node"]).select("src", "_degree", "label")
        sent = salted_join(edges, sending, ["src"], "_degree", ["dst"], how="inner")
        received = sent.groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("_seen"))
        lower = labels.join(received, "node", "left").select(
            "node", F.col("label").alias("_old"), F.least("label", "_seen").alias("label")
        )
        lower = stage(lower, "lower")
        # A label is followed once more. Many nodes may carry one label, so the join is split by their number.
        carriers = lower.groupBy("label").agg(F.count(F.lit(1)).alias("_carriers"))
        jump = carriers.join(lower.select(F.col("node").alias("label"), F.col("label").alias("_next")), "label")
        jumped = salted_join(lower, jump, ["label"], "_carriers", ["node"], how="inner")
        after = stage(jumped.select("node", "_old", F.least("label", "_next").alias("label")), "labels")
        if after.where("label <> _old").isEmpty():
            every = nodes.select("node").distinct().join(after.select("node", "label"), "node", "left")
            return every.select("node", F.coalesce("label", "node").alias("cluster"))
        labels = after.select("node", "label")


def party_master(records: DataFrame, record_id: str, name: str, state: str, merge_pct: int = 60) -> DataFrame:
    """One row per resolved party: the most frequent spelling, all spellings, all states.

    Names are compared inside their blocks; names of equal compared form are one party in all states. Records are reduced to distinct (block, key, spelling, state) before they meet their cluster.
    """
    names = stage(distinct_names(records, record_id, name, state), "names")
    pairs = similar_pairs(names, merge_pct, review_pct=merge_pct).select("a_id", "b_id")
    everywhere = names.groupBy("key").agg(F.min("node").alias("a_id"))
    same = names.join(everywhere, "key").where("node <> a_id").select("a_id", F.col("node").alias("b_id"))
    clusters = cluster(names.select("node"), pairs.unionByName(same))
    key = text.match_name(F.col(name))
    spelled = (
        records.select(F.col(name).alias("spelling"), F.col(state).alias("state"), key.alias("key"))
        .where(text.is_filled(F.col("key")))
        .withColumn("block", name_block(F.col("state"), F.col("key")))
        .groupBy("block", "key", "spelling", "state").agg(F.count(F.lit(1)).alias("n"))
    )
    known = names.select("block", "key", "node").join(clusters, "node").select("block", "key", "cluster")
    members = stage(spelled.join(known, ["block", "key"]).select("cluster", "spelling", "state", "n"), "members")
    by_spelling = members.groupBy("cluster", "spelling").agg(F.sum("n").alias("n"))
    canonical = keep_first(by_spelling, ["cluster"], [F.col("n").desc(), F.col("spelling").asc()])
    canonical = canonical.select("cluster", text.display_name(F.col("spelling")).alias("party_name_normalized"))
    totals = members.groupBy("cluster").agg(
        F.sort_array(F.collect_set("spelling")).alias("party_name_variants"),
        F.sort_array(F.collect_set("state")).alias("states_appeared"),
        F.sum("n").alias("records"),
    )
    shown = F.col("party_name_normalized")
    return totals.join(canonical, "cluster").select(
        text.hash_key(F.col("cluster")).alias("party_id"),
        "cluster",
        "party_name_normalized",
        "party_name_variants",
        text.is_entity(shown).alias("is_entity"),
        text.entity_type(shown).alias("entity_type"),
        "states_appeared",
        "records",
    )
