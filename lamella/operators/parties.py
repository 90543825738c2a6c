"""Parties that keep their identity: batches of names are matched against a stored index, ids survive merges.

The registry holds every distinct name once, with its party, and an index of rare-token prefixes (see
``similarity.similar_pairs``). A batch is reduced to the names the registry has not seen; only these are looked up, in the
buckets of the index that they can be in, and among themselves. What they link to, parties and other new names, is a small
graph. A group of it takes the id of the oldest party in it; other parties of the group are merged into that one and
stay known as aliases. Nothing that is stored is compared with anything stored before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import text
from lamella.operators.dedupe import keep_first
from lamella.operators.similarity import cluster, name_block
from lamella.operators.skew import salted_join
from lamella.sources import commits
from lamella.staging import stage

# What a party is counted for.
ROLES = {
    "PLAINTIFF": "total_as_plaintiff", "DEFENDANT": "total_as_defendant", "DEBTOR": "total_liens_as_debtor",
    "CREDITOR": "total_liens_as_creditor",
}
BUCKETS = 64

_TABLES = {
    "names": "block string, key string, party_id string, since int",
    "tokens": "block string, token string, weight long",
    "index": "block string, small int, large int, smaller boolean, token string, ranked array<string>, party_id string, bucket int",
    "members": "block string, key string, spelling string, state string, role string, n long",
    "aliases": "party_id string, into string, since int",
}


def spanning_forest(pairs: DataFrame) -> DataFrame:
    """``pairs(a_id, b_id)`` without those that close a circle among the pairs of their task.

    Groups stay the same. Pairs pass through and are never stored; a task keeps one entry for each name it has seen.
    """

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above: dict[str, str] = {}

        def root(x: str) -> str:
            while above.setdefault(x, x) != x:
                above[x] = x = above[above[x]]
            return x

        for batch in batches:
            new = []
            for a, b in zip(batch["a_id"], batch["b_id"], strict=True):
                ra, rb = root(a), root(b)
                new.append(ra != rb)
                above[max(ra, rb)] = min(ra, rb)
            yield batch[new]

    return pairs.select("a_id", "b_id").mapInPandas(keep, "a_id string, b_id string")


def master(counted: DataFrame) -> DataFrame:
    """One row per party of ``counted(party_id, spelling, state, role, n)``: its most frequent spelling, all spellings and
    states, and how often it appears in each role."""
    counted = stage(counted, "party_counts")
    by_spelling = counted.groupBy("party_id", "spelling").agg(F.sum("n").alias("n"))
    canonical = keep_first(by_spelling, ["party_id"], [F.col("n").desc(), F.col("spelling").asc()])
    shown = text.display_name(F.col("spelling"))
    totals = counted.groupBy("party_id").agg(
        F.sort_array(F.collect_set("spelling")).alias("party_name_variants"),
        F.sort_array(F.collect_set("state")).alias("states_appeared"),
        *[F.coalesce(F.sum(F.when(F.col("role") == r, F.col("n"))), F.lit(0)).alias(c) for r, c in ROLES.items()],
        F.sum("n").alias("records"))
    return totals.join(canonical.select("party_id", shown.alias("party_name_normalized")), "party_id").select(
        "party_id", "party_name_normalized", "party_name_variants",
        text.is_entity(F.col("party_name_normalized")).alias("is_entity"),
        text.entity_type(F.col("party_name_normalized")).alias("entity_type"), "states_appeared", *ROLES.values(), "records")


class PartyRegistry:
    """Names, parties and the index below ``path``. Batches are added one after the other, each under a name of its own."""

    def __init__(self, spark: SparkSession, path: str, merge_pct: int = 60, letters: int = 3):
        self.spark, self.path, self.pct, self.letters = spark, path.rstrip("/"), merge_pct, letters

    def batches(self) -> list[str]:
        """Names of the batches that were added, in order; one short row each."""
        if not self._exists("batches"):
            return []
        return [r.name for r in commits.read(self.spark, f"{self.path}/batches").orderBy("batch").collect()]

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _stored(self, table: str, done: int) -> DataFrame:
        """A table as of the first ``done`` batches; what an unfinished batch has written is not seen."""
        if not done or not self._exists(table):
            return self.spark.createDataFrame([], f"{_TABLES[table]}, batch int")
        rows = commits.read(self.spark, f"{self.path}/{table}")
        return rows.where(F.col("batch") == done if table == "aliases" else F.col("batch") <= done)

    def _commit(self, table: str, rows: DataFrame, batch: int, keys: list[str], owned: list[dict] | None = None) -> None:
        commits.commit(rows.withColumn("batch", F.lit(batch)), f"{self.path}/{table}", keys, owned or [{"batch": batch}])

    def _current(self, df: DataFrame, done: int) -> DataFrame:
        """``party_id`` and ``since`` of the party that a stored one has been merged into, if it has."""
        aliases = self._stored("aliases", done).select("party_id", "into", F.col("since").alias("_since"))
        return df.join(aliases, "party_id", "left").withColumns({
            "party_id": F.coalesce("into", "party_id"), "since": F.coalesce("_since", "since")}).drop("into", "_since")

    def _postings(self, sets: DataFrame) -> DataFrame:
        """Where sets are looked up: for every size of partner, as the smaller or the larger one, by their rare tokens."""
        m = F.size("ranked")
        overlap = F.floor(((F.col("small") + F.col("large")) * self.pct + 99 + self.pct) / (100 + self.pct)).cast("int")

        def side(smaller: bool, own: str, partner: str, least: Column, most: Column) -> DataFrame:
            sized = sets.withColumn(own, m).withColumn(partner, F.explode(F.sequence(least, most)))
            return sized.withColumn("token", F.explode(F.slice("ranked", 1, m - overlap + 1))).withColumn("smaller", F.lit(smaller))

        as_smaller = side(True, "small", "large", m, F.floor(m * 100 / self.pct).cast("int"))
        return as_smaller.unionByName(side(False, "large", "small", F.ceil(m * self.pct / 100).cast("int"), m)).withColumn(
            "bucket", F.pmod(F.xxhash64("block"), F.lit(BUCKETS)).cast("int"))

    def _links(self, new: DataFrame, done: int) -> DataFrame:
        """(a_id, b_id): each new name with the parties and new names that it is similar to."""
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # BUCKETS at most
        known = self._current(self._stored("index", done).where(F.col("bucket").isin(touched)).withColumn("since", F.lit(0)), done)
        known = known.withColumn("node", F.concat(F.lit("party:"), "party_id")).select(*[c for c in new.columns if c != "node"], "node")
        on = ["block", "small", "large", "token"]

        def met(a: DataFrame, b: DataFrame) -> DataFrame:
            a = a.where("smaller").select(*on, F.col("node").alias("a_id"), F.col("ranked").alias("_a"))
            b = b.where("not smaller").select(*on, F.col("node").alias("b_id"), F.col("ranked").alias("_b"))
            shared = F.size(F.array_intersect("_a", "_b"))
            either = F.size("_a") + F.size("_b") - shared
            return a.join(b, on).where((F.col("a_id") != F.col("b_id")) & (shared * 100 >= either * self.pct)).select("a_id", "b_id")

        return spanning_forest(met(new, new).unionByName(met(new, known)).unionByName(met(known, new)))

    def add(self, mentions: DataFrame, batch: str, name: str = "name", state: str = "state", role: str = "role") -> int:
        """Adds the mentions of one batch; the number of names that were new. A batch that was added before is skipped.

        Names without a compared form take part in nothing. If a run is lost, the same batch is added again: its tables
        are replaced, and count only once the batch is listed.
        """
        earlier = self.batches()
        if batch in earlier:
            return 0
        done, now = len(earlier), len(earlier) + 1
        key = text.match_name(F.col(name))
        members = mentions.select(key.alias("key"), F.trim(name).alias("spelling"), F.col(state).alias("state"), F.col(role).alias("role"))
        members = members.where(text.is_filled(F.col("key"))).withColumn("block", name_block(F.col("state"), F.col("key"), self.letters))
        members = stage(members.groupBy("block", "key", "spelling", "state", "role").agg(F.count(F.lit(1)).alias("n")), "party_members")
        names = self._stored("names", done)
        fresh = members.select("block", "key").distinct().join(names.select("block", "key"), ["block", "key"], "left_anti")
        fresh = stage(fresh.withColumn("node", F.concat(F.lit("name:"), text.hash_key(F.col("block"), F.col("key")))), "party_new")

        words = fresh.select("node", "block", F.explode(F.array_distinct(F.split("key", " "))).alias("token"))
        frequency = stage(words.groupBy("block", "token").agg(F.count(F.lit(1)).alias("_df")), "party_tokens")
        # the order of tokens never changes: a token weighs what it weighed when it was first seen
        weights = frequency.join(self._stored("tokens", done).drop("batch"), ["block", "token"], "left")
        weights = stage(weights.withColumn("_new", F.col("weight").isNull()).withColumn("weight", F.coalesce("weight", "_df")), "party_weights")
        weighed = salted_join(words, weights.select("block", "token", "weight", "_df"), ["block", "token"], "_df", ["node"], how="inner")
        ranked = weighed.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("weight", "token"))).alias("_t"))
        sets = fresh.select("node", "block").join(ranked.select("node", F.col("_t.token").alias("ranked")), "node")
        postings = stage(self._postings(sets), "party_postings")

        # equal forms are one party in all states: known ones by their party, new ones by the first of them
        by_key = fresh.join(names.select("key", "party_id", "since"), "key")
        by_key = self._current(by_key, done).select(F.col("node").alias("a_id"), F.concat(F.lit("party:"), "party_id").alias("b_id"))
        firsts = fresh.groupBy("key").agg(F.min("node").alias("b_id"))
        alike = fresh.join(firsts, "key").where("node <> b_id").select(F.col("node").alias("a_id"), "b_id")
        links = stage(self._links(postings, done).unionByName(by_key).unionByName(alike).distinct(), "party_links")

        # labels begin with the age, so that the smallest one of a group is its oldest party
        ages = self._current(names.select("party_id", "since").distinct(), done).distinct()
        ages = ages.select(F.concat(F.lit("party:"), "party_id").alias("id"), "since")
        touched = links.select(F.explode(F.array("a_id", "b_id")).alias("id")).where("id LIKE 'party:%'").distinct()
        aged = stage(touched.join(ages, "id"), "party_touched")

        def labelled(df: DataFrame, column: str) -> DataFrame:
            age = aged.select(F.col("id").alias(column), F.format_string("%08d:", "since").alias("_age"))
            return df.join(age, column, "left").withColumn(column, F.concat(F.coalesce("_age", F.lit("new:")), column)).drop("_age")

        pairs = labelled(labelled(links, "a_id"), "b_id")
        nodes = fresh.select(F.concat(F.lit("new:"), "node").alias("node")).unionByName(
            aged.select(F.concat(F.format_string("%08d:", "since"), "id").alias("node")))
        groups = stage(cluster(nodes, pairs), "party_groups")
        old = F.col("cluster").contains(":party:")
        party = F.substring_index("cluster", ":", -1)
        since = F.when(old, F.substring_index("cluster", ":", 1).cast("int")).otherwise(now)
        placed = groups.select(F.substring_index("node", ":", -1).alias("own"), party.alias("party_id"), since.alias("since"),
                               F.col("node").contains(":party:").alias("was"))
        added = fresh.withColumn("own", F.substring_index("node", ":", -1)).join(placed.where("not was").drop("was"), "own")
        added = stage(added.select("block", "key", "node", "party_id", "since"), "party_added")
        gone = placed.where("was and own <> party_id").select(F.col("own").alias("party_id"), F.col("party_id").alias("into"), "since")

        self._commit("names", added.drop("node"), now, ["batch"])
        self._commit("tokens", weights.where("_new").select("block", "token", "weight"), now, ["batch"])
        index = postings.join(added.select("node", "party_id"), "node").select(
            "block", "small", "large", "smaller", "token", "ranked", "party_id", "bucket")
        self._commit("index", index, now, ["batch", "bucket"])
        self._commit("members", members, now, ["batch"])
        before = self._stored("aliases", done).select("party_id", "into", "since")
        later = gone.select(F.col("party_id").alias("into"), F.col("into").alias("_into"), F.col("since").alias("_since"))
        moved = before.join(later, "into", "left").select(
            "party_id", F.coalesce("_into", "into").alias("into"), F.coalesce("_since", "since").alias("since"))
        # the aliases of the batch before stay until this one counts
        kept = [{"batch": b} for b in range(max(1, now - 2), now + 1) if b != now - 1]
        self._commit("aliases", moved.unionByName(gone), now, ["batch"], kept)
        listed = self.spark.createDataFrame([(batch,)], "name string")
        self._commit("batches", listed, now, ["batch"])
        return fresh.count()

    def aliases(self) -> DataFrame:
        """(party_id, into): every id that has been merged, with the one that lives."""
        return self._stored("aliases", len(self.batches())).select("party_id", "into")

    def names(self) -> DataFrame:
        """(block, key, party_id): every name with its party of today."""
        done = len(self.batches())
        return self._current(self._stored("names", done).drop("batch"), done).select("block", "key", "party_id")

    def resolve(self, records: DataFrame, name: str, state: str, into: str = "party_id") -> DataFrame:
        """``records`` with the party of a name; null where the registry does not know it."""
        keyed = records.withColumn("_key", text.match_name(F.col(name)))
        keyed = keyed.withColumn("_block", name_block(F.col(state), F.col("_key"), self.letters))
        known = self.names().select(F.col("block").alias("_block"), F.col("key").alias("_key"), F.col("party_id").alias(into))
        weights = keyed.groupBy("_block", "_key").agg(F.count(F.lit(1)).alias("_rows"))
        rows = [F.xxhash64(*keyed.columns).alias("_row")]
        spread = keyed.select("*", *rows)
        return salted_join(spread, known.join(weights, ["_block", "_key"]), ["_block", "_key"], "_rows", ["_row"]).drop("_block", "_key", "_rows", "_row")

    def master(self) -> DataFrame:
        """One row per party: its most frequent spelling, all spellings and states, and how often it appears in each role."""
        members = self._stored("members", len(self.batches())).join(self.names(), ["block", "key"])
        return master(members.groupBy("party_id", "spelling", "state", "role").agg(F.sum("n").alias("n")))

    def compact(self) -> None:
        """Bring what earlier batches wrote together in the partition of the last one, so that reads open fewer files."""
        done = len(self.batches())
        if done < 2:
            return
        owned = [{"batch": b} for b in range(1, done + 1)]
        for table, keys in (("names", ["batch"]), ("tokens", ["batch"]), ("index", ["batch", "bucket"]), ("members", ["batch"])):
            rows = stage(self._stored(table, done).drop("batch"), f"party_{table}")
            sort = ["block", "token"] if table == "index" else ["block"]
            self._commit(table, rows.sortWithinPartitions(*sort), done, keys, owned)
