"""Distributed operators against brute force, with hot keys, ties and nulls."""

import datetime as dt
import random
from itertools import combinations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lamella.operators import dedupe, linkage, rank, scd, similarity, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, and another third one group."""
    rnd = random.Random(7)
    rows = []
    for i in range(1500):
        value = 10 if i % 3 == 0 else rnd.randint(0, 400)
        group = "hot" if i % 3 == 1 else f"g{rnd.randint(0, 9)}"
        rows.append((f"id{i:05d}", group, value))
    return spark.createDataFrame(rows, "id string, grp string, v long").repartition(6)


def test_global_rank(skewed):
    got = rank.global_rank(skewed, [F.col("v"), F.col("id")], "r").toPandas().sort_values("r")
    want = skewed.toPandas().sort_values(["v", "id"])
    assert got["r"].tolist() == list(range(1, 1501))
    assert got["id"].tolist() == want["id"].tolist()


def test_percent_rank(skewed):
    got = rank.percent_rank(skewed, "v", "id", "p").toPandas().set_index("id")["p"]
    v = skewed.toPandas().set_index("id")["v"]
    want = (v.rank(method="min") - 1) / (len(v) - 1)
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_percent_rank_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else float(i % 5)) for i in range(60)], "id long, v double")
    want = df.selectExpr("id", "percent_rank() OVER (ORDER BY v) AS p").orderBy("id").collect()
    for parts in (2, 3, 64):
        got = rank.percent_rank(df, "v", "id", "p", parts).select("id", "p").orderBy("id").collect()
        assert got == want
    assert rank.percent_rank(df.limit(1), "v", "id", "p").first()["p"] == 0.0
    assert rank.percent_rank(df.limit(0), "v", "id", "p").count() == 0


def test_selection_sorts_no_table(skewed):
    for df in (rank.percent_rank(skewed, "v", "id", "p"), rank.exact_median(skewed, ["grp"], "v", "id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan  # sorts inside a join or window partition only


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 1000, 1001, 5000])
def test_median_of_odd_groups(spark, rows):
    """Groups with null keys, ties, decimals of both signs, zero and a hot value."""
    df = spark.range(rows).selectExpr(
        "id", "IF(id % 10 = 3, NULL, id % 2) AS g", "'x' AS h",
        "CAST(IF(id % 3 = 0, 7, ((id * 7919) % 1000 - 500) / 4.0) AS decimal(18,2)) AS v").repartition(5)
    want = {r.g: r.m for r in df.groupBy("g").agg(F.expr("CAST(median(v) AS double) AS m")).collect()}
    got = rank.exact_median(df, ["g", "h"], "v", "id", "m").collect()
    assert {r.g: r.m for r in got} == pytest.approx(want) and {r.h for r in got} == {"x"}


def test_cells_keep_the_order(spark):
    """Around powers of two too, where logarithms are rounded."""
    near = sorted({s * 2.0**e * f for e in range(-40, 60) for f in (1 - 2**-52, 1, 1 + 2**-52, 1.3) for s in (-1, 1)} | {0.0, 5e-324, -5e-324, 1e308})
    cells = [r.c for r in spark.createDataFrame([(x,) for x in near], "v double").select("v", rank._magnitude(F.col("v")).alias("c")).orderBy("v").collect()]
    assert cells == sorted(cells) and len(set(cells)) > 300


@pytest.mark.parametrize("n", [5, 6, 7, 13, 20, 101])
def test_quintiles_as_pandas(spark, n):
    rnd = random.Random(n)
    pdf = pd.DataFrame({"id": [f"c{i:04d}" for i in range(n)], "a": [rnd.randint(0, 5) for _ in range(n)]})
    df = spark.createDataFrame(pdf)
    cuts = rank.quantile_cuts(df, "id", ["a"])
    got = df.withColumn("q", rank.quantile_of("a", "id", cuts["a"])).toPandas().sort_values("id")["q"].tolist()
    ordered = pdf.sort_values("id")
    want = pd.qcut(ordered["a"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_too_few_rows_for_quintiles(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v long")
    assert rank.quantile_cuts(df, "id", ["v"]) is None


def test_exact_median(skewed):
    got = rank.exact_median(skewed, ["grp"], "v", "id", "m").toPandas().set_index("grp")["m"].sort_index()
    want = skewed.toPandas().groupby("grp")["v"].median().sort_index()
    pd.testing.assert_series_equal(got, want, check_names=False)


def test_salted_join(skewed):
    with_null = skewed.withColumn("grp", F.when(F.col("v") != 11, F.col("grp")))
    stats = with_null.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    for how in ("left", "inner"):
        got = skew.salted_join(with_null, stats, ["grp"], "n", ["id"], how)
        want = with_null.join(stats, "grp", how)
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_key_is_split(skewed):
    stats = skewed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    plan = skew.salted_join(skewed, stats, ["grp"], "n", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "xxhash64" in plan


def test_lookback(spark):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"k{rnd.randint(0, 5)}", start + dt.timedelta(hours=rnd.randint(0, 3000)), i) for i in range(400)]
    rows += [("edge", start, 1000), ("edge", start + dt.timedelta(days=7), 1001), ("edge", start + dt.timedelta(days=14, seconds=1), 1002)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id long")
    got = {r["id"] for r in dedupe.latest_in_lookback(df, ["k"], "ts", 7, ["id"]).collect()}
    want = set()
    for key in {r[0] for r in rows}:
        chain = sorted((r[1], r[2]) for r in rows if r[0] == key)
        for (t, i), nxt in zip(chain, chain[1:] + [None]):
            if nxt is None or nxt[0] - t > dt.timedelta(days=7):
                want.add(i)
    assert got == want


def test_latest_prunes_before_the_shuffle(skewed):
    plan = dedupe.latest(skewed, ["grp"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    top = dedupe.top_per_group(skewed, ["grp"], [F.col("v").desc(), F.col("id")], 3)
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_scd2(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = [("a", "x", day(1)), ("a", "x", day(2)), ("a", "y", day(3)), ("a", "x", day(5)), ("b", None, day(1)), ("b", None, day(4))]
    history = spark.createDataFrame(rows, "k string, v string, d date")
    built = scd.scd2_build(history, ["k"], ["v"], "d")
    end = dt.date(9999, 12, 31)
    want = [("a", "x", day(1), day(3), False), ("a", "x", day(5), end, True), ("a", "y", day(3), day(5), False), ("b", None, day(1), end, True)]
    assert sorted(tuple(r)[:5] for r in built.collect()) == want
    late = spark.createDataFrame([("a", "z", day(4))], "k string, v string, d date")
    merged = scd.scd2_merge(built, late, ["k"], ["v"], "d")
    spans = sorted(tuple(r)[1:4] for r in merged.where("k = 'a'").collect())
    assert spans == [("x", day(1), day(3)), ("x", day(5), end), ("y", day(3), day(4)), ("z", day(4), day(5))]
    again = scd.scd2_merge(merged, late, ["k"], ["v"], "d")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_nearest_by_key(spark):
    rnd = random.Random(5)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
    targets = [(rnd.choice("abc"), day(), i) for i in range(40)]
    probes = [(rnd.choice("abcd"), day()) for _ in range(60)]
    got = linkage.nearest_by_key(
        spark.createDataFrame(probes, "k string, pd date"), spark.createDataFrame(targets, "k string, td date, id long"),
        ["k"], "pd", "td", "id")
    got = {(r["k"], r["pd"]): r["id"] for r in got.collect()}
    want = {}
    for k, p in set(probes):
        best = min(((abs((p - t).days), i) for kk, t, i in targets if kk == k), default=None)
        if best:
            want[k, p] = best[1]
    assert got == want


def test_near_by_amount_and_day(spark):
    from decimal import Decimal

    rnd = random.Random(9)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 300))
    money = lambda: Decimal(rnd.choice([0, 100, 100, 101, 99, 1000, 1010, 990, 985])) + Decimal(rnd.randint(0, 3)) / 100
    targets = [(rnd.choice([1, 1, 2]), money(), day(), i) for i in range(150)]
    probes = [(rnd.choice([1, 1, 2, 3]), money(), day()) for _ in range(150)]
    got = linkage.near_by_amount_and_day(
        spark.createDataFrame(probes, "k long, pa decimal(18,2), pd date"),
        spark.createDataFrame(targets, "k long, ta decimal(18,2), td date, id long"), "k", "pa", "pd", "ta", "td", "id")
    got = {(r["k"], r["pa"], r["pd"]): r["id"] for r in got.collect()}
    want = {}
    for k, a, p in set(probes):
        fits = [((p - t).days, i) for kk, ta, t, i in targets
                if kk == k and abs(a - ta) * 100 <= ta and 0 <= (p - t).days <= 90]
        if fits:
            want[k, a, p] = min(fits)[1]
    assert got == want and got


def test_similar_pairs_miss_nothing(spark):
    rnd = random.Random(11)
    vocabulary = ["abc", "abd", "red", "blue", "corp", "north", "south", "first", "bank"]
    names = [" ".join(["abc", *rnd.sample(vocabulary, rnd.randint(1, 5))]) for _ in range(120)]
    df = spark.createDataFrame([(i, "TX", n) for i, n in enumerate(names)], "id long, st string, n string")
    distinct = similarity.distinct_names(df, "id", "n", "st")
    got = {(r["a_id"], r["b_id"], r["decision"]) for r in similarity.similar_pairs(distinct).collect()}
    rows = [(r["node"], set(r["tokens"])) for r in distinct.collect()]
    want = set()
    for (i, a), (j, b) in combinations(sorted(rows, key=lambda r: r[0]), 2):
        s, u = len(a & b), len(a | b)
        if s * 100 >= u * 40:
            want.add((i, j, "MERGE" if s * 100 >= u * 60 else "REVIEW"))
    assert got == want and len(want) > 100


def test_two_token_names_do_not_meet_on_a_common_token(spark):
    """20,000 names of one block share a token; only names that are similar become pairs."""
    many = [(i, "TX", f"john x{i}") for i in range(20_000)] + [(20_000, "TX", "john"), (20_001, "TX", "john x7 x8")]
    distinct = similarity.distinct_names(spark.createDataFrame(many, "id long, st string, n string"), "id", "n", "st")
    got = similarity.similar_pairs(distinct, merge_pct=60, review_pct=60).select("a_id", "b_id").collect()
    assert {tuple(r) for r in got} == {(7, 20_001), (8, 20_001)}


def test_names_meet_across_states(spark):
    rows = [(1, "TX", "First Bank Inc"), (2, "CA", "FIRST BANK"), (3, "CA", "Other Name")]
    parties = similarity.party_master(spark.createDataFrame(rows, "id long, st string, n string"), "id", "n", "st")
    assert {r["cluster"]: r["states_appeared"] for r in parties.collect()} == {1: ["CA", "TX"], 3: ["CA"]}


def test_judgments_link_inside_their_court(spark):
    from lamella.plans import public_records

    suits = spark.createDataFrame(
        [("s1", "TX", "A", "2020-1"), ("s2", "TX", "B", "2020-1"), ("s3", "TX", "A", "2020-2")],
        "suit_id string, state_code string, county string, case_number string")
    judgments = spark.createDataFrame(
        [(1, "TX", "A", "2020-1"), (2, "TX", None, "2020-1"), (3, "TX", None, "2020-2"), (4, "TX", "C", "2020-2"), (5, "TX", "A", None)],
        "judgment_key long, state_code string, county string, case_number string")
    got = public_records.link_suit_judgment(suits, judgments).collect()
    assert sorted((r["judgment_key"], r["suit_id"]) for r in got) == [(1, "s1"), (2, None), (3, "s3"), (4, None), (5, None)]


def test_hash_keys_of_different_lists_differ(spark):
    from pyspark.sql import functions as F

    from lamella.functions import text

    lists = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("∅", "c"), ("", "c"), ("1:a", "c")]
    keys = spark.createDataFrame(lists, "x string, y string").select(text.hash_key(F.col("x"), F.col("y")).alias("k")).collect()
    assert len({r["k"] for r in keys}) == len(lists)


def test_clusters(spark):
    """A long chain, a star, a separate pair and a node alone."""
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    edges = chain + star + [(200, 201)]
    nodes = sorted({n for e in edges for n in e} | {300})
    got = similarity.cluster(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a_id long, b_id long"))
    got = {r["node"]: r["cluster"] for r in got.collect()}
    assert got == {n: 0 if n <= 60 else 100 if n < 200 else 200 if n < 300 else 300 for n in nodes}


def test_an_order_that_moves_counts_for_neither_twice(spark):
    from lamella.plans import commerce

    schema = "order_id string, customer_id string, order_date string, status string, total_amount decimal(18,2)"

    def orders(*rows):
        made = spark.createDataFrame([(o, c, "2024-01-01", "completed", None) for o, c in rows], schema)
        return made.withColumns({"order_date": F.col("order_date").cast("date"), "total_amount": F.lit(5).cast("decimal(18,2)")})

    before, after = orders(("o1", "A"), ("o2", "A"), ("o3", "C"), ("o4", "D")), orders(("o1", "B"), ("o2", "A"), ("o3", "B"), ("o4", "D"))
    options = {"reference_date": "2024-02-01"}
    previous = commerce.customer_order_metrics(before, **options)
    changed = orders(("o1", "B"), ("o3", "B"))
    got = commerce.refresh_order_metrics(previous, before, after, changed, **options)
    want = commerce.customer_order_metrics(after, **options)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), "C has no orders left and goes"


def _parquet(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_courts_are_read_once_a_row(spark, tmp_path):
    """Suits and judgments link with and without courts, and no filter runs the patterns of the court's name again."""
    from lamella.plans import public_records

    suits = _parquet(spark, tmp_path / "s", [
        ("s1", "TX", "Harris County", "1"), ("s2", "TX", None, "2"), ("s3", "TX", "Travis", "3"), ("s4", "TX", "Harris", "3"),
        ("s5", "TX", "--", "4"), ("s6", "TX", None, None)], "suit_id string, state_code string, county string, case_number string")
    judgments = _parquet(spark, tmp_path / "j", [
        (1, "TX", "HARRIS", "1"), (2, "TX", None, "2"), (3, "TX", None, "3"), (4, "TX", "Travis County", "3"), (5, "TX", "", "4"),
        (6, "TX", "Harris", "2"), (7, "TX", None, None), (8, None, "Harris", "1")],
        "judgment_key int, state_code string, county string, case_number string")
    linked = public_records.link_suit_judgment(suits, judgments)
    assert {r.judgment_key: r.suit_id for r in linked.collect()} == {
        1: "s1", 2: "s2", 3: None, 4: "s3", 5: "s5", 6: None, 7: None, 8: None}
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_replace" in line]


def test_salted_join_works_out_its_right_side_once(spark, tmp_path):
    facts = _parquet(spark, tmp_path / "f", [(i, i % 3) for i in range(30)], "id int, grp int")
    stats = facts.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    joined = skew.salted_join(facts, stats, ["grp"], "n", ["id"])
    assert {(r.id, r.n) for r in joined.collect()} == {(i, 10) for i in range(30)}
    assert "count(1)" not in joined._jdf.queryExecution().optimizedPlan().toString()
