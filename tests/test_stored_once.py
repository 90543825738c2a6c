"""What the views of suits and parties read and store on the way, on rows made here."""

import pytest
from pyspark.sql import functions as F

import catalog
from catalog import public, records as court
from lamella.plans import public_records as pr
from lamella.plans import records


@pytest.fixture
def tables(spark, tmp_path):
    """Twelve customers with five orders each, two nations and two suppliers."""
    made = {
        "nation": spark.range(2).selectExpr("cast(id AS int) AS n_nationkey", "concat('NATION', id) AS n_name"),
        "customer": spark.range(12).selectExpr(
            "id AS c_custkey", "concat('Customer#', id) AS c_name", "cast(id % 2 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        "orders": spark.range(1, 61).selectExpr(
            "id AS o_orderkey", "id % 12 AS o_custkey", "IF(id % 2 = 0, 'F', 'O') AS o_orderstatus", "id * 100.5D AS o_totalprice",
            "cast(date '1995-01-01' + cast(id AS int) AS timestamp) AS o_orderdate"),
        "supplier": spark.range(2).selectExpr("id AS s_suppkey", "cast(0 AS int) AS s_nationkey", "1.0D AS s_acctbal"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def stored(monkeypatch):
    """Names and columns of the tables that the queries store."""
    seen = {}
    for module in (court, public):
        def spy(df, name, *more, _real=module.stage):
            seen[name] = set(df.columns)
            return _real(df, name, *more)

        monkeypatch.setattr(module, "stage", spy)
    return seen


@pytest.mark.parametrize("name", ["judgment_best_view", "xref_chain"])
def test_suits_behind_judgments_are_not_stored(spark, tables, stored, name):
    found = catalog.QUERIES[name](spark, tables)
    assert found.where("suit_id IS NOT NULL").count() == 30 and "suits" not in stored


def test_full_best_view_stores_only_what_it_reads(spark, tables, stored):
    found = catalog.QUERIES["suit_best_view_full"](spark, tables)
    assert found.where("has_judgment AND lien_count = 1").count() == 30 and found.count() == 60
    assert {"parties", "best"}.isdisjoint(stored) and "judge_name" not in stored["suits"]


def test_party_views_store_only_what_they_read(spark, tables, stored):
    assert catalog.QUERIES["party_best_view"](spark, tables).count() == 130 and "suits" not in stored
    assert "attorney_name" not in stored["parties"]
    assert catalog.QUERIES["frequent_litigants"](spark, tables).where("total_appearances < 10").count() == 0
    assert "judge_name" not in stored["suits"] and "is_entity" not in stored["parties"]


def test_suits_are_read_once_for_judgments_with_and_without_court(spark, tmp_path):
    rows = [("a1", "TX", "Harris County", "7"), ("b1", "TX", "Dallas", "7"), ("b2", "TX", "Dallas", "8"), ("n1", "TX", None, "9"),
            ("n2", "TX", " ", "10"), ("c1", "CA", "Kings", "7")]
    spark.createDataFrame(rows, "suit_id string, state_code string, county string, case_number string").write.parquet(f"{tmp_path}/suits")
    asked = [(1, "TX", "HARRIS", "7", "a1"), (2, "TX", None, "7", None), (3, "TX", None, "8", "b2"), (4, "TX", "Dallas", "7", "b1"),
             (5, "TX", "Harris", "9", None), (6, "TX", None, "9", "n1"), (7, "TX", "", "10", "n2"), (8, "CA", None, "7", "c1"),
             (9, "TX", None, None, None)]
    judgments = spark.createDataFrame(asked, "judgment_key long, state_code string, county string, case_number string, want string")
    linked = pr.link_suit_judgment(spark.read.parquet(f"{tmp_path}/suits"), judgments)
    assert linked.where(~F.col("suit_id").eqNullSafe(F.col("want"))).collect() == [] and linked.count() == 9
    assert linked._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_parties_are_listed_without_functions_on_arrays(spark):
    party = "array<struct<name:string,attorney:string>>"
    rows = [("s1", [("Ann", "x"), (" ", None), ("Bob Bank", None)], [("Cid", None)]), ("s2", None, [("Dee", "y"), ("Eve", None)]), ("s3", [], None)]
    found = records.extract_parties(spark.createDataFrame(rows, f"suit_id string, plaintiffs {party}, defendants {party}"))
    assert [tuple(r) for r in found.select("party_id", "party_type", "sequence", "party_name", "is_entity", "attorney_name").orderBy("party_id").collect()] == [
        ("s1_DEFENDANT_1", "DEFENDANT", 1, "Cid", False, None), ("s1_PLAINTIFF_1", "PLAINTIFF", 1, "Ann", False, "x"),
        ("s1_PLAINTIFF_3", "PLAINTIFF", 3, "Bob Bank", True, None), ("s2_DEFENDANT_1", "DEFENDANT", 1, "Dee", False, "y"),
        ("s2_DEFENDANT_2", "DEFENDANT", 2, "Eve", False, None)]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_of_uneven_keys_stores_nothing(spark, monkeypatch):
    from lamella.operators import skew

    monkeypatch.setattr(skew, "stage", lambda *_: pytest.fail("stored"))
    left = spark.range(4000).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL WHEN id < 3000 THEN 'hot' ELSE concat('k', id % 900) END AS key")
    right = spark.createDataFrame([("hot", 1), ("k5", 2), ("k5", 3), (None, 4)], "key string, v int")
    found = skew.salted_lookup(left, right, ["key"], ["id"])
    assert sorted(map(str, found.collect())) == sorted(map(str, left.join(right, "key", "left").collect()))
    empty = skew.salted_lookup(left.where("false"), right, ["key"], ["id"])
    assert empty.columns == ["key", "id", "v"] and empty.count() == 0
