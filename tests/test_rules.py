"""Checks, tiers, segments and mappings on the small frames the rules are specified with."""

import pytest
from pyspark.sql import functions as F

from lamella.functions import scoring, text
from lamella.operators import quality as q
from lamella.operators.mapping import code_rows
from lamella.plans.courts import (
    CASE_STATUSES, CASE_TYPE_CODES, CASE_TYPES, COURTS, FEDERAL, NATURE_OF_SUIT, STATES, STATUS_CODES,
)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a", "active", 85), (2, "b", "active", 92), (3, None, "inactive", 45), (4, "d", "active", 101),
            (5, "e", "unknown", 73)]
    return spark.createDataFrame(rows, "id long, name string, status string, score long")


def outcome(df, *checks):
    return {r["check_name"]: (r["records_failed"], r["status"]) for r in q.run_suite(df, list(checks), "b", "t").collect()}


def test_checks(people):
    got = outcome(
        people, q.not_null("id"), q.not_null("name", 100.0), q.unique("id"),
        q.accepted_values("status", ["active", "inactive"], 100.0), q.in_range("score", 0, 100, 100.0), q.not_null("gone"),
    )
    assert got == {
        "not_null_id": (0, "PASS"), "not_null_name": (1, "WARN"), "unique_id": (0, "PASS"),
        "accepted_values_status": (1, "WARN"), "range_score": (1, "WARN"), "not_null_gone": (5, "FAIL"),
    }


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,)], "id long")
    assert outcome(df, q.unique("id")) == {"unique_id": (2, "FAIL")}


def test_null_counts_once_when_asked(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "id long")
    assert outcome(df, q.unique("id"))["unique_id"][0] == 2
    assert outcome(df, q.unique("id", null_counts=True))["unique_id"][0] == 1


def test_empty_table_passes(people):
    assert outcome(people.where("id > 9"), q.not_null("id", 100.0), q.unique("id")) == {
        "not_null_id": (0, "PASS"), "unique_id": (0, "PASS")}


def test_warning_severity_does_not_stop(people):
    bad = q.accepted_values("status", ["x"], 100.0)
    with pytest.raises(q.GateFailed):
        q.enforce(q.run_suite(people, [bad], "b", "t"))
    soft = q.accepted_values("status", ["x"], 100.0, severity=q.WARN)
    q.enforce(q.run_suite(people, [soft], "b", "t"))


def test_tiers(spark):
    cases = {5000: "platinum", 10000: "platinum", 1000: "gold", 4999.99: "gold", 250: "silver", 999.99: "silver",
             0: "bronze", 249.99: "bronze", -100: "bronze"}
    df = spark.createDataFrame([(float(v), t) for v, t in cases.items()], "v double, want string")
    assert df.where(scoring.ltv_tier(F.col("v")) != F.col("want")).count() == 0


def first_rule(r, f, m):
    rules = [(r >= 4 and f >= 4 and m >= 4, "Champions"), (r >= 4 and f >= 3, "Loyal"), (r >= 4 and f <= 2, "New Customers"),
             (r >= 3 and f >= 2 and m >= 2, "Potential Loyalists"), (r <= 2 and f >= 3, "At Risk"),
             (r <= 2 and f <= 2 and m <= 2, "Lost"), (r == 3 and f <= 2, "About to Sleep"),
             (r <= 2 and f >= 2 and m >= 3, "Cant Lose Them")]
    return next((name for ok, name in rules if ok), "Other")


def test_segments_for_every_score(spark):
    rows = [(r, f, m, first_rule(r, f, m)) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "r int, f int, m int, want string")
    assert df.where(scoring.rfm_segment(F.col("r"), F.col("f"), F.col("m")) != F.col("want")).count() == 0


def test_mappings():
    required = {"case_number", "filing_date", "case_type_raw", "case_status_raw"}
    for court in COURTS:
        assert required <= set(court.fields)
        assert len(set(court.fields)) == len(court.fields)
        assert (court.county is None) != ("county" not in court.fields)
    for codes, taxonomy in ((CASE_TYPE_CODES, CASE_TYPES), (STATUS_CODES, CASE_STATUSES)):
        rows = code_rows(codes)
        assert {canon for _, _, canon in rows} <= set(taxonomy)
        assert {state for state, _, _ in rows} == {c.state for c in COURTS}
        keys = [(state, raw) for state, raw, _ in rows]
        assert len(keys) == len(set(keys)), "a code means one thing per court"


def test_federal_codes():
    codes = [c for group in NATURE_OF_SUIT.values() for c in group]
    assert len(codes) == len(set(codes)), "a code means one thing"
    assert set(NATURE_OF_SUIT) <= set(CASE_TYPES) and set(STATES) == {c.state for c in COURTS} | {FEDERAL.state}


def test_entity_words_are_whole_words(spark):
    cases = {"Nicole Vincent": False, "Vincent Banks": False, "ACME INC": True, "Acme Co. of Ohio": True, "Acme Co.": True,
             "First Bank, N.A.": True, "Groupe Dupont": False, "Smith Partners": True}
    df = spark.createDataFrame(list(cases.items()), "n string, want boolean")
    assert df.where(text.is_entity(F.col("n")) != F.col("want")).collect() == []


def test_names(spark):
    df = spark.createDataFrame([("  JOHN   DOE ",), ("Bank of  America",), ("Acme, LLC",), ("Smith et al",)], "n string")
    got = [tuple(r) for r in df.select(text.display_name(F.col("n")), text.match_name(F.col("n"))).collect()]
    assert got == [("John Doe", "john doe"), ("Bank of America", "bank of america"), ("Acme, LLC", "acme"),
                   ("Smith Et Al", "smith")]


def test_dates_and_amounts(spark):
    from lamella.functions import dates, numbers

    cases = [("MM/dd/yyyy", "01/15/2025"), ("yyyy-MM-dd", "2025-01-15"), ("yyyyMMdd", "20250115"),
             ("dd-MMM-yyyy", "15-Jan-2025"), ("M/d/yyyy", "1/15/2025")]
    df = spark.createDataFrame(cases + [("M/d/yyyy", "2/30/2025"), ("yyyyMMdd", "INVALID"), ("yyyyMMdd", "")], "f string, t string")
    got = [str(r[0]) for r in df.select(dates.parse_date_by(F.col("t"), F.col("f"), [c[0] for c in cases])).collect()]
    assert got == ["2025-01-15"] * 5 + ["None"] * 3
    money = spark.createDataFrame([("$1,234.50",), ("-12.5",), ("",), ("abc",), ("0.00",)], "a string")
    got = [str(r[0]) for r in money.select(numbers.amount(F.col("a"))).collect()]
    assert got == ["1234.50", "-12.50", "None", "None", "0.00"]
    assert money.where(numbers.amount(F.col("a"), True).isNotNull()).count() == 2


def test_exact_halves_round_up(spark):
    from lamella.functions import numbers

    df = spark.createDataFrame([(1, 8, 0.13), (-1, 8, -0.13), (5, 1000, 0.01), (0, 3, 0.0), (2, 0, None)], "n long, d long, want double")
    wrong = df.where(~numbers.ratio(F.col("n"), F.col("d"), 2).eqNullSafe(F.col("want")))
    assert wrong.collect() == []
