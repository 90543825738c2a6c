"""Suits, judgments and liens together: expiry, chains, best views, party profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import dates, numbers
from lamella.operators.linkage import near_by_amount_and_day, nearest_by_key
from lamella.operators.mapping import inline_table
from lamella.operators.skew import left_join_filled, place
from lamella.plans.court_names import with_court
from lamella.plans.courts import STATES
from lamella.staging import stage

# How long a lien lasts, in months plus days, by type; states may override a type.
LIEN_DURATIONS = {"JUDGMENT": (120, 0), "FEDERAL_TAX": (120, 30), "UCC": (60, 0)}
LIEN_DURATIONS_BY_STATE = {
    ("CA", "JUDGMENT"): (120, 0),
    ("TX", "JUDGMENT"): (120, 0),
    ("NY", "JUDGMENT"): (120, 0),
    ("FL", "JUDGMENT"): (120, 0),
}

# Risk points, a rule of ours: the source names the score but gives no formula.
RISK_WEIGHTS = {"unsatisfied_judgments": 10, "active_liens": 5, "suits_as_defendant": 2}
RISK_LIMIT = 100
RISK_BANDS = [("low", 20), ("medium", 50)]


def lien_rules(spark: SparkSession) -> DataFrame:
    """Duration per state and lien type, a table fixed by configuration."""
    rows = []
    for kind, (months, days) in LIEN_DURATIONS.items():
        for state in STATES:
            m, extra = LIEN_DURATIONS_BY_STATE.get((state, kind), (months, days))
            rows.append((state, kind, m, extra))
    return inline_table(spark, rows, ["state_code", "lien_type", "months", "extra_days"])


def judgment_id(state: Column, case: Column, day: Column) -> Column:
    return F.concat_ws("_", state, case, day.cast("string"))


def lien_id(kind: Column, state: Column, number: Column) -> Column:
    return F.concat_ws("_", kind, state, number)


def lien_expiration(liens: DataFrame, rules: DataFrame, reference_date: str) -> DataFrame:
    """Expiration date by rule and whether the lien still counts. Liens without a rule never expire."""
    ref = F.lit(reference_date).cast("date")
    ends = F.date_add(F.add_months("filing_date", F.col("months").cast("int")), F.col("extra_days").cast("int"))
    active = (F.col("lien_status") == "ACTIVE") & F.coalesce(F.col("expiration_date") > ref, F.lit(True))
    return (
        liens.join(rules, ["state_code", "lien_type"], "left")
        .withColumn("expiration_date", ends)
        .drop("months", "extra_days")
        .withColumn("is_active", active)
    )


def _with_court_text(df: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """``with_court``, and empty text for a missing court."""
    return with_court(df, aliases).withColumn("_court", F.coalesce("_court", F.lit("")))


def _suit_candidates(suits: DataFrame, judgments: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Judgments with ``suit_id`` and ``_suits``, the number of suits that fit; the suit is null unless it is one.

    Judgments without a court look for the number in the whole state, which is the court of empty text: every suit is there
    and in its own court, so that one reading of the suits, one aggregate and one join do for both. The patterns of the
    court's name run once a row, where a test for null would run them again in the filters that Spark derives from it.
    """
    on = ["_place", "state_code", "_court", "case_number"]

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_place", place(*on[1:]))

    named = _with_court_text(suits.select("suit_id", "state_code", "county", "case_number"), aliases)
    whole = F.lit("")
    courts = F.when(F.col("_court") == whole, F.array(whole)).otherwise(F.array(whole, "_court"))
    both = named.withColumn("_court", F.explode(courts))
    counted = placed(both).groupBy(*on).agg(F.min("suit_id").alias("suit_id"), F.count(F.lit(1)).alias("_suits"))
    fits = counted.withColumn("suit_id", F.when(F.col("_suits") == 1, F.col("suit_id")))
    joined = left_join_filled(placed(_with_court_text(judgments, aliases)), fits, on)
    return joined.withColumn("_court", F.nullif("_court", F.lit(""))).select(*judgments.columns, "_court", "suit_id", "_suits")


def link_suit_judgment(suits: DataFrame, judgments: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Every judgment, once, with the suit of its state, court (county) and case number.

    Courts of a state use the same case numbers. Spellings of a court are one ("HARRIS", "Harris County"), other names are
    looked up in ``aliases``. A judgment without a county links if its number occurs in the state once only; where several
    suits fit, the suit stays null and ``unlinked_judgments`` says why.
    """
    return _suit_candidates(suits, judgments, aliases).drop("_court", "_suits")


def unlinked_judgments(suits: DataFrame, judgments: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Every judgment that links to no suit, with the reason: for review, so that none is lost without a trace."""
    courts = _with_court_text(suits.select("state_code", "county").distinct(), aliases).select("state_code", "_court").distinct()
    open_ones = stage(_suit_candidates(suits, judgments, aliases).where("suit_id is null").drop("suit_id"), "unlinked")
    placed = left_join_filled(open_ones, courts.withColumn("_known", F.lit(True)), ["state_code", "_court"])
    reason = (
        F.when(F.col("case_number").isNull(), "NO_CASE_NUMBER").when(F.col("_suits") > 1, "SEVERAL_SUITS")
        .when(F.col("_court").isNotNull() & F.col("_known").isNull(), "UNKNOWN_COURT").otherwise("NO_SUIT"))
    return placed.select(*judgments.columns, F.coalesce("_suits", F.lit(0)).alias("suits_that_fit"), reason.alias("reason"))


def link_judgment_lien(judgments: DataFrame, liens: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Each lien with its judgment and how sure that is.

    HIGH: same state and case number, nearest in time; of the same court if there is such a judgment and both tables have
    counties, since courts of a state use the same numbers. MEDIUM, tried only for liens without such a match:
    same debtor, amount within 1 %, at most 90 days after the judgment. Separate equality joins, because
    one join on "this or that" would compare every lien with every judgment.
    """
    columns = liens.columns
    by_court = "county" in columns and "county" in judgments.columns
    asked = with_court(liens, aliases) if by_court else liens
    cases = (with_court(judgments, aliases) if by_court else judgments).withColumnRenamed("case_number", "related_case_number")
    unlinked = asked.withColumn("judgment_key", F.lit(None).cast(judgments.schema["judgment_key"].dataType))
    for on in ([["state_code", "_court", "related_case_number"]] if by_court else []) + [["state_code", "related_case_number"]]:
        named = unlinked.where("related_case_number is not null and judgment_key is null")
        exact = nearest_by_key(named, cases, on, "filing_date", "judgment_date", "judgment_key").withColumnRenamed("judgment_key", "_found")
        key = [*on, "filing_date"]
        sides = [side.withColumn("_place", place(*key)) for side in (unlinked, exact)]
        filled = left_join_filled(*sides, ["_place", *key]).drop("_place")
        unlinked = stage(filled.withColumn("judgment_key", F.coalesce("judgment_key", "_found")).drop("_found"), "liens")
    tried = unlinked.select(*columns, "judgment_key")
    found = tried.where("judgment_key is not null").withColumn("confidence", F.lit("HIGH"))
    rest = tried.where("judgment_key is null").drop("judgment_key")
    near = near_by_amount_and_day(
        rest, judgments, "debtor_key", "lien_amount", "filing_date", "judgment_amount", "judgment_date", "judgment_key"
    )
    second = left_join_filled(rest, near, ["debtor_key", "lien_amount", "filing_date"]).withColumn(
        "confidence", F.when(F.col("judgment_key").isNotNull(), "MEDIUM").otherwise("UNLINKED")
    )
    return found.unionByName(second)


def xref_chain(suits: DataFrame, judgments: DataFrame, linked_liens: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Suit -> judgment -> lien: one row per lien of a judgment, or per judgment without liens."""
    with_suit = link_suit_judgment(suits, judgments, aliases).select("suit_id", "state_code", "judgment_key", "judgment_amount")
    liens = linked_liens.where("judgment_key is not null").select("judgment_key", "lien_id", "lien_amount", "confidence")
    return with_suit.join(liens, "judgment_key", "left")


def suit_best_view_full(
    best_view: DataFrame, judgments: DataFrame, linked_liens: DataFrame, aliases: DataFrame | None = None,
    suits: DataFrame | None = None,
) -> DataFrame:
    """Suit best view with its judgments and the liens that came from them.

    Judgments are linked to ``suits``, the suits behind the view; without them to the view, which is then read twice.
    """
    liens = linked_liens.where("judgment_key is not null").groupBy("judgment_key").agg(F.count(F.lit(1)).alias("liens"))
    per_suit = (
        link_suit_judgment(best_view if suits is None else suits, judgments, aliases).where("suit_id is not null").join(liens, "judgment_key", "left")
        .groupBy(place("suit_id").alias("_place"), "suit_id")
        .agg(F.sum("judgment_amount").alias("judgment_amount"), F.coalesce(F.sum("liens"), F.lit(0)).alias("lien_count"))
    )
    placed = best_view.withColumn("_place", place("suit_id"))
    return placed.join(per_suit, ["_place", "suit_id"], "left").drop("_place").withColumns({
        "has_judgment": F.col("judgment_amount").isNotNull(),
        "lien_count": F.coalesce("lien_count", F.lit(0)),
    })


def lien_best_view(
    linked: DataFrame, rules: DataFrame, judgments: DataFrame, suits: DataFrame, reference_date: str,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """One row per lien: active or not, age, the judgment and suit behind it."""
    origins = link_suit_judgment(suits, judgments, aliases).select("judgment_key", F.col("suit_id").alias("related_suit_id"))
    dated = lien_expiration(linked, rules, reference_date)
    return left_join_filled(dated, origins, ["judgment_key"]).select(
        "lien_id", "lien_type", "state_code", "filing_date", "lien_amount", "lien_status", "debtor_key",
        "expiration_date", "is_active",
        dates.days_between(F.col("filing_date"), F.lit(reference_date).cast("date")).alias("days_since_filing"),
        "related_suit_id",
        F.col("judgment_key").alias("related_judgment_key"),
        "confidence",
    )


def judgment_best_view(
    judgments: DataFrame, suits: DataFrame, linked_liens: DataFrame, aliases: DataFrame | None = None
) -> DataFrame:
    """One row per judgment: its suit, whether and where a lien was recorded, time to satisfaction."""
    recorded = linked_liens.where("judgment_key is not null").groupBy("judgment_key").agg(
        F.array_join(F.sort_array(F.collect_set("state_code")), ",").alias("lien_states")
    )
    return link_suit_judgment(suits, judgments, aliases).join(recorded, "judgment_key", "left").select(
        "judgment_key", "suit_id", "state_code", "case_number", "judgment_date", "judgment_type", "judgment_amount",
        "satisfaction_status", "satisfaction_date",
        F.col("lien_states").isNotNull().alias("has_lien_recorded"),
        "lien_states",
        dates.days_between(F.col("judgment_date"), F.col("satisfaction_date")).alias("days_to_satisfaction"),
    )


def with_expired(dated_liens: DataFrame) -> DataFrame:
    """Liens whose time has run out get the status EXPIRED, whatever their feed still says."""
    out = (F.col("lien_status") == "ACTIVE") & ~F.col("is_active")
    return dated_liens.withColumn("lien_status", F.when(out, "EXPIRED").otherwise(F.col("lien_status")))


def frequent_parties(profile: DataFrame, suits: int = 10, liens: int = 5) -> DataFrame:
    """Parties of many suits or many liens."""
    appearances = F.col("suits_as_plaintiff") + F.col("suits_as_defendant")
    return profile.where((appearances >= suits) | (F.col("liens_as_debtor") >= liens))


def active_liens_by_state(dated_liens: DataFrame) -> DataFrame:
    return dated_liens.where("is_active").groupBy("state_code", "lien_type").agg(
        F.count(F.lit(1)).alias("active_liens"),
        F.sum("lien_amount").cast("double").alias("outstanding"),
        F.min("expiration_date").alias("next_expiration"),
    )


# One shape for rows of every record type, so that parties are summed in a single aggregate.
_MEASURES = ["suits_as_plaintiff", "suits_as_defendant", "judgments_against", "unsatisfied_judgments",
             "liens_as_debtor", "liens_as_creditor", "active_liens"]
_SUMS = ["judgment_amount", "lien_amount", "lien_outstanding"]


def _contribution(df: DataFrame, party: str, counts: dict[str, Column], sums: dict[str, Column], filed: Column | None):
    nothing = F.lit(None).cast("date")
    return df.select(
        F.col(party).alias("party_key"),
        *[F.coalesce(counts[m].cast("long"), F.lit(0)).alias(m) if m in counts else F.lit(0).cast("long").alias(m)
          for m in _MEASURES],
        *[F.coalesce(sums[s], F.lit(0)).cast("decimal(18,2)").alias(s) if s in sums
          else F.lit(0).cast("decimal(18,2)").alias(s) for s in _SUMS],
        (filed if filed is not None else nothing).alias("_filed"),
    )


def party_profile(suit_parties: DataFrame, judgments: DataFrame, dated_liens: DataFrame, frequent: int = 10) -> DataFrame:
    """One row per party over all record types.

    ``suit_parties(party_key, party_type, filing_date)``. The record types are stacked and summed once; a
    full join of three aggregates would shuffle each of them again.
    """
    rows = _contribution(
        suit_parties, "party_key",
        {"suits_as_plaintiff": F.col("party_type") == "PLAINTIFF", "suits_as_defendant": F.col("party_type") == "DEFENDANT"},
        {}, F.col("filing_date"),
    ).unionByName(_contribution(
        judgments, "debtor_key",
        {"judgments_against": F.lit(1), "unsatisfied_judgments": ~F.col("satisfaction_status").isin("SATISFIED", "VACATED")},
        {"judgment_amount": F.col("judgment_amount")}, None,
    )).unionByName(_contribution(
        dated_liens, "debtor_key",
        {"liens_as_debtor": F.lit(1), "active_liens": F.col("is_active")},
        {"lien_amount": F.col("lien_amount"), "lien_outstanding": F.when(F.col("is_active"), F.col("lien_amount"))},
        None,
    )).unionByName(_contribution(
        dated_liens.where("creditor_key is not null"), "creditor_key", {"liens_as_creditor": F.lit(1)}, {}, None,
    ))
    total = rows.groupBy("party_key").agg(
        *[F.sum(m).alias(m) for m in _MEASURES],
        *[F.sum(s).cast("double").alias(s) for s in _SUMS],
        F.min("_filed").alias("first_filing"),
        F.max("_filed").alias("last_filing"),
    )
    suits = F.col("suits_as_plaintiff") + F.col("suits_as_defendant")
    span = F.greatest(dates.days_between(F.col("first_filing"), F.col("last_filing")), F.lit(365))
    return total.withColumns({
        "litigation_velocity": F.coalesce(numbers.ratio(suits * 365, span, 2), F.lit(0.0)),
        "is_frequent_litigant": (suits >= frequent) | (F.col("liens_as_debtor") >= 5),
    })


def party_risk(profile: DataFrame) -> DataFrame:
    """Risk points, the score that is cut at ``RISK_LIMIT``, and its band."""
    points = sum((F.col(c) * w for c, w in RISK_WEIGHTS.items()), F.lit(0))
    points = points.cast("long")
    score = F.least(F.lit(RISK_LIMIT).cast("long"), points)
    band = None
    for name, below in RISK_BANDS:
        band = F.when(F.col("risk_score") < below, name) if band is None else band.when(F.col("risk_score") < below, name)
    return profile.withColumn("risk_points", points).withColumn("risk_score", score).withColumn("risk_band", band.otherwise("high"))


def due_diligence(suit_parties: DataFrame, judgments: DataFrame, liens: DataFrame) -> DataFrame:
    """Everything known about a party as one list of records; filter it by ``party_key``."""
    columns = ["party_key", "record_type", "record_id", "state_code", "record_date", "role", "amount"]
    money = "decimal(18,2)"
    suits = suit_parties.select(
        "party_key", F.lit("SUIT").alias("record_type"), F.col("suit_id").alias("record_id"), "state_code",
        F.col("filing_date").alias("record_date"), F.col("party_type").alias("role"),
        F.lit(None).cast(money).alias("amount"),
    )
    decided = judgments.select(
        F.col("debtor_key").alias("party_key"), F.lit("JUDGMENT").alias("record_type"),
        judgment_id(F.col("state_code"), F.col("case_number"), F.col("judgment_date")).alias("record_id"), "state_code",
        F.col("judgment_date").alias("record_date"), F.lit("DEBTOR").alias("role"),
        F.col("judgment_amount").alias("amount"),
    )
    filed = liens.select(
        F.col("debtor_key").alias("party_key"), F.lit("LIEN").alias("record_type"), F.col("lien_id").alias("record_id"),
        "state_code", F.col("filing_date").alias("record_date"), F.lit("DEBTOR").alias("role"),
        F.col("lien_amount").alias("amount"),
    )
    held = liens.where("creditor_key is not null").select(
        F.col("creditor_key").alias("party_key"), F.lit("LIEN").alias("record_type"), F.col("lien_id").alias("record_id"),
        "state_code", F.col("filing_date").alias("record_date"), F.lit("CREDITOR").alias("role"),
        F.col("lien_amount").alias("amount"),
    )
    return suits.unionByName(decided).unionByName(filed).unionByName(held).select(*columns)


def all_records(best_view: DataFrame, judgments: DataFrame, liens: DataFrame) -> DataFrame:
    """One row per record of any type with its type, date, amount and days to resolution."""
    day = F.col
    suits = best_view.select(
        "state_code", F.lit("SUIT").alias("record_type"), day("case_type").alias("kind"), day("filing_date").alias("filed"),
        day("amount_demanded").alias("amount"), day("disposition_date").isNotNull().alias("resolved"),
        F.when(day("disposition_date").isNotNull(), day("days_open")).alias("days_to_resolution"),
        F.concat(F.lit("S"), day("suit_id")).alias("record_id"),
    )
    decided = judgments.select(
        "state_code", F.lit("JUDGMENT").alias("record_type"), day("judgment_type").alias("kind"),
        day("judgment_date").alias("filed"), day("judgment_amount").alias("amount"),
        day("satisfaction_date").isNotNull().alias("resolved"),
        dates.days_between(day("judgment_date"), day("satisfaction_date")).alias("days_to_resolution"),
        F.concat(F.lit("J"), day("judgment_key").cast("string")).alias("record_id"),
    )
    filed = liens.select(
        "state_code", F.lit("LIEN").alias("record_type"), day("lien_type").alias("kind"), day("filing_date").alias("filed"),
        day("lien_amount").alias("amount"), (day("lien_status") != "ACTIVE").alias("resolved"),
        F.lit(None).cast("long").alias("days_to_resolution"),
        F.concat(F.lit("L"), day("lien_id")).alias("record_id"),
    )
    return suits.unionByName(decided).unionByName(filed).withColumn("year", F.year("filed").cast("long"))


def record_summary(records: DataFrame) -> DataFrame:
    """Filings, mean amount, share resolved and median days to resolution per state, year, record type and kind."""
    from lamella.operators.rank import exact_median

    group = ["state_code", "year", "record_type", "kind"]
    stored = stage(records, "records")
    counts = stored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("filing_count"),
        numbers.ratio(F.sum("amount"), F.count("amount"), 2).alias("avg_amount"),
        numbers.percent(F.count_if("resolved"), F.count(F.lit(1))).alias("disposition_rate"),
    )
    medians = exact_median(stored, group, "days_to_resolution", "record_id", "median_days_to_resolution")
    return counts.join(medians, group, "left")


def record_trend(records: DataFrame) -> DataFrame:
    """Monthly filings per state and record type, mean over three rows, change against a year before."""
    from pyspark.sql import Window

    group = ["state_code", "record_type"]
    months = records.groupBy(*group, F.trunc("filed", "MM").alias("month")).agg(F.count(F.lit(1)).alias("new_filings"))
    w = Window.partitionBy(*group).orderBy("month").rowsBetween(-2, 0)
    before = months.select(*group, F.add_months("month", 12).alias("month"), F.col("new_filings").alias("previous"))
    return months.withColumn(
        "rolling_3m_avg", numbers.ratio(F.sum("new_filings").over(w), F.count(F.lit(1)).over(w), 1)
    ).join(before, [*group, "month"], "left").withColumn(
        "yoy_change_pct", numbers.percent(F.col("new_filings") - F.col("previous"), F.col("previous"))
    )


def risk_dashboard(best_view: DataFrame, judgments: DataFrame, dated_liens: DataFrame) -> DataFrame:
    """Suits, judgments and liens per state and year. Each type is counted first; only counts are joined."""
    def yearly(df: DataFrame, day: str, **measures: Column) -> DataFrame:
        return df.groupBy("state_code", F.year(day).cast("long").alias("year")).agg(*[m.alias(n) for n, m in measures.items()])

    suits = yearly(best_view, "filing_date", suits=F.count(F.lit(1)),
                   open_suits=F.count_if(F.col("case_status") == "OPEN"))
    decided = yearly(judgments, "judgment_date", judgments=F.count(F.lit(1)),
                     judgment_amount=F.sum("judgment_amount").cast("double"))
    filed = yearly(dated_liens, "filing_date", liens=F.count(F.lit(1)), active_liens=F.count_if("is_active"))
    on = ["state_code", "year"]
    joined = suits.join(decided, on, "full").join(filed, on, "full")
    return joined.fillna(0)
