"""Court record queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import DERIVED, bind
from catalog.registry import half_up, query
from lamella.functions import dates, text
from lamella.operators.mapping import harmonize
from lamella.plans import records
from lamella.plans.courts import COURTS, FEDERAL
from lamella.staging import stage

REF = "2001-08-02"
NEWEST = "_ingestion_date"
CARRY = ["_ingestion_date", "o_orderkey"]


def _feed_columns(st: str) -> list:
    """Columns of one court's raw feed, all text, as the court would send them."""
    c = F.col
    disposed = F.nullif(c("disposed_iso"), F.lit("")).cast("date")
    outcome = F.when(disposed.isNotNull(), "Judgment").otherwise("")
    party = F.struct(c("plaintiff").alias("name"), F.lit("Att. A").alias("attorney"))
    other = F.struct(c("defendant").alias("name"), F.lit(None).cast("string").alias("attorney"))
    second = F.struct(F.concat(c("defendant"), F.lit(" BANK")).alias("name"), F.lit("Att. B").alias("attorney"))
    layout = {
        "TX": [c("case_no").alias("cause_nbr"), c("case_no").alias("case_number"), c("filed_raw").alias("file_date"),
               c("type_raw").alias("case_type"), c("status_raw").alias("case_status"),
               c("plaintiff").alias("plaintiff_name"), c("defendant").alias("defendant_name"), c("judge"),
               F.lit("12").alias("court_number"), c("amount_raw").alias("amount"),
               F.lit("Debt").alias("cause_of_action")],
        "CA": [c("case_no").alias("docket_id"), c("type_raw").alias("case_type_code"),
               c("filed_raw").alias("filing_date"), c("status_raw").alias("status"),
               F.lit("Central").alias("court_division"),
               F.to_json(F.struct(F.array(party).alias("plaintiffs"), F.array(other, second).alias("defendants")))
               .alias("parties"),
               c("amount_raw").alias("amount_controversy"),
               F.to_json(F.struct(outcome.alias("type"), c("disposed_iso").alias("date"))).alias("disposition")],
        "NY": [c("case_no").alias("index_number"), c("type_raw").alias("action_type"),
               c("filed_raw").alias("date_filed"), c("status_raw").alias("status"), c("county"),
               c("plaintiff"), c("defendant"), c("judge").alias("judge_assigned"),
               c("amount_raw").alias("relief_sought"),
               F.coalesce(F.date_format(disposed, "MM/dd/yyyy"), F.lit("")).alias("disposition_date")],
        "FL": [c("case_no").alias("case_id"), c("type_raw").alias("case_type"), c("filed_raw").alias("filed_dt"),
               c("status_raw").alias("case_status"), F.lit("Div 1").alias("division"),
               c("plaintiff").alias("pty_plaintiff"), c("defendant").alias("pty_defendant"),
               c("judge").alias("judge_name"),
               F.when(c("amount_raw") == "", "0.00").otherwise(c("amount_raw")).alias("amt_claimed"),
               F.coalesce(F.date_format(disposed, "yyyyMMdd"), F.lit("")).alias("disp_dt"),
               outcome.alias("disp_type")],
        "IL": [c("case_no").alias("case_number"), c("type_raw").alias("case_category"),
               c("filed_raw").alias("filing_date"), c("status_raw").alias("case_status"),
               F.lit("Room 3").alias("court_room"), c("plaintiff").alias("plaintiff_info"),
               c("defendant").alias("defendant_info"), c("judge").alias("presiding_judge"),
               c("amount_raw").alias("demand_amount")],
        "OH": [c("case_no").alias("case_num"), c("type_raw").alias("type_cd"), c("filed_raw").alias("file_dt"),
               c("status_raw").alias("status_cd"), c("plaintiff").alias("plaintiff_nm"),
               c("defendant").alias("defendant_nm"), c("judge").alias("judge_nm"), c("amount_raw").alias("claim_amt"),
               F.coalesce(F.date_format(disposed, "M/d/yyyy"), F.lit("")).alias("disp_dt")],
    }
    return [*layout[st], *CARRY]


def court_feeds(spark: SparkSession, d: str, states: list[str]) -> dict[str, DataFrame]:
    """The raw feeds, landed once, one partition per court."""
    landed = stage(bind(spark, d, "b_court").where(F.col("st").isin(states)), "court", ("st",))
    return {st: landed.where(F.col("st") == st).select(*_feed_columns(st)) for st in states}


def federal_feed(spark: SparkSession, d: str) -> DataFrame:
    """Federal dockets, with the region of the court as district."""
    sql = """SELECT concat('1:', cast(o_orderkey AS string)) AS docket_number, concat(c_name, ' v. ', n_name) AS case_name,
      'cause' AS cause_code, CASE WHEN o_orderkey % 2 = 0 THEN '190' ELSE '440' END AS nature_of_suit,
      cast(cast(o_orderdate AS date) AS string) AS date_filed,
      CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate AS date) + 90 AS string) ELSE '' END AS date_terminated,
      'judge ONE' AS judge, r_name AS district, date '2001-08-01' AS _ingestion_date, o_orderkey
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
    JOIN {region} ON n_regionkey = r_regionkey"""
    names = ["orders", "customer", "nation", "region"]
    return spark.sql(sql, **{n: bind(spark, d, n) for n in names})


def canonical(spark: SparkSession, d: str, states: list[str] | None = None) -> DataFrame:
    states = states or [c.state for c in COURTS]
    return records.canonical_suits(spark, court_feeds(spark, d, states), CARRY)


def latest_suits(spark: SparkSession, d: str) -> DataFrame:
    """The silver layer, for those who read it once."""
    return records.silver_suits(canonical(spark, d), NEWEST)[0]


def suits(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The silver layer as a stored table, for gold tables that read it more than once; with ``columns``, these of it."""
    silver = latest_suits(spark, d)
    return stage(silver.select(*columns) if columns else silver, "suits")


def parties_of(s: DataFrame, *columns: str) -> DataFrame:
    """The silver party table, stored like the suits."""
    rows = records.extract_parties(s, ["state_code", "filing_date"])
    return stage(rows.select(*columns) if columns else rows, "parties")


def parties(spark: SparkSession, d: str) -> DataFrame:
    return parties_of(suits(spark, d))


def best_view(spark: SparkSession, d: str) -> DataFrame:
    """The parties are counted as they are read: nobody else asks for them here, so they are not stored."""
    s = suits(spark, d)
    return records.suit_best_view(s, records.extract_parties(s), REF)


DERIVED["o_canon"] = """
SELECT CASE WHEN case_no = '' THEN st || '_' || replace(county, ' ', '_') || '_'
            ELSE st || '_' || replace(county, ' ', '_') || '_' || case_no END AS suit_id,
  st AS state_code, county, case_no AS case_number, o_orderkey, _ingestion_date,
  CASE WHEN type_raw = 'ZZ' THEN 'OTHER' ELSE CASE st WHEN 'TX' THEN 'CIVIL' WHEN 'CA' THEN 'EVICTION'
       WHEN 'NY' THEN 'PERSONAL_INJURY' WHEN 'FL' THEN 'CRIMINAL' WHEN 'IL' THEN 'REAL_PROPERTY'
       ELSE 'EVICTION' END END AS case_type,
  type_raw AS case_type_raw,
  CAST(CASE st WHEN 'CA' THEN try_strptime(filed_raw, '%Y-%m-%d') WHEN 'FL' THEN try_strptime(filed_raw, '%Y%m%d')
       WHEN 'IL' THEN try_strptime(filed_raw, '%d-%b-%Y') ELSE try_strptime(filed_raw, '%m/%d/%Y') END AS DATE) AS filing_date,
  filed_raw AS filing_date_raw,
  CASE WHEN status_raw IN ('DISP', 'Disposed', 'Settled', 'CLOSED', 'Closed', 'TERMINATED') THEN 'DISPOSED'
       WHEN status_raw IN ('PEND', 'Active', 'OPEN', 'Open', 'ACTIVE') THEN 'OPEN'
       WHEN status_raw = 'Sealed' THEN 'SEALED' WHEN status_raw = 'Stayed' THEN 'STAYED' ELSE 'UNKNOWN' END AS case_status,
  status_raw AS case_status_raw,
  CASE st WHEN 'CA' THEN 'Central' WHEN 'FL' THEN 'Div 1' WHEN 'IL' THEN 'Room 3' END AS court_name,
  CASE WHEN st <> 'CA' THEN 'Hon. ' || upper(substr(judge, 6, 1)) || lower(substr(judge, 7)) END AS judge_name,
  CASE WHEN st = 'TX' THEN 'Debt' END AS cause_of_action,
  try_cast(nullif(regexp_replace(amount_raw, '[^0-9.-]', '', 'g'), '') AS DECIMAL(18,2)) AS amount_demanded,
  CASE WHEN st IN ('CA', 'FL') THEN CASE WHEN disposed_iso <> '' THEN 'Judgment' ELSE '' END END AS disposition,
  CASE WHEN st IN ('CA', 'NY', 'FL', 'OH') AND disposed_iso <> '' THEN CAST(disposed_iso AS DATE) END AS disposition_date,
  trim(plaintiff) AS plaintiff_name, trim(defendant) AS defendant_name
FROM b_court
"""
DERIVED["o_suits"] = """
SELECT * FROM o_canon WHERE case_number <> '' AND filing_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY suit_id ORDER BY _ingestion_date DESC, case_status_raw, filing_date_raw) = 1
"""
DERIVED["o_parties"] = r"""
SELECT suit_id || '_' || party_type || '_' || seq AS party_id, suit_id, party_type, seq AS sequence,
       replace(trim(raw), '_', '') AS party_name, raw AS party_name_raw, regexp_matches(raw, '\b(LLC|BANK)\b') AS is_entity,
       attorney AS attorney_name, state_code, filing_date
FROM (SELECT suit_id, state_code, filing_date, 'PLAINTIFF' AS party_type, 1 AS seq,
             CASE WHEN state_code = 'CA' THEN ' ' || plaintiff_name ELSE plaintiff_name END AS raw,
             CASE WHEN state_code = 'CA' THEN 'Att. A' END AS attorney FROM o_suits
      UNION ALL SELECT suit_id, state_code, filing_date, 'DEFENDANT', 1, defendant_name, NULL FROM o_suits
      UNION ALL SELECT suit_id, state_code, filing_date, 'DEFENDANT', 2, defendant_name || ' BANK', 'Att. B'
      FROM o_suits WHERE state_code = 'CA')
"""
# Names of people are shown in title case: after a digit or '#' letters stay lower, as in both engines' data.
DERIVED["o_parties_shown"] = """
SELECT * REPLACE (CASE WHEN is_entity THEN party_name
  ELSE upper(substr(party_name, 1, 1)) || lower(substr(party_name, 2)) END AS party_name) FROM o_parties
"""
DERIVED["o_best"] = f"""
SELECT suit_id, state_code, county, case_number, case_type, case_type_raw, filing_date, year(filing_date) AS year_filed,
  case_status, case_status_raw, court_name, judge_name, cause_of_action, amount_demanded, disposition, disposition_date,
  coalesce(disposition_date, date '{REF}') - filing_date AS days_open, plaintiff_name AS primary_plaintiff,
  defendant_name AS primary_defendant, 1 AS plaintiff_count, CASE WHEN state_code = 'CA' THEN 2 ELSE 1 END AS defendant_count
FROM o_suits
"""
DERIVED["o_stats"] = """
SELECT party_name, count(*) FILTER (party_type = 'PLAINTIFF') AS total_suits_as_plaintiff,
  count(*) FILTER (party_type = 'DEFENDANT') AS total_suits_as_defendant, min(filing_date) AS first_appearance_date,
  max(filing_date) AS last_appearance_date, count(*) AS total_appearances, count(*) >= 10 AS is_frequent_litigant
FROM o_parties_shown GROUP BY party_name
"""
DERIVED["o_summary"] = f"""
SELECT state_code, year_filed, case_type, count(*) AS suit_count,
  {half_up("sum(days_open) FILTER (disposition_date IS NOT NULL)", "count(disposition_date)", 2)} AS avg_days_to_disposition,
  {half_up("count(disposition_date) * 100", "count(*)", 2)} AS disposition_rate
FROM o_best GROUP BY ALL
"""
DERIVED["o_monthly"] = """
SELECT strftime(filing_date, '%Y-%m') AS year_month, state_code, case_type, count(*) AS new_filings,
  count(disposition_date) AS dispositions FROM o_best GROUP BY ALL
"""

_CANON = ["suit_id", "state_code", "county", "case_number", "case_type", "case_type_raw", "filing_date",
          "case_status", "case_status_raw", "court_name", "judge_name", "cause_of_action", "amount_demanded",
          "disposition", "disposition_date", "plaintiff_name", "defendant_name", "_ingestion_date", "o_orderkey"]


def _canon_query(st: str):
    @query(f"canon_{st.lower()}", f"SELECT {', '.join(_CANON)} FROM o_canon WHERE state_code = '{st}'",
           money=("amount_demanded",))
    def run(spark, d):
        return canonical(spark, d, [st]).select(*_CANON)


for _court in COURTS:
    _canon_query(_court.state)


@query("canon_fed", """
SELECT 'FED_' || replace(r_name, ' ', '_') || '_1:' || o_orderkey AS suit_id, 'FEDERAL_COURT' AS record_source,
  r_name AS county, '1:' || o_orderkey AS case_number,
  CASE WHEN o_orderkey % 2 = 0 THEN 'CONTRACT' ELSE 'CIVIL' END AS case_type, c_name AS plaintiff_name, n_name AS defendant_name,
  CAST(o_orderdate AS DATE) AS filing_date, CASE WHEN o_orderstatus = 'F' THEN 'DISPOSED' ELSE 'OPEN' END AS case_status,
  'Judge One' AS judge_name,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 90 END AS disposition_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def canon_fed(spark, d):
    out = records.canonical_suits(spark, {FEDERAL.state: federal_feed(spark, d)}, CARRY)
    return out.select("suit_id", "record_source", "county", "case_number", "case_type", "filing_date", "case_status",
                      "plaintiff_name", "defendant_name", "judge_name", "disposition_date")


@query("canon_union", f"SELECT {', '.join(_CANON)} FROM o_suits", money=("amount_demanded",))
def canon_union(spark, d):
    return suits(spark, d).select(*_CANON)


@query("canon_quarantine", """
SELECT suit_id, state_code, filing_date_raw, concat_ws(',', CASE WHEN case_number = '' THEN 'MISSING_CASE_NUMBER' END,
  CASE WHEN filing_date IS NULL THEN 'BAD_FILING_DATE' END) AS reasons, o_orderkey, _ingestion_date
FROM o_canon WHERE case_number = '' OR filing_date IS NULL""")
def canon_quarantine(spark, d):
    bad = records.silver_suits(canonical(spark, d), NEWEST)[1]
    return bad.select("suit_id", "state_code", "filing_date_raw", F.array_join("_reasons", ",").alias("reasons"),
                      "o_orderkey", "_ingestion_date")


@query("parse_dates", "SELECT o_orderkey, state_code AS st, _ingestion_date, filing_date_raw AS filed_raw, filing_date FROM o_canon")
def parse_dates(spark, d):
    fmt = {c.state: c.date_format for c in COURTS}
    by_state = F.create_map(*[F.lit(x) for pair in fmt.items() for x in pair])
    court = bind(spark, d, "b_court")
    return court.select("o_orderkey", "st", "_ingestion_date", "filed_raw",
                        dates.parse_date_by(F.col("filed_raw"), by_state[F.col("st")], fmt.values()).alias("filing_date"))


@query("harmonize_codes", """SELECT state_code, case_type, case_type_raw, case_status, case_status_raw, count(*) AS rows
  FROM o_canon GROUP BY ALL""")
def harmonize_codes(spark, d):
    court = bind(spark, d, "b_court").select(F.col("st").alias("state_code"), F.col("type_raw").alias("case_type_raw"),
                                             F.col("status_raw").alias("case_status_raw"))
    out = harmonize(court, records.type_codes(spark), "case_type_raw", "case_type", "OTHER")
    out = harmonize(out, records.status_codes(spark), "case_status_raw", "case_status", "UNKNOWN")
    return out.groupBy("state_code", "case_type", "case_type_raw", "case_status", "case_status_raw").agg(
        F.count(F.lit(1)).alias("rows"))


_PARTY = ["party_id", "suit_id", "party_type", "sequence", "party_name", "party_name_raw", "is_entity", "attorney_name"]


@query("party_extract", f"SELECT {', '.join(_PARTY)} FROM o_parties_shown")
def party_extract(spark, d):
    return parties(spark, d).select(*_PARTY)


@query("party_explode", f"SELECT {', '.join(_PARTY)} FROM o_parties_shown WHERE state_code = 'CA'")
def party_explode(spark, d):
    ca = records.silver_suits(canonical(spark, d, ["CA"]), NEWEST)[0]
    return records.extract_parties(ca).select(*_PARTY)


@query("party_counts", "SELECT suit_id, plaintiff_count, defendant_count FROM o_best")
def party_counts(spark, d):
    return records.party_counts(parties(spark, d))


@query("party_stats", "SELECT * FROM o_stats")
def party_stats(spark, d):
    return records.party_stats(parties(spark, d))


@query("party_best_view", """SELECT party_id, suit_id, party_type, p.party_name, is_entity, filing_date,
  total_suits_as_plaintiff, total_suits_as_defendant, first_appearance_date, last_appearance_date, total_appearances,
  is_frequent_litigant FROM o_parties_shown p JOIN o_stats s ON p.party_name = s.party_name""")
def party_best_view(spark, d):
    s = latest_suits(spark, d)
    named = parties_of(s, "party_id", "suit_id", "party_type", "party_name", "is_entity", "filing_date")
    return records.party_best_view(named, s).select(
        "party_id", "suit_id", "party_type", "party_name", "is_entity", "filing_date", "total_suits_as_plaintiff",
        "total_suits_as_defendant", "first_appearance_date", "last_appearance_date", "total_appearances",
        "is_frequent_litigant")


@query("frequent_litigants", """SELECT s.*, last_appearance_date - first_appearance_date AS litigation_span_days,
  regexp_matches(party_name, '\\b(LLC|BANK)\\b') AS is_entity FROM o_stats s WHERE is_frequent_litigant""")
def frequent_litigants(spark, d):
    s = suits(spark, d, "suit_id", "state_code", "filing_date", "plaintiffs", "defendants")
    return records.frequent_litigants(parties_of(s, "party_id", "suit_id", "party_type", "party_name"), s)


@query("suit_best_view", "SELECT * FROM o_best", money=("amount_demanded",))
def suit_best_view(spark, d):
    return best_view(spark, d)


@query("state_summary", """SELECT s.*, top_plaintiff, median_amount_demanded FROM o_summary s
LEFT JOIN (SELECT state_code, year_filed, case_type, primary_plaintiff AS top_plaintiff
           FROM o_best GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY state_code, year_filed, case_type
           ORDER BY count(*) DESC, primary_plaintiff) = 1) t USING (state_code, year_filed, case_type)
LEFT JOIN (SELECT state_code, year_filed, case_type, round(median(amount_demanded::DOUBLE), 3) AS median_amount_demanded FROM o_best
           GROUP BY ALL HAVING count(amount_demanded) > 0) m USING (state_code, year_filed, case_type)""")
def state_summary(spark, d):
    return records.full_state_summary(stage(best_view(spark, d), "best_view"))


@query("median_amount", """SELECT state_code, year_filed, case_type, round(median(amount_demanded::DOUBLE), 3) AS median_amount_demanded
  FROM o_best WHERE amount_demanded IS NOT NULL GROUP BY ALL""")
def median_amount(spark, d):
    return records.median_amounts(best_view(spark, d), ["state_code", "year_filed", "case_type"])


@query("top_plaintiff", """SELECT state_code, year_filed, case_type, primary_plaintiff, count(*) AS count, 1 AS rank
  FROM o_best GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY state_code, year_filed, case_type
  ORDER BY count(*) DESC, primary_plaintiff) = 1""")
def top_plaintiff(spark, d):
    return records.top_items(best_view(spark, d), ["state_code", "year_filed", "case_type"], "primary_plaintiff", 1)


@query("top_litigants", """SELECT state_code, year_filed, party_type, party_name, count, rank FROM (
  SELECT state_code, year(filing_date) AS year_filed, party_type, party_name, count(*) AS count,
    row_number() OVER (PARTITION BY state_code, year(filing_date), party_type ORDER BY count(*) DESC, party_name) AS rank
  FROM o_parties_shown GROUP BY 1, 2, 3, 4) WHERE rank <= 3""")
def top_litigants(spark, d):
    p = parties(spark, d).withColumn("year_filed", F.year("filing_date").cast("long"))
    return records.top_items(p, ["state_code", "year_filed", "party_type"], "party_name", 3)


@query("repeat_filers", """SELECT state_code, year_filed, count(*) FILTER (n >= 2) AS repeat_filer_count, count(*) AS filers
  FROM (SELECT state_code, year(filing_date) AS year_filed, party_name, count(*) AS n FROM o_parties_shown
        WHERE party_type = 'PLAINTIFF' GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def repeat_filers(spark, d):
    return records.repeat_filers(parties(spark, d))


@query("monthly_trends", f"""SELECT *, {half_up(
    "sum(new_filings) OVER (PARTITION BY state_code, case_type ORDER BY year_month ROWS 2 PRECEDING)",
    "count(*) OVER (PARTITION BY state_code, case_type ORDER BY year_month ROWS 2 PRECEDING)", 1)} AS filing_trend_3m_avg
FROM o_monthly""")
def monthly_trends(spark, d):
    return records.monthly_trends(best_view(spark, d))


@query("monthly_yoy", f"""SELECT a.state_code, a.case_type, a.year_month, a.new_filings, b.new_filings AS previous,
  {half_up("(a.new_filings - b.new_filings) * 100", "b.new_filings", 2)} AS filing_trend_yoy_pct
FROM o_monthly a LEFT JOIN o_monthly b ON a.state_code = b.state_code AND a.case_type = b.case_type
  AND b.year_month = strftime(CAST(a.year_month || '-01' AS DATE) - INTERVAL 1 YEAR, '%Y-%m')""")
def monthly_yoy(spark, d):
    return records.monthly_yoy(best_view(spark, d))


@query("open_cases_snapshot", """
WITH m AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, date_trunc('month', hi)::TIMESTAMP,
                                INTERVAL 1 MONTH)) AS DATE)) AS month_end
           FROM (SELECT min(filing_date) AS lo, greatest(max(filing_date), max(disposition_date)) AS hi FROM o_best)),
g AS (SELECT DISTINCT state_code, case_type FROM o_best)
SELECT g.state_code, g.case_type, month_end, count(b.suit_id) AS open_cases
FROM g CROSS JOIN m LEFT JOIN o_best b ON b.state_code = g.state_code AND b.case_type = g.case_type
  AND b.filing_date <= month_end AND (b.disposition_date IS NULL OR b.disposition_date > month_end)
GROUP BY ALL""")
def open_cases_snapshot(spark, d):
    return records.open_cases_snapshot(best_view(spark, d))


@query("suit_search", """SELECT suit_id, state_code, county, case_number, case_type, filing_date, year_filed, case_status,
  days_open, amount_demanded, primary_plaintiff, primary_defendant, judge_name, cause_of_action, disposition,
  disposition_date, coalesce(primary_plaintiff, '') || ' ' || coalesce(primary_defendant, '') || ' ' ||
  coalesce(case_number, '') || ' ' || coalesce(cause_of_action, '') || ' ' || coalesce(judge_name, '') AS search_text
FROM o_best WHERE case_status <> 'SEALED'""", money=("amount_demanded",))
def suit_search(spark, d):
    return records.suit_search(best_view(spark, d))


@query("state_dashboard", f"""SELECT state_code, case_type, year_filed, suit_count,
  {half_up("round(avg_days_to_disposition * 100)", "100", 0)} AS avg_days_to_resolve,
  {half_up("round(disposition_rate * 100)", "100", 1)} AS disposition_rate_pct,
  lag(suit_count) OVER w AS prev_year_count,
  (suit_count - lag(suit_count) OVER w) / lag(suit_count) OVER w * 100 AS yoy_change_pct
FROM o_summary WINDOW w AS (PARTITION BY state_code, case_type ORDER BY year_filed)""")
def state_dashboard(spark, d):
    return records.state_dashboard(records.state_summary(best_view(spark, d)))


@query("docket_last_activity", """SELECT suit_id, last_activity_date FROM o_suits s LEFT JOIN
  (SELECT o_orderkey, CAST(max(ts) AS DATE) AS last_activity_date FROM b_docket GROUP BY 1) k ON s.o_orderkey = k.o_orderkey""")
def docket_last_activity(spark, d):
    s = records.with_docket_activity(suits(spark, d), bind(spark, d, "b_docket"), "o_orderkey", "ts")
    return s.select("suit_id", "last_activity_date")


@query("entity_flag", r"""SELECT party_id, party_name_raw, regexp_matches(party_name_raw, '\b(LLC|BANK)\b') AS is_entity
  FROM o_parties""")
def entity_flag(spark, d):
    p = parties(spark, d)
    return p.select("party_id", "party_name_raw", text.is_entity(F.col("party_name_raw")).alias("is_entity"))


@query("entity_type", r"""SELECT party_id, CASE WHEN regexp_matches(party_name_raw, '\bLLC\b') THEN 'LLC'
  WHEN regexp_matches(party_name_raw, '\bBANK\b') THEN 'CORPORATION' ELSE 'INDIVIDUAL' END AS entity_type FROM o_parties""")
def entity_type(spark, d):
    p = parties(spark, d)
    return p.select("party_id", text.entity_type(F.col("party_name_raw")).alias("entity_type"))


@query("ri_orphans", """SELECT state_code, count(*) AS orphans FROM o_parties WHERE suit_id NOT IN
  (SELECT suit_id FROM o_suits WHERE case_status <> 'SEALED') GROUP BY state_code""")
def ri_orphans(spark, d):
    from lamella.operators.linkage import orphans

    s = suits(spark, d)
    known = s.where("case_status <> 'SEALED'")
    return orphans(parties_of(s), known, ["suit_id"]).groupBy("state_code").agg(F.count(F.lit(1)).alias("orphans"))


@query("ri_has_record", """SELECT state_code, count(*) AS suits FROM o_suits WHERE o_orderkey IN
  (SELECT o_orderkey FROM b_docket) GROUP BY state_code""")
def ri_has_record(spark, d):
    from lamella.operators.linkage import having

    s = having(suits(spark, d), bind(spark, d, "b_docket"), ["o_orderkey"])
    return s.groupBy("state_code").agg(F.count(F.lit(1)).alias("suits"))
