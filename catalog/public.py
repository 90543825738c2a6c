"""Queries over suits, judgments, liens and resolved names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import DERIVED, bind
from catalog.records import best_view, latest_suits, suits
from catalog.registry import half_up, query
from lamella.operators import parties, similarity
from lamella.plans import public_records as pr
from lamella.plans import records
from lamella.staging import new_folder, stage

REF = "2001-08-02"
LINKED = ["suit_id", "state_code", "county", "case_number"]  # what links judgments to suits


def judgments(spark: SparkSession, d: str) -> DataFrame:
    return bind(spark, d, "b_judgments")


def liens(spark: SparkSession, d: str) -> DataFrame:
    return bind(spark, d, "b_liens")


def dated(spark: SparkSession, d: str) -> DataFrame:
    return pr.lien_expiration(liens(spark, d), pr.lien_rules(spark), REF)


def linked(spark: SparkSession, d: str) -> DataFrame:
    return pr.link_judgment_lien(judgments(spark, d), liens(spark, d))


def suit_parties(spark: SparkSession, d: str) -> DataFrame:
    """Plaintiffs and defendants of suits under the numeric key that judgments and liens use."""
    sql = """SELECT explode(array(struct(o_custkey AS party_key, 'PLAINTIFF' AS party_type),
                                  struct(c_nationkey AS party_key, 'DEFENDANT' AS party_type))) AS p,
                    cast(o_orderdate AS date) AS filing_date, o_orderkey
             FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
    rows = spark.sql(sql, orders=bind(spark, d, "orders"), customer=bind(spark, d, "customer"))
    state = "element_at(array('TX','CA','NY','FL','IL','OH'), cast(o_orderkey % 6 AS int) + 1)"
    return rows.select(F.col("p.party_key").cast("long").alias("party_key"), "p.party_type", "filing_date",
                       F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("suit_id"),
                       F.expr(state).alias("state_code"))


DERIVED["o_suit_parties"] = """
SELECT party_key, party_type, CAST(o_orderdate AS DATE) AS filing_date, 'S' || o_orderkey AS suit_id,
  CASE o_orderkey % 6 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL' WHEN 4 THEN 'IL' ELSE 'OH' END AS state_code
FROM (SELECT o_custkey AS party_key, 'PLAINTIFF' AS party_type, * FROM orders
      UNION ALL SELECT c_nationkey, 'DEFENDANT', orders.* FROM orders JOIN customer ON o_custkey = c_custkey)
"""
DERIVED["o_dated"] = f"""
SELECT *, CAST(filing_date + CASE lien_type WHEN 'UCC' THEN INTERVAL 60 MONTH ELSE INTERVAL 120 MONTH END AS DATE) AS expiration_date,
  lien_status = 'ACTIVE' AND filing_date + CASE lien_type WHEN 'UCC' THEN INTERVAL 60 MONTH ELSE INTERVAL 120 MONTH END
    > date '{REF}' AS is_active
FROM b_liens
"""
DERIVED["o_linked"] = """
SELECT l.*, coalesce(h.judgment_key, m.judgment_key) AS judgment_key,
  CASE WHEN h.judgment_key IS NOT NULL THEN 'HIGH' WHEN m.judgment_key IS NOT NULL THEN 'MEDIUM' ELSE 'UNLINKED' END AS confidence
FROM b_liens l
LEFT JOIN (SELECT lien_id, judgment_key FROM b_liens x JOIN b_judgments j
             ON x.related_case_number = j.case_number AND x.state_code = j.state_code
           QUALIFY row_number() OVER (PARTITION BY lien_id ORDER BY abs(x.filing_date - judgment_date), judgment_key) = 1) h
  ON l.lien_id = h.lien_id
LEFT JOIN (SELECT lien_id, judgment_key FROM b_liens x JOIN b_judgments j ON x.debtor_key = j.debtor_key
             AND abs(lien_amount - judgment_amount) * 100 <= judgment_amount
             AND x.filing_date - judgment_date BETWEEN 0 AND 90
           QUALIFY row_number() OVER (PARTITION BY lien_id ORDER BY x.filing_date - judgment_date, judgment_key) = 1) m
  ON l.lien_id = m.lien_id
"""
DERIVED["o_judged"] = """
SELECT j.*, s.suit_id FROM b_judgments j LEFT JOIN (SELECT state_code, county, case_number, suit_id FROM o_suits) s USING (state_code, county, case_number)
"""


@query("lien_expiration", "SELECT * FROM o_dated", money=("lien_amount",))
def lien_expiration(spark, d):
    return dated(spark, d)


@query("active_liens", """SELECT state_code, lien_type, count(*) AS active_liens, CAST(sum(lien_amount) AS DOUBLE) AS outstanding,
  min(expiration_date) AS next_expiration FROM o_dated WHERE is_active GROUP BY ALL""")
def active_liens(spark, d):
    return pr.active_liens_by_state(dated(spark, d))


@query("link_suit_judgment", "SELECT judgment_key, state_code, case_number, suit_id FROM o_judged")
def link_suit_judgment(spark, d):
    return pr.link_suit_judgment(latest_suits(spark, d), judgments(spark, d)).select(
        "judgment_key", "state_code", "case_number", "suit_id")


@query("unlinked_judgments", """
WITH asked AS (SELECT j.judgment_key, j.state_code, lower(replace(j.county, ' County', '')) AS court,
    CASE WHEN judgment_key % 11 = 0 THEN NULL WHEN judgment_key % 7 = 0 THEN 'x' || j.case_number ELSE j.case_number END AS case_number,
    judgment_key % 5 = 0 AS abroad FROM b_judgments j),
  held AS (SELECT state_code, lower(replace(county, ' County', '')) AS court, case_number FROM o_suits)
SELECT judgment_key, 0 AS suits_that_fit, CASE WHEN case_number IS NULL THEN 'NO_CASE_NUMBER' WHEN abroad THEN 'UNKNOWN_COURT' ELSE 'NO_SUIT' END AS reason
FROM asked a WHERE abroad OR case_number IS NULL OR NOT EXISTS (SELECT 1 FROM held h WHERE h.state_code = a.state_code AND h.court = a.court
  AND h.case_number = a.case_number)""")
def unlinked_judgments(spark, d):
    """Judgments with courts in another spelling, unknown courts, wrong and missing numbers."""
    key = F.col("judgment_key")
    asked = judgments(spark, d).withColumns({
        "county": F.when(key % 5 == 0, "Nowhere County").otherwise(F.upper(F.replace("county", F.lit(" County")))),
        "case_number": F.when(key % 11 == 0, None).when(key % 7 == 0, F.concat(F.lit("x"), "case_number")).otherwise(F.col("case_number"))})
    found = pr.unlinked_judgments(suits(spark, d, *LINKED), asked)
    return found.select("judgment_key", F.col("suits_that_fit").cast("int").alias("suits_that_fit"), "reason")


@query("link_judgment_lien", "SELECT * FROM o_linked", money=("lien_amount",))
def link_judgment_lien(spark, d):
    return linked(spark, d)


@query("xref_chain", """SELECT suit_id, j.state_code, j.judgment_key, judgment_amount, lien_id, lien_amount, confidence
  FROM o_judged j LEFT JOIN (SELECT judgment_key, lien_id, lien_amount, confidence FROM o_linked WHERE judgment_key IS NOT NULL) l
    ON j.judgment_key = l.judgment_key""", money=("judgment_amount", "lien_amount",))
def xref_chain(spark, d):
    return pr.xref_chain(latest_suits(spark, d), judgments(spark, d), linked(spark, d))


@query("suit_best_view_full", """SELECT b.suit_id, b.state_code, b.case_number, days_open, judgment_amount,
  judgment_amount IS NOT NULL AS has_judgment, coalesce(lien_count, 0) AS lien_count
FROM o_best b LEFT JOIN (SELECT suit_id, CAST(sum(judgment_amount) AS DECIMAL(28,2)) AS judgment_amount,
    CAST(sum(n) AS BIGINT) AS lien_count
  FROM (SELECT j.suit_id, judgment_amount,
               (SELECT count(*) FROM o_linked l WHERE l.judgment_key = j.judgment_key) AS n FROM o_judged j) GROUP BY 1) p
  ON b.suit_id = p.suit_id""", money=("judgment_amount",))
def suit_best_view_full(spark, d):
    counts = ["plaintiff_count", "defendant_count"]
    s = suits(spark, d, *LINKED, "filing_date", "disposition_date", "plaintiffs", "defendants")
    best = records.suit_best_view(s, records.extract_parties(s), REF, [*LINKED, "days_open", *counts])
    full = pr.suit_best_view_full(best, judgments(spark, d), linked(spark, d), suits=s)
    return full.select("suit_id", "state_code", "case_number", "days_open", "judgment_amount", "has_judgment", "lien_count")


@query("lien_best_view", f"""SELECT l.lien_id, l.lien_type, l.state_code, l.filing_date, l.lien_amount, l.lien_status, l.debtor_key,
  expiration_date, is_active, date '{REF}' - l.filing_date AS days_since_filing, suit_id AS related_suit_id,
  k.judgment_key AS related_judgment_key, confidence
FROM o_dated l JOIN o_linked k ON l.lien_id = k.lien_id LEFT JOIN o_judged j ON k.judgment_key = j.judgment_key""", money=("lien_amount",))
def lien_best_view(spark, d):
    return pr.lien_best_view(linked(spark, d), pr.lien_rules(spark), judgments(spark, d), latest_suits(spark, d), REF)


@query("judgment_best_view", """SELECT j.judgment_key, suit_id, state_code, case_number, judgment_date, judgment_type,
  judgment_amount, satisfaction_status, satisfaction_date, lien_states IS NOT NULL AS has_lien_recorded, lien_states,
  satisfaction_date - judgment_date AS days_to_satisfaction
FROM o_judged j LEFT JOIN (SELECT judgment_key, string_agg(DISTINCT state_code, ',' ORDER BY state_code) AS lien_states
  FROM o_linked GROUP BY 1) l ON j.judgment_key = l.judgment_key""", money=("judgment_amount",))
def judgment_best_view(spark, d):
    return pr.judgment_best_view(judgments(spark, d), latest_suits(spark, d), linked(spark, d))


DERIVED["o_profile_of_party"] = f"""
SELECT *, coalesce({half_up("(suits_as_plaintiff + suits_as_defendant) * 365",
                            "greatest(last_filing - first_filing, 365)", 2)}, 0) AS litigation_velocity,
  suits_as_plaintiff + suits_as_defendant >= 10 OR liens_as_debtor >= 5 AS is_frequent_litigant
FROM (SELECT party_key, coalesce(sp, 0) AS suits_as_plaintiff, coalesce(sd, 0) AS suits_as_defendant,
        coalesce(ja, 0) AS judgments_against, coalesce(ju, 0) AS unsatisfied_judgments, coalesce(ld, 0) AS liens_as_debtor,
        coalesce(lc, 0) AS liens_as_creditor, coalesce(la, 0) AS active_liens, coalesce(jm, 0)::DOUBLE AS judgment_amount, coalesce(lm, 0)::DOUBLE AS lien_amount,
        coalesce(lo, 0)::DOUBLE AS lien_outstanding, first_filing, last_filing
      FROM (SELECT party_key, count(*) FILTER (party_type = 'PLAINTIFF') AS sp, count(*) FILTER (party_type = 'DEFENDANT') AS sd,
                   min(filing_date) AS first_filing, max(filing_date) AS last_filing FROM o_suit_parties GROUP BY 1)
      FULL JOIN (SELECT debtor_key AS party_key, count(*) AS ja, count(*) FILTER (satisfaction_status <> 'SATISFIED') AS ju,
                   sum(judgment_amount) AS jm FROM b_judgments GROUP BY 1) USING (party_key)
      FULL JOIN (SELECT debtor_key AS party_key, count(*) AS ld, count(*) FILTER (is_active) AS la, sum(lien_amount) AS lm,
                   sum(lien_amount) FILTER (is_active) AS lo FROM o_dated GROUP BY 1) USING (party_key)
      FULL JOIN (SELECT creditor_key AS party_key, count(*) AS lc FROM b_liens WHERE creditor_key IS NOT NULL GROUP BY 1) USING (party_key))
"""


@query("party_profile", "SELECT * FROM o_profile_of_party")
def party_profile(spark, d):
    return pr.party_profile(suit_parties(spark, d), judgments(spark, d), dated(spark, d))


@query("party_risk", """SELECT *, CASE WHEN risk_score < 20 THEN 'low' WHEN risk_score < 50 THEN 'medium' ELSE 'high' END AS risk_band
FROM (SELECT party_key, risk_points, least(100, risk_points) AS risk_score
      FROM (SELECT party_key, CAST(10 * unsatisfied_judgments + 5 * active_liens + 2 * suits_as_defendant AS BIGINT) AS risk_points
            FROM o_profile_of_party))""")
def party_risk(spark, d):
    p = pr.party_profile(suit_parties(spark, d), judgments(spark, d), dated(spark, d))
    return pr.party_risk(p).select("party_key", "risk_points", "risk_score", "risk_band")


@query("due_diligence", """
SELECT party_key, 'SUIT' AS record_type, suit_id AS record_id, state_code, filing_date AS record_date, party_type AS role,
  NULL::DECIMAL(18,2) AS amount FROM o_suit_parties
UNION ALL SELECT debtor_key, 'JUDGMENT', state_code || '_' || case_number || '_' || judgment_date, state_code, judgment_date,
  'DEBTOR', judgment_amount FROM b_judgments
UNION ALL SELECT debtor_key, 'LIEN', lien_id, state_code, filing_date, 'DEBTOR', lien_amount FROM b_liens
UNION ALL SELECT creditor_key, 'LIEN', lien_id, state_code, filing_date, 'CREDITOR', lien_amount FROM b_liens WHERE creditor_key IS NOT NULL""", money=("amount",))
def due_diligence(spark, d):
    return pr.due_diligence(suit_parties(spark, d), judgments(spark, d), liens(spark, d))


DERIVED["o_records"] = """
SELECT state_code, 'SUIT' AS record_type, case_type AS kind, filing_date AS filed, amount_demanded AS amount,
  disposition_date IS NOT NULL AS resolved, CASE WHEN disposition_date IS NOT NULL THEN days_open END AS days_to_resolution FROM o_best
UNION ALL SELECT state_code, 'JUDGMENT', judgment_type, judgment_date, judgment_amount, satisfaction_date IS NOT NULL,
  satisfaction_date - judgment_date FROM b_judgments
UNION ALL SELECT state_code, 'LIEN', lien_type, filing_date, lien_amount, lien_status <> 'ACTIVE', NULL FROM b_liens
"""


@query("record_summary", f"""SELECT state_code, year(filed) AS year, record_type, kind, count(*) AS filing_count,
  {half_up("sum(amount) * 100", "count(amount) * 100", 2)} AS avg_amount,
  {half_up("count(*) FILTER (resolved) * 100", "count(*)", 2)} AS disposition_rate,
  median(days_to_resolution)::DOUBLE AS median_days_to_resolution FROM o_records GROUP BY 1, 2, 3, 4""")
def record_summary(spark, d):
    return pr.record_summary(pr.all_records(best_view(spark, d), judgments(spark, d), liens(spark, d)))


@query("record_trend", f"""
WITH m AS (SELECT state_code, record_type, CAST(date_trunc('month', filed) AS DATE) AS month, count(*) AS new_filings
           FROM o_records GROUP BY ALL)
SELECT a.*, {half_up("sum(a.new_filings) OVER w", "count(*) OVER w", 1)} AS rolling_3m_avg, b.new_filings AS previous,
  {half_up("(a.new_filings - b.new_filings) * 100", "b.new_filings", 2)} AS yoy_change_pct
FROM m a LEFT JOIN m b ON a.state_code = b.state_code AND a.record_type = b.record_type AND b.month = a.month - INTERVAL 1 YEAR
WINDOW w AS (PARTITION BY a.state_code, a.record_type ORDER BY a.month ROWS 2 PRECEDING)""")
def record_trend(spark, d):
    return pr.record_trend(pr.all_records(best_view(spark, d), judgments(spark, d), liens(spark, d)))


@query("risk_dashboard", """
SELECT state_code, year, coalesce(suits, 0) AS suits, coalesce(open_suits, 0) AS open_suits, coalesce(judgments, 0) AS judgments,
  coalesce(judgment_amount, 0) AS judgment_amount, coalesce(liens, 0) AS liens, coalesce(active_liens, 0) AS active_liens
FROM (SELECT state_code, year_filed AS year, count(*) AS suits, count(*) FILTER (case_status = 'OPEN') AS open_suits FROM o_best GROUP BY 1, 2)
FULL JOIN (SELECT state_code, year(judgment_date) AS year, count(*) AS judgments, CAST(sum(judgment_amount) AS DOUBLE) AS judgment_amount
           FROM b_judgments GROUP BY 1, 2) USING (state_code, year)
FULL JOIN (SELECT state_code, year(filing_date) AS year, count(*) AS liens, count(*) FILTER (is_active) AS active_liens
           FROM o_dated GROUP BY 1, 2) USING (state_code, year)""")
def risk_dashboard(spark, d):
    return pr.risk_dashboard(best_view(spark, d), judgments(spark, d), dated(spark, d))


DERIVED["o_names"] = r"""
SELECT record_id, state_code, party_name, key, state_code || ':' || substr(key, 1, 3) AS block
FROM (SELECT *, trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(party_name), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')),
        '(\s(llc|inc|corp|ltd|et al))+$', '')) AS key FROM b_names)
"""
DERIVED["o_nodes"] = """
SELECT block, key, min(record_id) AS node, count(*) AS records, list_distinct(string_split(key, ' ')) AS tokens
FROM o_names GROUP BY block, key
"""
DERIVED["o_pairs"] = """
SELECT a_id, b_id, a_name, b_name, block, shared / either AS similarity,
  CASE WHEN shared * 100 >= either * 60 THEN 'MERGE' ELSE 'REVIEW' END AS decision
FROM (SELECT a.node AS a_id, b.node AS b_id, a.key AS a_name, b.key AS b_name, a.block,
        len(list_intersect(a.tokens, b.tokens)) AS shared, len(list_distinct(list_concat(a.tokens, b.tokens))) AS either
      FROM o_nodes a JOIN o_nodes b ON a.block = b.block AND a.node < b.node)
WHERE shared * 100 >= either * 40
"""


@query("normalize_names", r"""SELECT record_id, key AS match_name, CASE WHEN regexp_matches(party_name, '(?i)\b(llc|inc)\b')
  THEN regexp_replace(party_name, '\s+', ' ', 'g') ELSE
  array_to_string(list_transform(string_split(regexp_replace(party_name, '\s+', ' ', 'g'), ' '),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') END AS display_name
  FROM (SELECT record_id, key, trim(party_name) AS party_name FROM o_names)""")
def normalize_names(spark, d):
    from lamella.functions import text

    n = bind(spark, d, "b_names")
    return n.select("record_id", text.match_name(F.col("party_name")).alias("match_name"),
                    text.display_name(F.col("party_name")).alias("display_name"))


@query("entity_pairs", "SELECT * FROM o_pairs")
def entity_pairs(spark, d):
    names = stage(similarity.distinct_names(bind(spark, d, "b_names"), "record_id", "party_name", "state_code"), "names")
    return similarity.similar_pairs(names)


_CLUSTERS = """
WITH RECURSIVE reach(node, seen) AS (
  SELECT node, node FROM o_nodes
  UNION SELECT r.node, e.b FROM reach r JOIN (SELECT a_id AS a, b_id AS b FROM o_pairs WHERE decision = 'MERGE'
    UNION ALL SELECT b_id, a_id FROM o_pairs WHERE decision = 'MERGE'
    UNION ALL SELECT x.node, y.node FROM o_nodes x JOIN o_nodes y ON x.key = y.key AND x.node <> y.node) e ON r.seen = e.a),
clusters AS (SELECT node, min(seen) AS cluster FROM reach GROUP BY node)
"""


@query("party_master", _CLUSTERS.replace("WITH RECURSIVE", "WITH") + """,
members AS (SELECT cluster, party_name, n.state_code, count(*) AS n FROM o_names n JOIN o_nodes d ON n.block = d.block AND n.key = d.key
            JOIN clusters c ON d.node = c.node GROUP BY ALL),
best AS (SELECT cluster, party_name FROM (SELECT cluster, party_name, sum(n) AS n FROM members GROUP BY 1, 2)
         QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, party_name) = 1)
SELECT cluster, sha256(length(CAST(cluster AS VARCHAR)) || ':' || cluster) AS party_id, array_to_string(list_sort(list(DISTINCT m.party_name)), '|') AS variants,
  array_to_string(list_sort(list(DISTINCT state_code)), '|') AS states, CAST(sum(n) AS BIGINT) AS records,
  regexp_matches(any_value(best.party_name), '(?i)\\b(llc|inc)\\b') AS is_entity
FROM members m JOIN best USING (cluster) GROUP BY cluster""")
def party_master(spark, d):
    m = similarity.party_master(bind(spark, d, "b_names"), "record_id", "party_name", "state_code")
    return m.select("cluster", "party_id", F.array_join("party_name_variants", "|").alias("variants"),
                    F.array_join("states_appeared", "|").alias("states"), "records", "is_entity")


@query("party_registry", _CLUSTERS.replace("WITH RECURSIVE", "WITH") + """
SELECT array_to_string(list_sort(list(DISTINCT party_name)), '|') AS variants, array_to_string(list_sort(list(DISTINCT state_code)), '|') AS states,
  count(*) AS records, count(*) FILTER (record_id % 4 = 0) AS total_as_plaintiff, count(*) FILTER (record_id % 4 = 1) AS total_as_defendant,
  count(*) FILTER (record_id % 4 = 2) AS total_liens_as_debtor, count(*) FILTER (record_id % 4 = 3) AS total_liens_as_creditor
FROM (SELECT record_id, n.state_code, trim(party_name) AS party_name, cluster FROM o_names n JOIN o_nodes d ON n.block = d.block AND n.key = d.key
      JOIN clusters c ON d.node = c.node) GROUP BY cluster""")
def party_registry(spark, d):
    """All names in two batches, the second one against the index of the first; the SQL resolves them at once."""
    role = F.element_at(F.array(*(F.lit(r) for r in parties.ROLES)), (F.col("record_id") % 4 + 1).cast("int"))
    names = bind(spark, d, "b_names").withColumn("role", role)
    registry = parties.PartyRegistry(spark, new_folder(spark, "parties"))
    for batch in (0, 1):
        registry.add(names.where(F.col("record_id") % 2 == batch), f"batch {batch}", "party_name", "state_code")
    return registry.master().select(
        F.array_join("party_name_variants", "|").alias("variants"), F.array_join("states_appeared", "|").alias("states"),
        "records", *parties.ROLES.values())


_LIEN_FEEDS = {
    "UCC": """SELECT 'TX' AS _source_state, cast(s_suppkey AS string) AS file_number, '2000-01-05' AS file_date, s_name AS debtor_name,
      'FIRST BANK' AS secured_party, 'all assets' AS collateral_description,
      CASE WHEN s_acctbal < 0 THEN 'partial release' ELSE 'Active' END AS status, date '2001-08-01' AS _ingestion_date FROM {supplier}""",
    "FEDERAL_TAX": """SELECT 'NY' AS _source_state, cast(c_custkey AS string) AS serial_number, c_name AS taxpayer_name,
      concat('$', cast(cast(abs(c_acctbal) AS decimal(18,2)) AS string)) AS amount,
      CASE WHEN c_nationkey = 3 THEN 'soon' ELSE '1999-05-06' END AS filing_date,
      CASE WHEN c_acctbal < 0 THEN '2000-02-03' ELSE '' END AS release_date, date '2001-08-01' AS _ingestion_date FROM {customer}""",
    "JUDGMENT": """SELECT 'FL' AS _source_state, 'Dade' AS _source_county,
      CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE cast(o_orderkey AS string) END AS book_page,
      concat('C-', cast(o_orderkey AS string)) AS case_number, 'ACME INC' AS creditor, 'john  doe' AS debtor,
      cast(cast(o_totalprice AS decimal(18,2)) AS string) AS amount, cast(cast(o_orderdate AS date) AS string) AS filing_date,
      date '2001-08-01' AS _ingestion_date FROM {orders} WHERE o_orderstatus = 'F'""",
}


@query("silver_liens", """
SELECT 'UCC_TX_' || s_suppkey AS lien_id, 'UCC' AS lien_type, 'TX' AS state_code, NULL AS county, 'SOS' AS filing_office,
  date '2000-01-05' AS filing_date, NULL::DECIMAL(18,2) AS lien_amount,
  CASE WHEN s_acctbal < 0 THEN 'PARTIAL_RELEASE' ELSE 'ACTIVE' END AS lien_status, NULL::DATE AS release_date,
  NULL AS related_case_number, s_name AS debtor_name, 'FIRST BANK' AS creditor_name FROM supplier
UNION ALL SELECT 'FEDERAL_TAX_NY_' || c_custkey, 'FEDERAL_TAX', 'NY', NULL, 'COUNTY_RECORDER', date '1999-05-06',
  CAST(abs(c_acctbal) AS DECIMAL(18,2)), CASE WHEN c_acctbal < 0 THEN 'RELEASED' ELSE 'ACTIVE' END,
  CASE WHEN c_acctbal < 0 THEN date '2000-02-03' END, NULL, c_name, NULL FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT 'JUDGMENT_FL_' || o_orderkey, 'JUDGMENT', 'FL', 'Dade', 'COUNTY_RECORDER', CAST(o_orderdate AS DATE),
  CAST(o_totalprice AS DECIMAL(18,2)), 'ACTIVE', NULL, 'C-' || o_orderkey, 'John Doe', 'ACME INC'
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'""", money=("lien_amount",))
def silver_liens(spark, d):
    from lamella.plans import filings

    names = ("supplier", "customer", "orders")
    feeds = {
        kind: spark.sql(sql, **{n: bind(spark, d, n) for n in names if f"{{{n}}}" in sql}) for kind, sql in _LIEN_FEEDS.items()
    }
    valid = filings.canonical_liens(feeds, "_ingestion_date", ["_ingestion_date"])[0]
    return valid.select("lien_id", "lien_type", "state_code", "county", "filing_office", "filing_date", "lien_amount",
                        "lien_status", "release_date", "related_case_number", "debtor_name", "creditor_name")


@query("silver_judgments", """SELECT state_code || '_' || case_number || '_' || judgment_date AS judgment_id, state_code, case_number,
  judgment_date, judgment_type, judgment_amount, county, satisfaction_date,
  CASE WHEN debtor_key % 7 = 0 THEN 'VACATED' WHEN debtor_key % 7 = 1 THEN 'PARTIALLY_SATISFIED' ELSE satisfaction_status END AS satisfaction_status
  FROM b_judgments WHERE debtor_key % 50 <> 0""", money=("judgment_amount",))
def silver_judgments(spark, d):
    from lamella.plans import filings

    raw = bind(spark, d, "b_judgments").select(
        F.col("state_code").alias("_source_state"),
        F.when(F.col("debtor_key") % 50 == 0, "").otherwise(F.concat(F.lit(" "), "case_number")).alias("case_number"),
        F.col("judgment_date").cast("string").alias("judgment_date"),
        F.lower(F.replace("judgment_type", F.lit("_"), F.lit(" "))).alias("judgment_type"),
        F.concat(F.lit("$"), F.col("judgment_amount").cast("string")).alias("amount"),
        F.expr("""CASE WHEN debtor_key % 7 = 0 THEN 'Vacated' WHEN debtor_key % 7 = 1 THEN ' partially satisfied'
                  WHEN satisfaction_status = 'SATISFIED' THEN 'Y' ELSE 'N' END""").alias("satisfied"),
        F.col("satisfaction_date").cast("string").alias("satisfaction_date"), F.concat("county", F.lit(" ")).alias("county"),
        F.lit("2001-08-01").cast("date").alias("_ingestion_date"))
    valid = filings.canonical_judgments({"STATE": raw}, "_ingestion_date", ["_ingestion_date"])[0]
    return valid.select("judgment_id", "state_code", "case_number", "judgment_date", "judgment_type", "judgment_amount",
                        "county", "satisfaction_date", "satisfaction_status")
