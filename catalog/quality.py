"""Data quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import commerce as c
from catalog import records as r
from catalog.bindings import DERIVED, bind
from catalog.registry import half_up, query
from lamella.operators import quality as q
from lamella.operators.mapping import suit_rules
from lamella.operators.validate import SplitOnce, tag
from lamella.plans import commerce, gates, records

REF = "2001-08-02"
SHOWN = ["check_name", "records_checked", "records_passed", "records_failed", "pass_rate", "threshold", "status"]
STATUSES = "('completed', 'shipped', 'processing', 'cancelled', 'refunded')"
CASE_TYPES = "('" + "', '".join(records.CASE_TYPES) + "')"
CASE_STATUSES = "('" + "', '".join(records.CASE_STATUSES) + "')"
STATES = "('TX', 'CA', 'NY', 'FL', 'IL', 'OH')"


def run(df: DataFrame, checks: list[q.Check], layer: str, table: str) -> DataFrame:
    return q.run_suite(df, checks, layer, table, F.lit(None).cast("timestamp"))


def shown(df: DataFrame, checks: list[q.Check], layer: str = "bronze", table: str = "t") -> DataFrame:
    return run(df, checks, layer, table).select(*SHOWN)


def oracle(table: str, checks: list[tuple], columns: str = "") -> str:
    """SQL of a suite: (name, SQL counting passed rows, threshold[, lowest WARN rate])."""
    parts = []
    for name, passed, threshold, *warn in checks:
        floor = warn[0] if warn else 80
        parts.append(f"""
SELECT '{name}' AS check_name, total AS records_checked, passed AS records_passed, total - passed AS records_failed,
  CASE WHEN total > 0 THEN passed / total * 100 ELSE 100.0::DOUBLE END AS pass_rate, {float(threshold)}::DOUBLE AS threshold,
  CASE WHEN total = 0 OR passed / total * 100 >= {threshold} THEN 'PASS' WHEN passed / total * 100 >= {floor} THEN 'WARN'
       ELSE 'FAIL' END AS status{columns}
FROM (SELECT count(*) AS total, {passed} AS passed FROM {table})""")
    return " UNION ALL ".join(parts)


def _if(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


GATE_ORDERS = [
    ("not_null_order_id", "count(order_id)", 95), ("not_null_customer_id", "count(customer_id)", 95),
    ("not_null_order_date", "count(order_date)", 95), ("unique_order_id", "count(DISTINCT order_id)", 100),
    ("accepted_values_status", _if(f"status IN {STATUSES}"), 95),
    ("range_total_amount", _if("try_cast(total_amount AS DOUBLE) BETWEEN 0 AND 100000"), 95),
]


@query("dq_not_null", oracle("b_orders", [
    ("not_null_customer_id", "count(customer_id)", 95), ("not_null_order_id", _if("order_id <> ''"), 95),
    ("not_null__ingestion_date", "count(_ingestion_date)", 100)]))
def dq_not_null(spark, d):
    return shown(bind(spark, d, "b_orders"), [
        q.not_null("customer_id"), q.not_null("order_id", empty_is_null=True),
        q.not_null("_ingestion_date", 100.0, empty_is_null=True)])


DERIVED["o_status_null"] = "SELECT order_item_id, nullif(quantity, '7') AS quantity FROM b_order_items"


@query("dq_unique", oracle("o_status_null", [
    ("unique_order_item_id", "count(DISTINCT order_item_id)", 100), ("unique_quantity", "count(DISTINCT quantity)", 90),
    ("unique_quantity_with_null", "count(DISTINCT quantity) + 1", 100, 90)]))
def dq_unique(spark, d):
    df = bind(spark, d, "b_order_items").withColumn("quantity", F.nullif(F.col("quantity"), F.lit("7")))
    return shown(df, [q.unique("order_item_id"), q.unique("quantity", 90.0),
                      q.unique("quantity", null_counts=True, warn_from=90.0, label="unique_quantity_with_null")])


@query("dq_accepted", oracle("b_orders", [
    ("accepted_values_status", _if(f"status IN {STATUSES}"), 95),
    ("accepted_values_payment_method", _if("payment_method IN ('HIGH', 'LOW', 'URGENT', 'MEDIUM')"), 50)]))
def dq_accepted(spark, d):
    return shown(bind(spark, d, "b_orders"), [
        q.accepted_values("status", commerce.ORDER_STATUSES),
        q.accepted_values("payment_method", ["HIGH", "LOW", "URGENT", "MEDIUM"], 50.0)])


@query("dq_accepted_sample", f"""
SELECT check_name, string_agg(value, '|' ORDER BY value) AS invalid_values FROM (
  SELECT 'accepted_values_status' AS check_name, value, row_number() OVER (ORDER BY value) AS rn
  FROM (SELECT DISTINCT status AS value FROM b_orders WHERE status NOT IN {STATUSES})
  UNION ALL SELECT 'accepted_values_total_amount', value, row_number() OVER (ORDER BY value)
  FROM (SELECT DISTINCT total_amount AS value FROM b_orders WHERE total_amount <> 'not_a_number')) WHERE rn <= 5 GROUP BY 1""")
def dq_accepted_sample(spark, d):
    checks = [q.accepted_values("status", commerce.ORDER_STATUSES), q.accepted_values("total_amount", ["not_a_number"])]
    out = q.bad_value_sample(bind(spark, d, "b_orders"), checks)
    return out.select("check_name", F.array_join("invalid_values", "|").alias("invalid_values"))


@query("dq_range", oracle("b_orders", [
    ("range_total_amount", _if("try_cast(total_amount AS DOUBLE) BETWEEN 0 AND 400000"), 95),
    ("at_least", _if("try_cast(total_amount AS DOUBLE) >= 1000"), 95), ("no_bounds", "count(*)", 95)]))
def dq_range(spark, d):
    return shown(bind(spark, d, "b_orders"), [
        q.in_range("total_amount", 0, 400000), q.in_range("total_amount", 1000, label="at_least"),
        q.in_range("total_amount", label="no_bounds")])


@query("dq_status", oracle("b_orders", [
    ("pass", _if("order_date <> 'INVALID'"), 95), ("warn", _if("total_amount <> 'not_a_number'"), 99.9),
    ("fail", _if("status = 'completed'"), 95)]) + " UNION ALL " + oracle("(SELECT * FROM b_orders WHERE false)", [("empty", "count(*)", 100)]))
def dq_status(spark, d):
    orders = bind(spark, d, "b_orders")
    checks = [
        q.holds("pass", F.col("order_date") != "INVALID"), q.holds("warn", F.col("total_amount") != "not_a_number", 99.9),
        q.holds("fail", F.col("status") == "completed")]
    none = shown(orders.where(F.lit(False)), [q.holds("empty", F.lit(True), 100.0)])
    return shown(orders, checks).unionByName(none)


@query("dq_suite", "SELECT *, 'ok' AS outcome FROM (" + oracle("b_orders", GATE_ORDERS) + """)
UNION ALL SELECT 'not_null_no_such_column', count(*), 0, count(*), 0.0, 95.0, 'FAIL', 'error' FROM b_orders""")
def dq_suite(spark, d):
    checks = [*gates.suites(REF)["bronze", "orders"], q.not_null("no_such_column")]
    out = run(bind(spark, d, "b_orders"), checks, "bronze", "orders")
    return out.select(*SHOWN, F.when(F.col("details").startswith("Check error"), "error").otherwise("ok").alias("outcome"))


def _gate(name: str, key: tuple[str, str], table, sql_table: str, checks: list[tuple]):
    @query(name, oracle(sql_table, checks))
    def gate(spark, d):
        return shown(table(spark, d), gates.suites(REF)[key], *key)


_gate("gate_customers", ("bronze", "customers"), lambda s, d: bind(s, d, "b_customers"), "b_customers", [
    ("not_null_customer_id", "count(customer_id)", 95), ("not_null_email", "count(email)", 95),
    ("unique_customer_id", "count(DISTINCT customer_id)", 90)])
_gate("gate_orders", ("bronze", "orders"), lambda s, d: bind(s, d, "b_orders"), "b_orders", GATE_ORDERS)
_gate("gate_silver_customers", ("silver", "customers"), c.customers, "o_customers", [
    ("unique_customer_id", "count(DISTINCT customer_id)", 100), ("not_null_customer_id", "count(customer_id)", 100),
    ("not_null_email", "count(email)", 100), ("accepted_values_is_active", "count(is_active)", 100)])
_gate("gate_silver_orders", ("silver", "orders"), c.orders, "o_orders", [
    ("unique_order_id", "count(DISTINCT order_id)", 100), ("not_null_order_id", "count(order_id)", 100),
    ("not_null_customer_id", "count(customer_id)", 100), ("accepted_values_status", _if(f"status IN {STATUSES}"), 100),
    ("not_null_total_amount", "count(total_amount)", 100)])
_gate("gate_silver_items", ("silver", "order_items"), c.items, "o_items", [
    ("unique_order_item_id", "count(DISTINCT order_item_id)", 100), ("not_null_order_item_id", "count(order_item_id)", 100)])
_gate("gate_silver_products", ("silver", "products"), c.products, "o_products", [
    ("unique_product_id", "count(DISTINCT product_id)", 100), ("not_null_product_id", "count(product_id)", 100),
    ("not_null_category", "count(category)", 100)])
_gate("gate_customer_360", ("gold", "customer_360"), c.customer_360, "o_360", [
    ("not_null_customer_id", "count(customer_id)", 95), ("unique_customer_id", "count(DISTINCT customer_id)", 100),
    ("accepted_values_ltv_tier", _if("ltv_tier IN ('platinum', 'gold', 'silver', 'bronze')"), 95),
    ("range_total_revenue", _if("total_revenue >= 0"), 95), ("range_total_orders", _if("total_orders >= 0"), 95)])
_gate("gate_daily_revenue", ("gold", "daily_revenue"), c.daily_revenue, "o_daily", [
    ("unique_order_date", "count(DISTINCT order_date)", 100), ("not_null_order_date", "count(order_date)", 100),
    ("not_null_total_revenue", "count(cents)", 100), ("not_null_order_count", "count(order_count)", 100)])
_gate("gate_product_performance", ("gold", "product_performance"), c.product_performance, """(SELECT product_id, category, count(*) AS n
  FROM o_items JOIN o_orders USING (order_id) JOIN o_products USING (product_id)
  WHERE status IN ('completed', 'shipped', 'processing') GROUP BY 1, 2)""", [
    ("unique_product_id", "count(DISTINCT product_id)", 100), ("not_null_product_id", "count(product_id)", 100),
    ("not_null_category", "count(category)", 100), ("not_null_total_revenue", "count(n)", 100), ("not_null_units_sold", "count(n)", 100)])
_gate("gate_suits_bronze", ("bronze", "suits"), lambda s, d: r.canonical(s, d), "o_canon", [
    ("not_null_case_number", _if("case_number <> ''"), 95), ("not_null_filing_date", "count(filing_date)", 95),
    ("not_null_plaintiff_name", _if("plaintiff_name <> ''"), 95), ("accepted_values_state_code", _if(f"state_code IN {STATES}"), 95),
    ("filing_date_not_future", _if(f"filing_date <= date '{REF}'"), 95), ("has_party", _if("plaintiff_name <> ''"), 95),
    ("amount_non_negative", _if("coalesce(amount_demanded >= 0, true)"), 95)])
_gate("gate_suits_silver", ("silver", "suits"), r.suits, "o_suits", [
    ("unique_suit_id", "count(DISTINCT suit_id)", 100, 90), ("not_null_suit_id", "count(suit_id)", 99),
    ("not_null_filing_date", "count(filing_date)", 99), ("accepted_values_case_type", _if(f"case_type IN {CASE_TYPES}"), 98),
    ("accepted_values_case_status", _if(f"case_status IN {CASE_STATUSES}"), 98),
    ("accepted_values_state_code", _if(f"state_code IN {STATES}"), 98),
    ("filing_date_not_future", _if(f"filing_date <= date '{REF}'"), 98)])
_gate("gate_suits_gold", ("gold", "suit_best_view"), r.best_view, "o_best", [
    ("unique_suit_id", "count(DISTINCT suit_id)", 100, 90), ("not_null_primary_plaintiff", _if("primary_plaintiff <> ''"), 95),
    ("not_null_state_code", "count(state_code)", 100), ("range_days_open", _if("days_open >= 0"), 99),
    ("has_party", _if("plaintiff_count + defendant_count > 0"), 99)])


@query("dq_validity", oracle("o_canon", [
    ("parsable_filing_date", "count(filing_date)", 98), ("filed_before_2001", _if("filing_date <= date '2000-12-31'"), 95),
    ("amount_non_negative", _if("coalesce(amount_demanded >= 0, true)"), 95),
    ("valid_state", _if(f"state_code IN {STATES}"), 95), ("has_party", _if("plaintiff_name <> '' OR defendant_name <> ''"), 95)]))
def dq_validity(spark, d):
    from lamella.functions import text

    party = text.is_filled(F.col("plaintiff_name")) | text.is_filled(F.col("defendant_name"))
    return shown(r.canonical(spark, d), [
        q.holds("parsable_filing_date", F.col("filing_date").isNotNull(), 98.0),
        q.holds("filed_before_2001", F.col("filing_date") <= F.lit("2000-12-31").cast("date")),
        q.holds("amount_non_negative", F.coalesce(F.col("amount_demanded") >= 0, F.lit(True))),
        q.holds("valid_state", F.col("state_code").isin(records.STATES)),
        q.holds("has_party", party)])


@query("dq_reject_rate", oracle("o_order_reasons", [("reject_rate", _if("reasons = ''"), 95)]))
def dq_reject_rate(spark, d):
    tagged = tag(bind(spark, d, "b_orders"), commerce.order_rules())
    return shown(tagged, [q.holds("reject_rate", F.size("_reasons") == 0)])


@query("dq_report", "SELECT 'bronze' AS layer, 'orders' AS table_name, count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed, "
       "count(*) FILTER (status = 'WARN') AS warned, count(*) FILTER (status = 'FAIL') AS failed, "
       "string_agg(check_name, ', ' ORDER BY check_name) FILTER (status <> 'PASS') AS not_passed FROM ("
       + oracle("b_orders", GATE_ORDERS) + ")")
def dq_report(spark, d):
    return q.report(run(bind(spark, d, "b_orders"), gates.suites(REF)["bronze", "orders"], "bronze", "orders"))


@query("gate_enforce")
def gate_enforce(spark, d):
    """The gate lets a good table through and stops a bad one."""
    good = run(c.orders(spark, d), gates.suites(REF)["silver", "orders"], "silver", "orders")
    bad = run(bind(spark, d, "b_orders"), [q.accepted_values("status", ["lost"], 100.0)], "bronze", "orders")
    outcome = []
    for name, results in (("good", good), ("bad", bad)):
        try:
            q.enforce(results)
            outcome.append((name, False, ""))
        except q.GateFailed as stop:
            outcome.append((name, True, str(stop)))
    return spark.createDataFrame(outcome, "suite string, stopped boolean, reason string")


@query("dq_reconcile", f"""
SELECT state_code, bronze, silver, rejected, gold, bronze - silver - rejected AS duplicates,
  {half_up("abs(gold - silver) * 100", "silver", 2)} AS variance_pct,
  CASE WHEN bronze - silver - rejected < 0 OR silver > bronze THEN 'FAIL'
       WHEN abs(gold - silver) * 100 > 5 * silver THEN 'WARN' ELSE 'PASS' END AS status
FROM (SELECT state_code, count(*) AS bronze, count(*) FILTER (case_number = '' OR filing_date IS NULL) AS rejected FROM o_canon GROUP BY 1)
JOIN (SELECT state_code, count(*) AS silver, count(*) FILTER (case_status <> 'SEALED') AS gold FROM o_suits GROUP BY 1) USING (state_code)""")
def dq_reconcile(spark, d):
    split = SplitOnce("reconcile")
    valid, rejected = records.silver_suits(r.canonical(spark, d), r.NEWEST, split)
    return q.reconcile(split.rows, valid, rejected, valid.where("case_status != 'SEALED'"), "state_code", 5.0)


@query("quarantine_report", """
SELECT CAST(date_trunc('week', _ingestion_date) AS DATE) AS week, state_code, reason, count(*) AS rows FROM (
  SELECT state_code, _ingestion_date, 'MISSING_CASE_NUMBER' AS reason FROM o_canon WHERE case_number = ''
  UNION ALL SELECT state_code, _ingestion_date, 'BAD_FILING_DATE' FROM o_canon WHERE filing_date IS NULL) GROUP BY ALL""")
def quarantine_report(spark, d):
    rejected = tag(r.canonical(spark, d), suit_rules())
    return q.quarantine_report(rejected, "_ingestion_date", ["state_code"])


@query("quarantine_spike", f"""
SELECT day, volume, baseline, CASE WHEN baseline IS NOT NULL THEN volume > 2 * baseline END AS is_spike FROM (
  SELECT day, volume, CASE WHEN count(*) OVER w = 7 THEN {half_up("sum(volume) OVER w", "7", 2)} END AS baseline
  FROM (SELECT CAST(order_date AS DATE) AS day, count(*) AS volume FROM o_order_reasons
        WHERE reasons <> '' AND try_cast(order_date AS DATE) IS NOT NULL GROUP BY 1)
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""")
def quarantine_spike(spark, d):
    rejected = commerce.silver_orders(bind(spark, d, "b_orders"), c.NEWEST)[1]
    days = rejected.select(F.col("order_date").try_cast("date").alias("day")).where("day is not null")
    return q.volume_spikes(days, "day")


@query("missing_partitions", """
SELECT day FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)
WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def missing_partitions(spark, d):
    days = bind(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    calendar = commerce.calendar_of(spark, days.withColumnRenamed("day", "order_date"))
    return q.missing_partitions(days, "day", calendar)


@query("freshness_lag", """SELECT bronze_newest, gold_newest,
  CAST(floor((floor(epoch(gold_newest)) - floor(epoch(bronze_newest))) / 60) AS BIGINT) AS lag_minutes,
  CASE WHEN abs(floor(epoch(gold_newest)) - floor(epoch(bronze_newest))) <= 4 * 3600 THEN 'PASS'
       WHEN abs(floor(epoch(gold_newest)) - floor(epoch(bronze_newest))) <= 8 * 3600 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT max(ts) AS bronze_newest, max(ts) FILTER (event_type = 'purchase') AS gold_newest FROM events)""")
def freshness_lag(spark, d):
    e = bind(spark, d, "events")
    out = q.freshness(e, "ts", e.where("event_type = 'purchase'"), "ts", 4, 8)
    return out.withColumns({t: F.col(t).cast("timestamp_ntz") for t in ("bronze_newest", "gold_newest")})


@query("dq_rollup_match", """SELECT CAST(sum(suit_count) AS BIGINT) AS summary_rows, (SELECT count(*) FROM o_best) AS detail_rows,
  sum(suit_count) = (SELECT count(*) FROM o_best) AS matches FROM o_summary""")
def dq_rollup_match(spark, d):
    best = r.best_view(spark, d)
    return q.rollup_matches(records.state_summary(best), "suit_count", best)
