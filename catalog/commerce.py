"""Commerce queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import DERIVED, bind
from catalog.registry import half_up, query
from lamella.functions import numbers, scoring
from lamella.operators.validate import REASONS, tag
from lamella.plans import commerce
from lamella.plans.customer_store import CustomerStore
from lamella.staging import new_folder

REF = "2001-08-02"
NEWEST = "_ingestion_date"


def customers(spark: SparkSession, d: str) -> DataFrame:
    return commerce.silver_customers(bind(spark, d, "b_customers"), NEWEST)[0]


def orders(spark: SparkSession, d: str) -> DataFrame:
    return commerce.silver_orders(bind(spark, d, "b_orders"), NEWEST)[0]


def items(spark: SparkSession, d: str) -> DataFrame:
    return commerce.silver_order_items(bind(spark, d, "b_order_items"), NEWEST)[0]


def products(spark: SparkSession, d: str) -> DataFrame:
    return commerce.silver_products(bind(spark, d, "b_products"), NEWEST)[0]


DERIVED["o_customers"] = """
SELECT customer_id, lower(trim(email)) AS email, trim(first_name) AS first_name, trim(last_name) AS last_name,
       trim(city) AS city, upper(trim(state)) AS state, CAST(signup_date AS DATE) AS signup_date,
       coalesce(lower(trim(is_active)) = 'true', false) AS is_active,
       _batch_id AS _bronze_batch_id, '1.0.0' AS _silver_version
FROM b_customers
WHERE trim(customer_id) <> '' AND email LIKE '%@%' AND trim(first_name) <> ''
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingestion_date DESC, email, first_name, last_name,
                           city, state, signup_date, is_active, _batch_id) = 1
"""
DERIVED["o_orders"] = """
SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date, lower(trim(status)) AS status,
       CAST(total_amount AS DECIMAL(18,2)) AS total_amount, lower(trim(payment_method)) AS payment_method,
       _batch_id AS _bronze_batch_id, '1.0.0' AS _silver_version
FROM b_orders
WHERE order_id <> '' AND customer_id <> '' AND try_cast(order_date AS DATE) IS NOT NULL
  AND lower(trim(status)) IN ('completed', 'shipped', 'processing', 'cancelled', 'refunded')
  AND try_cast(total_amount AS DECIMAL(18,2)) >= 0
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_date DESC, customer_id, order_date, status,
                           total_amount, payment_method, _batch_id) = 1
"""
DERIVED["o_items"] = """
SELECT order_item_id, order_id, product_id, CAST(quantity AS INT) AS quantity,
       CAST(unit_price AS DECIMAL(18,2)) AS unit_price, CAST(line_total AS DECIMAL(18,2)) AS line_total,
       _batch_id AS _bronze_batch_id, '1.0.0' AS _silver_version
FROM b_order_items
WHERE try_cast(quantity AS INT) > 0 AND try_cast(unit_price AS DECIMAL(18,2)) > 0
QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY _ingestion_date DESC, order_id, product_id, quantity,
                           unit_price, line_total, _batch_id) = 1
"""
DERIVED["o_products"] = f"""
SELECT product_id, trim(name) AS name, trim(category) AS category, price, cost,
       {half_up("(price - cost) * 10000", "price * 100", 2)} AS margin_pct,
       _batch_id AS _bronze_batch_id, '1.0.0' AS _silver_version
FROM (SELECT product_id, name, category, CAST(price AS DECIMAL(18,2)) AS price, CAST(cost AS DECIMAL(18,2)) AS cost,
             _batch_id FROM b_products)
WHERE price > 0
"""
DERIVED["o_daily"] = """
SELECT order_date, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(total_amount) * 100 AS BIGINT) AS cents
FROM o_orders WHERE status IN ('completed', 'shipped', 'processing') GROUP BY order_date
"""
DERIVED["o_metrics"] = f"""
SELECT customer_id, count(*) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       {half_up("sum(total_amount) * 100", "count(*) * 100", 2)} AS avg_order_value,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders,
       count(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END) AS cancelled_orders
FROM o_orders WHERE status <> 'refunded' GROUP BY customer_id
"""
DERIVED["o_profile"] = """
SELECT c.*, coalesce(total_orders, 0) AS total_orders, coalesce(total_revenue, 0) AS total_revenue,
       coalesce(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
       coalesce(completed_orders, 0) AS completed_orders, coalesce(cancelled_orders, 0) AS cancelled_orders
FROM o_customers c LEFT JOIN o_metrics m ON c.customer_id = m.customer_id
"""


def _bucket(rank: str) -> str:
    return f"greatest(1, (({rank} - 1) * 5 + (n - 1) - 1) // (n - 1))"


DERIVED["o_rfm"] = f"""
SELECT customer_id, recency_days, 6 - {_bucket("rr")} AS r_score, {_bucket("fr")} AS f_score, {_bucket("mr")} AS m_score
FROM (SELECT customer_id, date '{REF}' - last_order_date AS recency_days, count(*) OVER () AS n,
             row_number() OVER (ORDER BY date '{REF}' - last_order_date, customer_id) AS rr,
             row_number() OVER (ORDER BY total_orders, customer_id) AS fr,
             row_number() OVER (ORDER BY total_revenue, customer_id) AS mr
      FROM o_profile WHERE total_orders > 0)
"""
_SEGMENT = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
  WHEN r_score >= 4 AND f_score >= 3 THEN 'Loyal' WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
  WHEN r_score >= 3 AND f_score >= 2 AND m_score >= 2 THEN 'Potential Loyalists'
  WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
  WHEN r_score = 3 AND f_score <= 2 THEN 'About to Sleep'
  WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 3 THEN 'Cant Lose Them' ELSE 'Other' END"""
_TIER = """CASE WHEN total_revenue >= 5000 THEN 'platinum' WHEN total_revenue >= 1000 THEN 'gold'
  WHEN total_revenue >= 250 THEN 'silver' ELSE 'bronze' END"""
DERIVED["o_360"] = f"""
SELECT p.customer_id, email, first_name, last_name, city, state, signup_date, is_active, total_orders, total_revenue,
       avg_order_value, first_order_date, last_order_date,
       coalesce(date '{REF}' - last_order_date, -1) AS days_since_last_order,
       {half_up(f"greatest(date '{REF}' - signup_date, 1)", "greatest(total_orders, 1)", 1)} AS order_frequency_days,
       completed_orders, cancelled_orders, {_TIER} AS ltv_tier,
       coalesce(r_score * 100 + f_score * 10 + m_score, 0) AS rfm_score,
       CASE WHEN r_score IS NULL THEN 'No Orders' ELSE {_SEGMENT} END AS rfm_segment,
       '{REF}' AS _gold_computed_at, '1.0.0' AS _gold_version
FROM o_profile p LEFT JOIN o_rfm r ON p.customer_id = r.customer_id
"""


def _reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join(REASONS, ",")).drop(REASONS)


_CUSTOMER_REASONS = """concat_ws(',', CASE WHEN NOT coalesce(trim(customer_id) <> '', false) THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN NOT coalesce(email LIKE '%@%', false) THEN 'BAD_EMAIL' END,
  CASE WHEN NOT coalesce(trim(first_name) <> '', false) THEN 'MISSING_FIRST_NAME' END)"""
_ORDER_REASONS = """concat_ws(',', CASE WHEN order_id = '' THEN 'MISSING_ORDER_ID' END,
  CASE WHEN customer_id = '' THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN try_cast(order_date AS DATE) IS NULL THEN 'BAD_ORDER_DATE' END,
  CASE WHEN lower(trim(status)) NOT IN ('completed','shipped','processing','cancelled','refunded') THEN 'BAD_STATUS' END,
  CASE WHEN NOT coalesce(try_cast(total_amount AS DECIMAL(18,2)) >= 0, false) THEN 'BAD_AMOUNT' END)"""
DERIVED["o_order_reasons"] = f"SELECT *, {_ORDER_REASONS} AS reasons FROM b_orders"


@query("validate_customers", f"SELECT *, {_CUSTOMER_REASONS} AS reasons FROM b_customers")
def validate_customers(spark, d):
    return _reasons(tag(bind(spark, d, "b_customers"), commerce.customer_rules()))


@query("validate_orders", "SELECT * FROM o_order_reasons")
def validate_orders(spark, d):
    return _reasons(tag(bind(spark, d, "b_orders"), commerce.order_rules()))


@query("validate_items", """
SELECT *, concat_ws(',', CASE WHEN NOT coalesce(try_cast(quantity AS INT) > 0, false) THEN 'BAD_QUANTITY' END,
  CASE WHEN NOT coalesce(try_cast(unit_price AS DECIMAL(18,2)) > 0, false) THEN 'BAD_UNIT_PRICE' END) AS reasons
FROM b_order_items""")
def validate_items(spark, d):
    return _reasons(tag(bind(spark, d, "b_order_items"), commerce.item_rules()))


@query("quarantine_split", "SELECT * FROM o_order_reasons WHERE reasons <> ''")
def quarantine_split(spark, d):
    return _reasons(commerce.silver_orders(bind(spark, d, "b_orders"), NEWEST)[1])


@query("dedupe_latest", """
SELECT * FROM b_order_items QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY _ingestion_date DESC,
  order_id, product_id, quantity, unit_price, line_total, _batch_id) = 1""")
def dedupe_latest(spark, d):
    from lamella.operators.dedupe import latest

    return latest(bind(spark, d, "b_order_items"), ["order_item_id"], NEWEST)


@query("standardize_customers", "SELECT * FROM o_customers")
def standardize_customers(spark, d):
    return customers(spark, d)


@query("silver_orders", "SELECT * FROM o_orders", money=("total_amount",))
def silver_orders(spark, d):
    return orders(spark, d)


@query("silver_order_items", "SELECT * FROM o_items", money=("unit_price", "line_total",))
def silver_order_items(spark, d):
    return items(spark, d)


@query("standardize_products", "SELECT * FROM o_products", money=("price", "cost",))
def standardize_products(spark, d):
    return products(spark, d)


@query("customer_order_metrics", "SELECT * FROM o_metrics")
def customer_order_metrics(spark, d):
    m = commerce.customer_order_metrics(orders(spark, d))
    return m.withColumn("total_revenue", F.col("total_revenue").cast("double")).drop("rfm_orders", "rfm_revenue")


@query("ltv_tier", f"SELECT customer_id, total_revenue, {_TIER} AS ltv_tier FROM o_metrics")
def ltv_tier(spark, d):
    m = commerce.customer_order_metrics(orders(spark, d))
    return m.select("customer_id", F.col("total_revenue").cast("double").alias("total_revenue"),
                    scoring.ltv_tier(F.col("total_revenue")).alias("ltv_tier"))


def _scored(spark, d, months=None):
    from lamella.staging import stage

    m = commerce.customer_order_metrics(orders(spark, d), reference_date=REF, window_months=months)
    known = m.join(customers(spark, d).select("customer_id"), "customer_id", "left_semi")
    return commerce.rfm_scores(stage(known, "metrics"), REF)


@query("rfm_scores", """SELECT customer_id, recency_days, r_score, f_score, m_score,
  r_score * 100 + f_score * 10 + m_score AS rfm_score FROM o_rfm""")
def rfm_scores(spark, d):
    out = _scored(spark, d)
    return out.select("customer_id", *[F.col(c).cast("long").alias(c) for c in (
        "recency_days", "r_score", "f_score", "m_score", "rfm_score")])


@query("rfm_scores_12_months", f"""
SELECT customer_id, rfm_orders, 6 - {_bucket("rr")} AS r_score, {_bucket("fr")} AS f_score, {_bucket("mr")} AS m_score
FROM (SELECT *, count(*) OVER () AS n,
             row_number() OVER (ORDER BY date '{REF}' - last_order_date, customer_id) AS rr,
             row_number() OVER (ORDER BY rfm_orders, customer_id) AS fr,
             row_number() OVER (ORDER BY rfm_revenue, customer_id) AS mr
      FROM (SELECT customer_id, max(order_date) AS last_order_date,
                   count(*) FILTER (order_date >= date '{REF}' - INTERVAL 12 MONTH) AS rfm_orders,
                   coalesce(sum(total_amount) FILTER (order_date >= date '{REF}' - INTERVAL 12 MONTH), 0) AS rfm_revenue
            FROM o_orders WHERE status <> 'refunded' AND customer_id IN (SELECT customer_id FROM o_customers)
            GROUP BY customer_id))""")
def rfm_scores_12_months(spark, d):
    out = _scored(spark, d, 12)
    return out.select("customer_id", *[F.col(c).cast("long").alias(c) for c in (
        "rfm_orders", "r_score", "f_score", "m_score")])


@query("rfm_segments", f"SELECT customer_id, {_SEGMENT} AS rfm_segment FROM o_rfm")
def rfm_segments(spark, d):
    return _scored(spark, d).select("customer_id", "rfm_segment")


@query("customer_360", "SELECT * FROM o_360")
def customer_360(spark, d):
    return commerce.customer_360(customers(spark, d), orders(spark, d), REF)


@query("segment_counts", """SELECT 'ltv_tier' AS metric, ltv_tier AS value, count(*) AS rows FROM o_360 GROUP BY ltv_tier
UNION ALL SELECT 'rfm_segment', rfm_segment, count(*) FROM o_360 GROUP BY rfm_segment""")
def segment_counts(spark, d):
    return commerce.value_counts(customer_360(spark, d), ["ltv_tier", "rfm_segment"])


@query("customer_360_incremental", "SELECT * FROM o_metrics")
def customer_360_incremental(spark, d):
    raw = bind(spark, d, "b_orders")
    before = commerce.silver_orders(raw.where("_batch_id = 'b1'"), NEWEST)[0]
    batch = raw.where("_batch_id = 'b2'").select("order_id", "customer_id")
    m = commerce.refresh_order_metrics(commerce.customer_order_metrics(before), before, orders(spark, d), batch)
    return m.withColumn("total_revenue", F.col("total_revenue").cast("double")).drop("rfm_orders", "rfm_revenue")


@query("customer_360_batches", "SELECT * FROM o_360")
def customer_360_batches(spark, d):
    """Kept up to date over three batches: orders before 1995, the others, and the corrections."""
    raw, people = bind(spark, d, "b_orders"), bind(spark, d, "b_customers")
    first, early = F.col("_batch_id") == "b1", F.col("order_date") < "1995-01-01"
    store = CustomerStore(spark, new_folder(spark, "customer_store"))
    for name, of_people, of_orders in (("early", first, first & early), ("late", F.lit(False), first & ~early), ("changes", ~first, ~first)):
        store.add(commerce.silver_customers(people.where(of_people), NEWEST)[0],
                  commerce.silver_orders(raw.where(of_orders), NEWEST)[0], name, REF)
    return store.table()


_ROLL = "sum(cents) OVER (ORDER BY order_date ROWS {n} PRECEDING)", "count(*) OVER (ORDER BY order_date ROWS {n} PRECEDING) * 100"


def _rolling(rows: int) -> str:
    return half_up(_ROLL[0].format(n=rows - 1), _ROLL[1].format(n=rows - 1), 2)


@query("daily_revenue", f"""
SELECT order_date, order_count, unique_customers, cents / 100 AS total_revenue,
       {half_up("cents", "order_count * 100", 2)} AS avg_order_value,
       {_rolling(7)} AS revenue_7d_avg, {_rolling(30)} AS revenue_30d_avg,
       CASE WHEN prev > 0 THEN {half_up("(cents - prev) * 100", "prev", 2)} END AS revenue_yoy_pct
FROM (SELECT *, lag(cents, 365) OVER (ORDER BY order_date) AS prev FROM o_daily)""")
def daily_revenue(spark, d):
    return commerce.daily_revenue(orders(spark, d))


@query("revenue_yoy_calendar", f"""
SELECT a.order_date, a.cents / 100 AS total_revenue, b.cents / 100 AS previous_year_revenue,
       CASE WHEN b.cents > 0 THEN {half_up("(a.cents - b.cents) * 100", "b.cents", 2)} END AS revenue_yoy_pct
FROM o_daily a LEFT JOIN o_daily b ON b.order_date = CAST(a.order_date - INTERVAL 12 MONTH AS DATE)""")
def revenue_yoy_calendar(spark, d):
    return commerce.revenue_yoy_calendar(orders(spark, d))


@query("category_breakdown", """
SELECT order_date, '{' || string_agg('"' || category || '":' || revenue, ',' ORDER BY category) || '}'
  AS product_category_breakdown
FROM (SELECT order_date, category, CAST(sum(line_total) AS DECIMAL(20,2)) AS revenue
      FROM o_items JOIN o_orders USING (order_id) JOIN o_products USING (product_id)
      WHERE status IN ('completed', 'shipped', 'processing') GROUP BY ALL)
GROUP BY order_date""")
def category_breakdown(spark, d):
    return commerce.category_breakdown(orders(spark, d), items(spark, d), products(spark, d))


@query("product_performance", f"""
SELECT product_id, name AS product_name, category, price AS current_price, cost AS current_cost, margin_pct, units_sold,
       CAST(revenue AS DOUBLE) AS total_revenue, CAST(units_sold * cost AS DOUBLE) AS total_cost,
       CAST(revenue - units_sold * cost AS DOUBLE) AS gross_profit, order_appearances, unique_buyers,
       {half_up("revenue * 100", "unique_buyers * 100", 2)} AS revenue_per_buyer,
       percent_rank() OVER (ORDER BY revenue) AS revenue_percentile
FROM (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, sum(line_total) AS revenue,
             count(DISTINCT order_id) AS order_appearances, count(DISTINCT customer_id) AS unique_buyers
      FROM o_items JOIN o_orders USING (order_id) WHERE status IN ('completed', 'shipped', 'processing')
      GROUP BY product_id) JOIN o_products USING (product_id)""", money=("current_price", "current_cost",))
def product_performance(spark, d):
    return commerce.product_performance(products(spark, d), items(spark, d), orders(spark, d))


@query("fact_orders", """
SELECT o.order_id, customer_id, CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, order_date, status,
       payment_method, total_amount, coalesce(n, 0) AS item_count, coalesce(u, 0) AS units
FROM o_orders o LEFT JOIN (SELECT order_id, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS u FROM o_items GROUP BY 1) i
  ON o.order_id = i.order_id""", money=("total_amount",))
def fact_orders(spark, d):
    return commerce.fact_orders(orders(spark, d), items(spark, d))


@query("dim_date", """
SELECT CAST(d AS DATE) AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS year, quarter(d) AS quarter,
       month(d) AS month, day(d) AS day, isodow(d) - 1 AS weekday, isodow(d) >= 6 AS is_weekend,
       strftime(d, '%Y-%m') AS year_month, last_day(d) AS month_end
FROM (SELECT unnest(generate_series(min(order_date)::TIMESTAMP, max(order_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d
      FROM o_orders)""")
def dim_date(spark, d):
    return commerce.calendar_of(spark, orders(spark, d))


@query("parse_amounts", """
SELECT o_orderkey, _ingestion_date, amount_raw,
       try_cast(nullif(regexp_replace(amount_raw, '[^0-9.-]', '', 'g'), '') AS DECIMAL(18,2)) AS amount FROM b_court""", money=("amount",))
def parse_amounts(spark, d):
    court = bind(spark, d, "b_court")
    return court.select("o_orderkey", "_ingestion_date", "amount_raw", numbers.amount(F.col("amount_raw")).alias("amount"))
