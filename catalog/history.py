"""History, change logs, look-back, keys and small column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import DERIVED, bind
from catalog.registry import query
from lamella.functions import dates, text
from lamella.operators import dedupe, scd
from lamella.sources import bronze, sinks

# The priority of a customer's orders over time is the tracked attribute.
DERIVED["o_history"] = """
SELECT o_custkey AS customer, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day FROM orders
"""


def _versions(rows: str) -> str:
    return f"""
SELECT customer, priority, day AS valid_from, coalesce(lead(day) OVER w, date '9999-12-31') AS valid_to,
  lead(day) OVER w IS NULL AS is_current, sha256(length(priority) || ':' || priority) AS row_hash
FROM (SELECT *, lag(priority) OVER (PARTITION BY customer ORDER BY day) AS prev
      FROM (SELECT customer, day, min(priority) AS priority FROM ({rows}) GROUP BY 1, 2))
WHERE prev IS NULL OR prev <> priority WINDOW w AS (PARTITION BY customer ORDER BY day)"""


def history(spark, d):
    return bind(spark, d, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"))


@query("scd2_build", _versions("SELECT * FROM o_history"))
def scd2_build(spark, d):
    return scd.scd2_build(history(spark, d), ["customer"], ["priority"], "day")


@query("scd2_merge", f"""
SELECT * FROM ({_versions("SELECT * FROM o_history")})""")
def scd2_merge(spark, d):
    """The last two months arrive as a batch; customers without a new order keep their versions."""
    rows = history(spark, d)
    start = F.lit("2001-06-01").cast("date")
    current = scd.scd2_build(rows.where(F.col("day") < start), ["customer"], ["priority"], "day")
    batch = rows.where(F.col("day") >= start)
    return scd.scd2_merge(current, batch, ["customer"], ["priority"], "day")


@query("scd2_customers", """SELECT customer_id, email, state, valid_from, valid_to, is_current FROM (
  SELECT customer_id, email, state, day AS valid_from, coalesce(lead(day) OVER w, date '9999-12-31') AS valid_to,
         lead(day) OVER w IS NULL AS is_current
  FROM (SELECT *, lag(email || state) OVER (PARTITION BY customer_id ORDER BY day) AS prev
        FROM (SELECT customer_id, lower(trim(email)) AS email, upper(trim(state)) AS state, _ingestion_date AS day FROM b_customers))
  WHERE prev IS NULL OR prev <> email || state WINDOW w AS (PARTITION BY customer_id ORDER BY day))""")
def scd2_customers(spark, d):
    rows = bind(spark, d, "b_customers").select(
        "customer_id", text.lowered(F.col("email")).alias("email"), text.uppered(F.col("state")).alias("state"),
        F.col("_ingestion_date").alias("day"))
    return scd.scd2_build(rows, ["customer_id"], ["email", "state"], "day").drop("row_hash")


@query("cdc_apply", """
SELECT key, segment FROM (
  SELECT c_custkey AS key, c_mktsegment AS segment, -1 AS seq, 'S' AS op FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT o_custkey, o_orderpriority, o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'U' ELSE 'I' END FROM orders)
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1 AND op <> 'D'""")
def cdc_apply(spark, d):
    snapshot = bind(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    kind = F.col("o_orderkey") % 3
    log = bind(spark, d, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("segment"), F.col("o_orderkey").alias("seq"),
        F.when(kind == 0, "D").when(kind == 1, "U").otherwise("I").alias("op"))
    return scd.apply_changes(snapshot, log, ["key"], "seq", "op")


@query("dedupe_lookback", """
SELECT user_id, event_type, ts, event_id FROM events
WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
QUALIFY lead(ts) OVER w IS NULL OR lead(ts) OVER w > ts + INTERVAL 7 DAY""")
def dedupe_lookback(spark, d):
    e = bind(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kept = dedupe.latest_in_lookback(e, ["user_id", "event_type"], "ts", 7, ["event_id"])
    return kept.select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


@query("hash_key", """SELECT o_orderkey, sha256(length(o_orderkey::VARCHAR) || ':' || o_orderkey || '|' ||
  length(o_orderpriority) || ':' || o_orderpriority || '|' || coalesce('1:' || nullif(o_orderstatus, 'P'), '∅')) AS key FROM orders""")
def hash_key(spark, d):
    o = bind(spark, d, "orders")
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return o.select("o_orderkey", text.hash_key(F.col("o_orderkey"), F.col("o_orderpriority"), status).alias("key"))


@query("batch_key", "SELECT o_orderkey, sha256(o_orderpriority || '/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS batch_key FROM orders")
def batch_key(spark, d):
    o = bind(spark, d, "orders")
    return o.select("o_orderkey", bronze.batch_key(F.col("o_orderpriority"), F.col("o_orderdate").cast("date")).alias("batch_key"))


@query("pii_mask", "SELECT c_custkey, sha256(c_name) AS c_name, c_mktsegment FROM customer")
def pii_mask(spark, d):
    return bind(spark, d, "customer").select("c_custkey", text.mask(F.col("c_name")).alias("c_name"), "c_mktsegment")


_PHONE = """CASE c_custkey % 5 WHEN 0 THEN concat('(212) 555-', lpad(cast(c_custkey % 10000 AS string), 4, '0'))
  WHEN 1 THEN concat('1-646-555-', lpad(cast(c_custkey % 10000 AS string), 4, '0'))
  WHEN 2 THEN concat('+44 20 7946 ', lpad(cast(c_custkey % 10000 AS string), 4, '0')) WHEN 3 THEN '12345' ELSE NULL END"""


@query("normalize_phone", f"""SELECT c_custkey, phone, CASE c_custkey % 5 WHEN 0 THEN '+1212555' || right(phone, 4)
  WHEN 1 THEN '+1646555' || right(phone, 4) WHEN 2 THEN '+44207946' || right(phone, 4) END AS phone_e164
  FROM (SELECT c_custkey, {_PHONE} AS phone FROM customer)""")
def normalize_phone(spark, d):
    c = bind(spark, d, "customer").select("c_custkey", F.expr(_PHONE).alias("phone"))
    return c.withColumn("phone_e164", text.phone_e164(F.col("phone")))


@query("to_utc", """SELECT event_id, (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc FROM events""")
def to_utc(spark, d):
    e = bind(spark, d, "events")
    return e.select("event_id", dates.to_utc(F.col("ts").cast("timestamp"), "America/New_York").cast("timestamp_ntz").alias("utc"))


@query("retention_prune", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE CAST(o_orderdate AS DATE) >= CAST(date '2001-08-02' - INTERVAL 3 YEAR AS DATE)""")
def retention_prune(spark, d):
    o = bind(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return sinks.retention_prune(o, "day", "2001-08-02", **sinks.RETENTION["silver"])


@query("pattern_checks", f"""SELECT c_custkey, regexp_full_match(trim(email), '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') AS email_ok,
  coalesce(c_custkey % 5 IN (0, 1, 2) AND NOT (c_custkey % 5 = 0), false) AS phone_ok, regexp_full_match(zip, '[0-9]{{5}}(-[0-9]{{4}})?') AS zip_ok
  FROM (SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'none' ELSE ' u' || c_custkey || '@x.org' END AS email,
               CASE WHEN c_nationkey < 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
                    WHEN c_nationkey < 10 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '-0001' ELSE CAST(c_mktsegment AS VARCHAR) END AS zip
        FROM customer)""")
def pattern_checks(spark, d):
    key = F.lpad(F.col("c_custkey").cast("string"), 5, "0")
    nation = F.col("c_nationkey")
    zip_code = F.when(nation < 5, key).when(nation < 10, F.concat(key, F.lit("-0001"))).otherwise(F.col("c_mktsegment"))
    email = F.when(nation == 0, "none").otherwise(F.concat(F.lit(" u"), F.col("c_custkey").cast("string"), F.lit("@x.org")))
    c = bind(spark, d, "customer").withColumns({"email": email, "phone": F.expr(_PHONE), "zip": zip_code})
    return c.select("c_custkey", text.matches(F.col("email"), text.EMAIL).alias("email_ok"),
                    text.matches(F.col("phone"), text.PHONE).alias("phone_ok"), text.matches(F.col("zip"), text.POSTAL_CODE).alias("zip_ok"))
