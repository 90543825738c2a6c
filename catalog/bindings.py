"""The given tables seen as raw feeds of the two domains (commerce and public records).

Each text runs unchanged on Spark SQL and DuckDB. Names in braces are other bindings or given tables: Spark
gets DataFrames for them, the SQL side gets common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

SQL: dict[str, str] = {}

# Comparison side only: tables derived from the bindings, written in DuckDB SQL.
DERIVED: dict[str, str] = {}

SQL["b_customers"] = """
SELECT concat('CUST-', lpad(cast(c_custkey AS string), 6, '0')) AS customer_id,
       CASE WHEN c_custkey % 53 = 0 THEN 'invalid'
            ELSE concat(' User', cast(c_custkey AS string), '@Mail.Example ') END AS email,
       CASE WHEN c_custkey % 67 = 0 THEN '' ELSE concat(' ', c_mktsegment) END AS first_name,
       concat(c_name, ' ') AS last_name, cast(c_nationkey AS string) AS city, 'ny ' AS state,
       cast(date '1994-01-01' + cast(c_custkey % 365 AS int) AS string) AS signup_date,
       CASE c_custkey % 4 WHEN 0 THEN 'false' WHEN 1 THEN ' TRUE' WHEN 2 THEN 'true' ELSE 'maybe' END AS is_active,
       'b1' AS _batch_id, date '2001-08-01' AS _ingestion_date
FROM {customer}
UNION ALL
SELECT concat('CUST-', lpad(cast(c_custkey AS string), 6, '0')),
       concat('new', cast(c_custkey AS string), '@mail.example'), c_mktsegment, c_name,
       cast(c_nationkey + 1 AS string), 'CA',
       cast(date '1994-01-01' + cast(c_custkey % 365 AS int) AS string), 'true', 'b2', date '2001-08-02'
FROM {customer} WHERE c_custkey % 20 = 0
"""

# Every 50th customer has no orders: theirs belong to the customer before. The second batch changes every 40th order.
_ORDER = """
SELECT concat('ORD-', lpad(cast(o_orderkey AS string), 8, '0')) AS order_id,
       CASE WHEN o_orderkey % 97 = 0 THEN ''
            ELSE concat('CUST-', lpad(cast(CASE WHEN o_custkey % 50 = 0 THEN o_custkey - 1 ELSE o_custkey END AS string), 6, '0'))
            END AS customer_id,
       CASE WHEN o_orderkey % 101 = 0 THEN 'INVALID'
            ELSE cast(cast(o_orderdate AS date) AS string) END AS order_date,
       %STATUS% AS status,
       CASE WHEN o_orderkey % 103 = 0 THEN 'not_a_number'
            ELSE cast(cast(o_totalprice AS decimal(18,2)) AS string) END AS total_amount,
       substr(o_orderpriority, 3) AS payment_method, '%BATCH%' AS _batch_id, date '%DAY%' AS _ingestion_date
FROM {orders}
"""

SQL["b_orders"] = (
    _ORDER.replace("%STATUS%", """CASE o_orderkey % 7 WHEN 0 THEN 'refunded' WHEN 1 THEN 'cancelled'
            WHEN 2 THEN 'processing' WHEN 3 THEN 'shipped' WHEN 4 THEN ' Completed ' ELSE 'completed' END""")
    .replace("%BATCH%", "b1").replace("%DAY%", "2001-08-01")
    + "UNION ALL"
    + _ORDER.replace("%STATUS%", "CASE WHEN o_orderkey % 80 = 0 THEN 'lost' ELSE 'refunded' END")
    .replace("%BATCH%", "b2").replace("%DAY%", "2001-08-02")
    + "WHERE o_orderkey % 40 = 0\n"
)

SQL["b_order_items"] = """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS order_item_id,
       concat('ORD-', lpad(cast(l_orderkey AS string), 8, '0')) AS order_id,
       concat('PROD-', lpad(cast(l_partkey AS string), 6, '0')) AS product_id,
       cast(cast(l_quantity AS int) AS string) AS quantity,
       cast(cast(floor(l_extendedprice / l_quantity) AS bigint) AS string) AS unit_price,
       cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS line_total,
       'b1' AS _batch_id, cast(l_shipdate AS date) AS _ingestion_date
FROM {lineitem}
"""

SQL["b_products"] = """
SELECT concat('PROD-', lpad(cast(p_partkey AS string), 6, '0')) AS product_id, concat(p_name, ' ') AS name,
       p_type AS category, cast(cast(p_retailprice AS decimal(18,2)) AS string) AS price,
       cast(cast(p_size * 10 AS decimal(18,2)) AS string) AS cost,
       'b1' AS _batch_id, date '2001-08-01' AS _ingestion_date
FROM {part}
"""

_COURT = """
SELECT o_orderkey, st, county,
  CASE WHEN o_orderkey % 97 = 0 THEN ''
       ELSE concat(cast(year(dt) AS string), '-', cast(o_orderkey AS string)) END AS case_no,
  CASE WHEN o_orderkey % 101 = 0 THEN 'INVALID'
       WHEN st IN ('TX', 'NY') THEN concat(lpad(cast(month(dt) AS string), 2, '0'), '/',
            lpad(cast(day(dt) AS string), 2, '0'), '/', cast(year(dt) AS string))
       WHEN st = 'CA' THEN cast(dt AS string)
       WHEN st = 'FL' THEN replace(cast(dt AS string), '-', '')
       WHEN st = 'IL' THEN concat(lpad(cast(day(dt) AS string), 2, '0'), '-',
            substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(dt) * 3 - 2 AS int), 3), '-',
            cast(year(dt) AS string))
       ELSE concat(cast(month(dt) AS string), '/', cast(day(dt) AS string), '/', cast(year(dt) AS string))
  END AS filed_raw,
  CASE WHEN o_orderkey % 11 = 0 THEN 'ZZ'
       ELSE CASE st WHEN 'TX' THEN 'CV' WHEN 'CA' THEN 'UD' WHEN 'NY' THEN 'Tort' WHEN 'FL' THEN 'MM'
            WHEN 'IL' THEN 'CH' ELSE 'FED' END END AS type_raw,
  %STATUS% AS status_raw,
  concat(' ', c_name, CASE WHEN c_custkey % 3 = 0 THEN ' LLC' ELSE '' END) AS plaintiff,
  n_name AS defendant, concat('Hon. ', c_mktsegment) AS judge,
  CASE WHEN o_orderkey % 3 = 0 THEN ''
       ELSE concat('$', cast(cast(o_totalprice AS decimal(18,2)) AS string)) END AS amount_raw,
  CASE WHEN o_orderstatus = 'F' THEN cast(dt + cast(30 + o_orderkey % 300 AS int) AS string) ELSE '' END AS disposed_iso,
  date '%DAY%' AS _ingestion_date
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate AS date) AS dt,
        CASE o_custkey % 6 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL'
             WHEN 4 THEN 'IL' ELSE 'OH' END AS st,
        CASE o_custkey % 6 WHEN 0 THEN 'Harris County' WHEN 1 THEN 'Los Angeles County' WHEN 2 THEN 'Kings'
             WHEN 3 THEN 'Miami-Dade County' WHEN 4 THEN 'Cook County' ELSE 'Cuyahoga County' END AS county
      FROM {orders}) o
JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

SQL["b_court"] = (
    _COURT.replace("%STATUS%", """CASE o_orderstatus
       WHEN 'F' THEN CASE st WHEN 'TX' THEN 'DISP' WHEN 'CA' THEN 'Disposed' WHEN 'NY' THEN 'Settled'
            WHEN 'FL' THEN 'CLOSED' WHEN 'IL' THEN 'Closed' ELSE 'TERMINATED' END
       WHEN 'O' THEN CASE st WHEN 'TX' THEN 'PEND' WHEN 'CA' THEN 'Active' WHEN 'NY' THEN 'Active'
            WHEN 'FL' THEN 'OPEN' WHEN 'IL' THEN 'Open' ELSE 'ACTIVE' END
       ELSE 'ZZ' END""").replace("%DAY%", "2001-08-01")
    + "UNION ALL"
    + _COURT.replace("%STATUS%", "CASE WHEN o_orderkey % 60 = 0 THEN 'Sealed' ELSE 'Stayed' END")
    .replace("%DAY%", "2001-08-02")
    + "WHERE o_orderkey % 30 = 0\n"
)

SQL["b_judgments"] = """
SELECT o_orderkey AS judgment_key,
  CASE o_custkey % 6 WHEN 0 THEN 'Harris County' WHEN 1 THEN 'Los Angeles County' WHEN 2 THEN 'Kings' WHEN 3 THEN 'Miami-Dade County'
    WHEN 4 THEN 'Cook County' ELSE 'Cuyahoga County' END AS county,
  CASE o_custkey % 6 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL' WHEN 4 THEN 'IL' ELSE 'OH' END AS state_code,
  concat(cast(year(cast(o_orderdate AS date)) AS string), '-', cast(o_orderkey AS string)) AS case_number,
  cast(o_orderdate AS date) + cast(30 + o_orderkey % 300 AS int) AS judgment_date,
  CASE o_orderkey % 5 WHEN 0 THEN 'DEFAULT' WHEN 1 THEN 'CONSENT' WHEN 2 THEN 'SUMMARY' WHEN 3 THEN 'TRIAL_VERDICT' ELSE 'STIPULATED' END AS judgment_type,
  cast(o_totalprice AS decimal(18,2)) AS judgment_amount, o_custkey AS debtor_key,
  CASE WHEN o_orderkey % 4 = 0 THEN 'SATISFIED' ELSE 'UNSATISFIED' END AS satisfaction_status,
  CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderdate AS date) + cast(400 + o_orderkey % 90 AS int) END AS satisfaction_date
FROM {orders} WHERE o_orderstatus = 'F'
"""

SQL["b_liens"] = """
SELECT concat('JUDGMENT_', state_code, '_', cast(judgment_key AS string)) AS lien_id, 'JUDGMENT' AS lien_type, state_code,
  CASE WHEN judgment_key % 10 = 0 THEN NULL ELSE case_number END AS related_case_number,
  debtor_key, judgment_amount AS lien_amount, judgment_date + cast(judgment_key % 60 AS int) AS filing_date,
  CASE WHEN satisfaction_status = 'SATISFIED' THEN 'RELEASED' ELSE 'ACTIVE' END AS lien_status,
  debtor_key + 1 AS creditor_key
FROM {b_judgments} j
UNION ALL
SELECT concat('UCC_TX_', cast(s_suppkey AS string)), 'UCC', 'TX', NULL, s_suppkey,
  cast(abs(s_acctbal) AS decimal(18,2)), date '1995-01-01' + cast(s_suppkey % 2000 AS int), 'ACTIVE',
  cast(CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END AS bigint)
FROM {supplier}
"""

SQL["b_docket"] = "SELECT cast((event_id - event_id % 3) / 3 AS bigint) AS o_orderkey, ts, event_type, value FROM {events}"

# Names of organizations with varying type words and suffixes; the brand stands for the state of a block.
SQL["b_names"] = """
SELECT p_partkey AS record_id, p_brand AS state_code,
  concat(CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END, '  ', lower(p_type), ' trading ',
         CASE p_partkey % 4 WHEN 0 THEN 'co' WHEN 1 THEN 'and sons' ELSE '' END,
         CASE p_partkey % 3 WHEN 0 THEN ', LLC' WHEN 1 THEN ', Inc.' ELSE '' END) AS party_name
FROM {part}
"""


def _parts(name: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", SQL[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a binding as a DataFrame."""
    if name not in SQL:
        return table(spark, sf_dir, name)
    return spark.sql(SQL[name], **{p: bind(spark, sf_dir, p) for p in set(_parts(name))})


def with_bindings(sql: str) -> str:
    """Put the bindings that a statement mentions in front of it as common table expressions."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name, definition in {**SQL, **DERIVED}.items():
            if name not in ordered and re.search(rf"\b{name}\b", text):
                need(definition)
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    texts = {n: re.sub(r"[{}]", "", SQL[n]) if n in SQL else DERIVED[n] for n in ordered}
    heads = [f"{n} AS ({texts[n]})" for n in ordered]
    body = sql.strip()
    glue = ",\n" + body[4:] if body.upper().startswith("WITH") else "\n" + body
    # Every statement may hold one recursive part; the keyword changes nothing for the others.
    return "WITH RECURSIVE " + ",\n".join(heads) + glue
