"""Readers, bronze and sinks: given tables are written in a raw format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind
from catalog.registry import query
from lamella.sources import bronze, readers, sinks
from lamella.specs import SourceSpec
from lamella.staging import new_folder

_TEXT_PRODUCTS = """SELECT product_id, name, category, price, cost, _batch_id, CAST(_ingestion_date AS VARCHAR) AS _ingestion_date
  FROM b_products"""
_AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _landed_csv(spark, d, sep="|"):
    path = new_folder(spark, "csv")
    bronze.cast_all_string(bind(spark, d, "b_products")).write.options(header=True, sep=sep, **_AS_IS).csv(path)
    return path


@query("src_csv_raw", _TEXT_PRODUCTS)
def src_csv_raw(spark, d):
    return readers.read_source(spark, SourceSpec("products", _landed_csv(spark, d), "csv", options={"sep": "|"}))


@query("src_csv_tab", _TEXT_PRODUCTS)
def src_csv_tab(spark, d):
    spec = SourceSpec("products", _landed_csv(spark, d, "\t"), "csv", options={"sep": "\t"})
    return readers.read_source(spark, spec)


@query("src_json_raw", """SELECT CAST(o_orderkey AS VARCHAR) AS docket_id, o_orderpriority AS priority,
  '{"plaintiffs":[{"name":"' || c_name || '"}],"defendants":[{"name":"' || n_name || '"}]}' AS parties
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def src_json_raw(spark, d):
    """Each file holds one JSON array of up to five thousand cases, as a court would send them."""
    cases = bind(spark, d, "orders").join(bind(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        bind(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    name = lambda c: F.array(F.struct(F.col(c).alias("name")))
    document = F.to_json(F.struct(
        F.col("o_orderkey").alias("docket_id"), F.col("o_orderpriority").alias("priority"),
        F.struct(name("c_name").alias("plaintiffs"), name("n_name").alias("defendants")).alias("parties")))
    files = cases.groupBy(F.floor(F.col("o_orderkey") / 5000).alias("f")).agg(F.collect_list(document).alias("docs"))
    path = new_folder(spark, "json")
    files.select(F.concat(F.lit("[\n"), F.array_join("docs", ",\n"), F.lit("\n]")).alias("value")).write.option(
        "maxRecordsPerFile", 1).text(path)
    return readers.read_json_raw(spark, path, ["docket_id", "priority", "parties"])


@query("src_jsonl_raw", """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
  replace(props, ' ', '') AS props FROM events""")
def src_jsonl_raw(spark, d):
    path = new_folder(spark, "jsonl")
    e = bind(spark, d, "events").select("event_id", "user_id", "event_type", F.from_json("props", "map<string,int>").alias("props"))
    e.write.json(path)
    return readers.read_jsonl_raw(spark, path, ["event_id", "user_id", "event_type", "props"])


@query("src_xml_raw", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part")
def src_xml_raw(spark, d):
    path = new_folder(spark, "xml")
    bind(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size").write.format("xml").options(
        rowTag="case", rootTag="cases").save(path)
    return readers.read_xml_raw(spark, path, "case", ["p_partkey", "p_name", "p_brand", "p_size"])


@query("src_fixed_width", "SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def src_fixed_width(spark, d):
    path = new_folder(spark, "fixed")
    o = bind(spark, d, "orders")
    line = F.concat(F.rpad(F.col("o_orderkey").cast("string"), 12, " "), F.rpad("o_orderstatus", 3, " "), F.rpad("o_orderpriority", 15, " "))
    o.select(line.alias("value")).write.text(path)
    return readers.read_fixed_width(spark, path, [("case_id", 1, 12), ("status", 13, 3), ("priority", 16, 15)])


@query("src_merge_schema", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'b1' ELSE 'b2' END AS batch FROM orders""")
def src_merge_schema(spark, d):
    path = new_folder(spark, "layer")
    o = bind(spark, d, "orders")
    o.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("priority")).write.parquet(f"{path}/batch=b1")
    o.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_orderstatus").alias("status")).write.parquet(f"{path}/batch=b2")
    return readers.read_layer(spark, path)


def _by_state(spark, d):
    path = new_folder(spark, "suits")
    sinks.write_table(bind(spark, d, "b_judgments"), path, ["state_code"])
    return path


@query("src_partition_pruned", "SELECT judgment_key, state_code, case_number FROM b_judgments WHERE state_code = 'TX'")
def src_partition_pruned(spark, d):
    return readers.read_partition(spark, _by_state(spark, d), state_code="TX").select("judgment_key", "state_code", "case_number")


@query("src_external_table", "SELECT state_code, count(*) AS rows FROM b_judgments GROUP BY state_code")
def src_external_table(spark, d):
    path = _by_state(spark, d)
    schema = spark.read.parquet(path).schema
    name = "judgments_" + path.rsplit("-", 1)[1]
    table = readers.external_table(spark, name, path, schema, ["state_code"])
    return table.groupBy("state_code").agg(F.count(F.lit(1)).alias("rows"))


@query("bronze_all_string", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def bronze_all_string(spark, d):
    return bronze.cast_all_string(bind(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"))


_SPEC = {"system": "courts", "table": "suits", "lineage": {"state": "TX", "county": "Harris County"}}


@query("bronze_lineage", f"""SELECT product_id, name, '{bronze.batch_id("products", "2001-08-01")}' AS _batch_id, 'courts' AS _source_system,
  'suits' AS _source_table, 'csv' AS _source_format, 'TX' AS _source_state, 'Harris County' AS _source_county,
  timestamp '2001-08-01 06:00:00' AS _ingestion_timestamp, true AS has_file, date '2001-08-01' AS _ingestion_date FROM b_products""")
def bronze_lineage(spark, d):
    spec = SourceSpec("products", _landed_csv(spark, d), "csv", options={"sep": "|"}, **_SPEC)
    at = F.lit("2001-08-01 06:00:00").cast("timestamp")
    rows = bronze.ingest(spark, spec, "2001-08-01", at)
    return rows.select(
        "product_id", "name", "_batch_id", "_source_system", "_source_table", "_source_format", "_source_state", "_source_county",
        F.col("_ingestion_timestamp").cast("timestamp_ntz").alias("_ingestion_timestamp"),
        F.col("_file_path").endswith(".csv").alias("has_file"), "_ingestion_date")


@query("row_position", """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS _row_number
  FROM part""")
def row_position(spark, d):
    """One file per brand, ordered by key, so the place in the file is known."""
    path = new_folder(spark, "files")
    p = bind(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    p.repartition("p_brand").sortWithinPartitions("p_brand", "p_partkey").write.partitionBy("p_brand").options(header=True).csv(path)
    rows = readers.read_csv_raw(spark, f"{path}/*/", fields=["p_partkey", "p_name"])
    return bronze.row_positions(rows).select("p_partkey", "_row_number")


@query("sink_idempotent", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows FROM orders GROUP BY 1")
def sink_idempotent(spark, d):
    """The whole table once, then one half of its months again: no row may appear twice or vanish."""
    path = new_folder(spark, "partitions")
    o = bind(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.month("o_orderdate").alias("month"))
    sinks.write_partition(o, path, ["month"])
    sinks.write_partition(o.where("month <= 6"), path, ["month"])
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


@query("sink_partitioned", "SELECT state_code, judgment_key, case_number FROM b_judgments")
def sink_partitioned(spark, d):
    return spark.read.parquet(_by_state(spark, d)).select("state_code", "judgment_key", "case_number")


@query("sink_clustered", """SELECT judgment_key, state_code, judgment_type, judgment_date,
  CAST(date_trunc('month', judgment_date) AS DATE) AS month FROM b_judgments""")
def sink_clustered(spark, d):
    path = new_folder(spark, "clustered")
    sinks.write_clustered(bind(spark, d, "b_judgments"), path, "judgment_date", ["state_code", "judgment_type"], "judgment_key")
    return spark.read.parquet(path).select("judgment_key", "state_code", "judgment_type", "judgment_date", "month")


@query("sink_interleaved", """SELECT 'day' AS read_by, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN date '1995-01-01' AND date '1995-03-31'
  UNION ALL SELECT 'customer', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_custkey BETWEEN 10 AND 60
  UNION ALL SELECT 'priority', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderpriority = '2-HIGH'""")
def sink_interleaved(spark, d):
    """One layout that is read by each of its columns alone."""
    path, day = new_folder(spark, "interleaved"), F.col("o_orderdate").cast("date")
    sinks.write_interleaved(
        bind(spark, d, "orders").withColumn("day", day), path, ["day", "o_custkey", "o_orderpriority"], "o_orderkey")
    stored = spark.read.parquet(path)
    filters = {
        "day": F.col("day").between("1995-01-01", "1995-03-31"), "customer": F.col("o_custkey").between(10, 60),
        "priority": F.col("o_orderpriority") == "2-HIGH",
    }
    parts = [
        stored.where(f).agg(F.lit(n).alias("read_by"), F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").cast("long").alias("keys"))
        for n, f in filters.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ingest_status", """SELECT 'products' AS source, 'ok' AS status, count(*) AS rows, false AS has_error FROM part
  UNION ALL SELECT 'missing', 'failed', 0, true UNION ALL SELECT 'unknown', 'failed', 0, true""")
def ingest_status(spark, d):
    path = _landed_csv(spark, d)
    specs = [
        SourceSpec("missing", path + "-absent", "csv"),
        SourceSpec("products", path, "csv", options={"sep": "|"}),
        SourceSpec("unknown", path, "parchment"),
    ]
    status = bronze.ingest_all(spark, specs, "2001-08-01", new_folder(spark, "bronze"))
    return status.select("source", "status", "rows", (F.col("error") != "").alias("has_error"))


@query("malformed_split", """SELECT CASE WHEN p_partkey % 17 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS key,
  p_partkey % 17 = 0 AS malformed, CASE WHEN p_partkey % 17 = 0 THEN p_partkey || ';' || p_brand END AS line FROM part""")
def malformed_split(spark, d):
    """Every 17th line lacks a field."""
    path = new_folder(spark, "lines")
    key, brand = F.col("p_partkey").cast("string"), F.col("p_brand")
    line = F.when(F.col("p_partkey") % 17 == 0, F.concat_ws(";", key, brand)).otherwise(F.concat_ws(";", key, brand, "p_type"))
    bind(spark, d, "part").select(line.alias("value")).write.text(path)
    options = {"sep": ";", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": readers.CORRUPT}
    schema = readers.all_text(["key", "brand", "type"], corrupt=True)
    good, bad = bronze.split_malformed(spark.read.options(**options).schema(schema).csv(path))
    return good.select("key", F.lit(False).alias("malformed"), F.lit(None).cast("string").alias("line")).unionByName(
        bad.select(F.lit(None).cast("string").alias("key"), F.lit(True).alias("malformed"), F.col(readers.CORRUPT).alias("line")))


@query("observed_counts", "SELECT 'part' AS table_name, count(*) AS rows FROM part UNION ALL SELECT 'orders', count(*) FROM orders")
def observed_counts(spark, d):
    counts = [(t, sinks.write_table(bind(spark, d, t), new_folder(spark, t))) for t in ("part", "orders")]
    return spark.createDataFrame(counts, "table_name string, rows long")
