"""Streaming queries: every one runs its stream to the end and returns what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import bind
from catalog.registry import query
from lamella.operators import quality
from lamella.operators.validate import Rule
from lamella.sources.bronze import batch_id
from lamella.staging import new_folder
from lamella.streaming import jobs

BATCH_ID = batch_id("events", "2024-01-31")


def events(spark, d, **options):
    return jobs.read_stream(spark, f"{d}/events*.parquet", ["ts"], **options)


@query("stream_bronze", f"""SELECT event_id, user_id, event_type, props, '{BATCH_ID}' AS _batch_id,
  'topic' AS _source_system, 'events' AS _source_table FROM events""")
def stream_bronze(spark, d):
    out = new_folder(spark, "bronze")
    jobs.bronze_ingest(events(spark, d), out, BATCH_ID, "topic", "events")
    return spark.read.parquet(out).select(
        "event_id", "user_id", "event_type", "props", "_batch_id", "_source_system", "_source_table")


@query("stream_quarantine", """SELECT event_id, event_type, value < 5 OR event_type = 'error' AS rejected,
  concat_ws(',', CASE WHEN value < 5 THEN 'SMALL_VALUE' END, CASE WHEN event_type = 'error' THEN 'ERROR_EVENT' END) AS reasons
  FROM events""")
def stream_quarantine(spark, d):
    good, bad = new_folder(spark, "valid"), new_folder(spark, "rejected")
    rules = [Rule("SMALL_VALUE", F.col("value") >= 5), Rule("ERROR_EVENT", F.col("event_type") != "error")]
    jobs.split_stream(events(spark, d), rules, good, bad)
    valid = spark.read.parquet(good).select("event_id", "event_type", F.lit(False).alias("rejected"), F.lit("").alias("reasons"))
    rejected = spark.read.parquet(bad).select(
        "event_id", "event_type", F.lit(True).alias("rejected"), F.array_join("_reasons", ",").alias("reasons"))
    return valid.unionByName(rejected)


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(spark, d):
    twice = events(spark, d).unionByName(events(spark, d))
    out = new_folder(spark, "deduped")
    jobs.append_closed(jobs.dedupe_stream(twice, ["event_id"], "ts", "1 hour"), out, "dedupe")
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_daily", """SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS rows,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL""")
def stream_daily(spark, d):
    out, stream = new_folder(spark, "daily"), jobs.FiniteStream(spark, f"{d}/events*.parquet", ["ts"], "ts")
    stream.append_closed(jobs.windowed_totals(stream.rows, "ts", "value", ["event_type"], "1 day", None, "1 hour"), out, "daily")
    return spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "rows",
        F.col("total").cast("double").alias("total"))


@query("stream_sliding", """SELECT day - INTERVAL 1 DAY * k AS window_start, sum(n)::BIGINT AS rows, CAST(sum(v) AS DOUBLE) AS total
  FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1),
       (SELECT unnest(range(7)) AS k) GROUP BY 1""")
def stream_sliding(spark, d):
    out, stream = new_folder(spark, "sliding"), jobs.FiniteStream(spark, f"{d}/events*.parquet", ["ts"], "ts")
    stream.append_closed(jobs.windowed_totals(stream.rows, "ts", "value", [], "7 days", "1 day", "1 hour"), out, "sliding")
    return spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rows", F.col("total").cast("double").alias("total"))


@query("stream_customer_metrics", """SELECT user_id, count(*) AS rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
  min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY user_id""")
def stream_customer_metrics(spark, d):
    out = new_folder(spark, "totals")
    jobs.customer_totals(events(spark, d), out, "user_id", "ts", "value")
    totals = jobs.read_customer_totals(spark, out, "user_id")
    return totals.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query("stream_late")
def stream_late(spark, d):
    """The events in three files, newest days first; older days then come late."""
    part = (2 - F.floor((F.dayofmonth("ts") - 1) / 10)).cast("int")
    landed = new_folder(spark, "late")
    shuffled = bind(spark, d, "events").withColumn("part", F.greatest(part, F.lit(0)))
    for i in range(3):
        shuffled.where(F.col("part") == i).drop("part").write.mode("append").parquet(landed)
    stream = jobs.read_stream(spark, landed, ["ts"], maxFilesPerTrigger=1)
    totals = jobs.windowed_totals(stream, "ts", "value", [], "1 day", None, "1 hour")
    late = jobs.late_rows(spark, lambda: jobs.append_closed(totals, new_folder(spark, "closed"), "late"))
    return spark.createDataFrame(late, "batch long, rows_read long, rows_dropped long")


@query("stream_dq", """SELECT 'not_null_user_id' AS check_name, count(*) AS records_checked, count(user_id) AS records_passed, 'PASS' AS status FROM events
UNION ALL SELECT 'range_value', count(*), count(*) FILTER (value BETWEEN 1 AND 50),
  CASE WHEN count(*) FILTER (value BETWEEN 1 AND 50) / count(*) * 100 >= 95 THEN 'PASS'
       WHEN count(*) FILTER (value BETWEEN 1 AND 50) / count(*) * 100 >= 80 THEN 'WARN' ELSE 'FAIL' END FROM events""")
def stream_dq(spark, d):
    """One file is one batch here, so the only batch covers the whole table."""
    out = new_folder(spark, "quality")
    checks = [quality.not_null("user_id"), quality.in_range("value", 1, 50)]
    jobs.quality_stream(events(spark, d), checks, out, "bronze", "events")
    return spark.read.parquet(out).select("check_name", "records_checked", "records_passed", "status")


@query("stream_unique", """SELECT 'unique_event_id' AS check_name, count(*) + count(*) FILTER (event_type = 'error') AS records_checked,
  count(DISTINCT event_id) AS records_passed, CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 'PASS'
    WHEN count(*) / (count(*) + count(*) FILTER (event_type = 'error')) >= 0.8 THEN 'WARN' ELSE 'FAIL' END AS status FROM events
UNION ALL SELECT 'not_null_user_id', count(*) + count(*) FILTER (event_type = 'error'),
  count(user_id) + count(user_id) FILTER (event_type = 'error'), 'PASS' FROM events""")
def stream_unique(spark, d):
    """All events, then the errors once more in a batch of their own: every batch is free of repeats, all together are not."""
    landed, out = new_folder(spark, "twice"), new_folder(spark, "quality")
    rows = bind(spark, d, "events")
    for part in (rows, rows.where("event_type = 'error'")):
        part.coalesce(1).write.mode("append").parquet(landed)
    checks = [quality.unique("event_id"), quality.not_null("user_id")]
    jobs.quality_stream(jobs.read_stream(spark, landed, ["ts"], maxFilesPerTrigger=1), checks, out, "bronze", "events", compact_every=1)
    return jobs.read_quality(spark, out, checks).select("check_name", "records_checked", "records_passed", "status")
