"""Streams that end, partials that are merged, and checks over all batches."""

import os

from pyspark.sql import functions as F

from lamella.operators import quality
from lamella.streaming import jobs


def land(spark, path, days):
    """One file a day, with two rows of the same key."""
    for d in days:
        spark.sql(f"SELECT id AS k, id AS n, timestamp '2024-01-{d:02d} 12:00:00' AS ts, CAST({d} AS double) AS value FROM range(2)") \
            .coalesce(1).write.mode("append").parquet(path)


def test_all_windows_of_a_finite_stream(spark, tmp_path):
    land(spark, str(tmp_path / "in"), range(1, 5))
    stream = jobs.FiniteStream(spark, str(tmp_path / "in"), ["ts"], "ts", maxFilesPerTrigger=1)
    totals = jobs.windowed_totals(stream.rows, "ts", "value", [], "1 day", None, "10 days")
    stream.append_closed(totals, str(tmp_path / "out"), "all")
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.day, r.rows, float(r.total)) for r in got] == [(d, 2, 2.0 * d) for d in range(1, 5)]


def test_partials_are_merged(spark, tmp_path):
    """Ten batches leave at most as many partitions as are read between two merges, and the same totals."""
    land(spark, str(tmp_path / "in"), range(1, 11))
    out = str(tmp_path / "out")
    stream = jobs.read_stream(spark, str(tmp_path / "in"), ["ts"], maxFilesPerTrigger=1)
    jobs.customer_totals(stream, out, "k", "ts", "value", compact_every=3)
    assert len([n for n in os.listdir(out) if "=" in n]) <= 4
    got = {r.k: (r.rows, r.total, r.first_seen.day, r.last_seen.day) for r in jobs.read_customer_totals(spark, out, "k").collect()}
    assert got == {k: (10, 55.0, 1, 10) for k in (0, 1)}
    jobs._put(spark.sql("SELECT 0L AS k, 5L AS n, CAST(1 AS decimal(28,2)) AS total, timestamp '2024-01-01' AS first_seen, timestamp '2024-01-01' AS last_seen"), out, 9)
    assert {r.k: r.rows for r in jobs.read_customer_totals(spark, out, "k").collect()} == {0: 14, 1: 9}, "the last batch can be repeated"


def test_a_key_in_two_batches_is_not_unique(spark, tmp_path):
    land(spark, str(tmp_path / "in"), (1, 2, 3))
    checks = [quality.unique("k"), quality.unique("ts"), quality.unique("absent"), quality.in_range("value", 1, 2)]
    stream = jobs.read_stream(spark, str(tmp_path / "in"), ["ts"], maxFilesPerTrigger=1)
    jobs.quality_stream(stream, checks, str(tmp_path / "q"), "bronze", "t", compact_every=2)
    rows = {r.check_name: (r.records_checked, r.records_passed, r.status) for r in jobs.read_quality(spark, str(tmp_path / "q"), checks).collect()}
    assert rows == {"unique_k": (6, 2, "FAIL"), "unique_ts": (6, 3, "FAIL"), "unique_absent": (6, 0, "FAIL"), "range_value": (6, 4, "FAIL")}
    once = spark.read.parquet(str(tmp_path / "q")).where(F.col("check_name") == "unique_k")
    assert {r.status for r in once.collect()} == {"PASS"}
