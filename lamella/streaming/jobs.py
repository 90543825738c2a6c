"""Streaming forms of the layer operators, on Structured Streaming."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lamella.operators import quality
from lamella.operators.validate import Rule, SplitOnce
from lamella.sources import commits
from lamella.sources.bronze import add_lineage
from lamella.sources.sinks import write_partition
from lamella.staging import new_folder

BATCH, CLOSING = "_stream_batch", "_closing"


def read_stream(spark: SparkSession, path: str, time_columns: list[str], **options) -> DataFrame:
    """A folder of Parquet files as a stream. Zone-less times become timestamps, as watermarks need them."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).options(**options).parquet(path)
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in time_columns})


def run_to_end(spark: SparkSession, writer, name: str, progress: str | None = None) -> StreamingQuery:
    """Process everything that is there and stop. Progress is kept in the shared checkpoint folder."""
    query = writer.option("checkpointLocation", progress or new_folder(spark, f"{name}-progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def by_batch(stream: DataFrame, name: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return run_to_end(stream.sparkSession, stream.writeStream.foreachBatch(write), name)


def _put(df: DataFrame, path: str, batch: int) -> None:
    """Each batch owns one partition and replaces it, so a batch that is repeated leaves no duplicates."""
    write_partition(df.withColumn(BATCH, F.lit(batch).cast("long")), path, [BATCH], owned=[{BATCH: batch}])


def bronze_ingest(stream: DataFrame, path: str, batch: str, system: str, table: str, at: Column | None = None):
    """Append raw rows with lineage; the stream batch is the partition."""
    lined = add_lineage(stream, batch, system, table, at)
    return by_batch(lined, "bronze", lambda df, i: _put(df, path, i))


def split_stream(stream: DataFrame, rules: list[Rule], valid_path: str, rejected_path: str) -> StreamingQuery:
    """Valid and rejected rows from one read of every batch."""

    def write(df: DataFrame, i: int) -> None:
        valid, rejected = SplitOnce("stream_split")(df, rules)
        _put(valid, valid_path, i)
        _put(rejected, rejected_path, i)

    return by_batch(stream, "split", write)


def dedupe_stream(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark; older keys leave the state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_totals(
    stream: DataFrame, ts: str, amount: str, by: list[str], length: str, slide: str | None, delay: str
) -> DataFrame:
    """Count and sum per time window, tumbling or sliding. State ends with the watermark."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    total = F.sum(F.col(amount).cast("decimal(18,2)"))
    timed = stream.withWatermark(ts, delay)
    if CLOSING in stream.columns:
        # the mark moves the watermark and goes; a condition on the time keeps the filter above the watermark
        timed = timed.where(F.col(ts).isNull() | ~F.col(CLOSING)).drop(CLOSING)
    return (
        timed.groupBy(window.alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("rows"), total.alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "rows", "total")
    )


def append_closed(result: DataFrame, path: str, name: str) -> StreamingQuery:
    """Write windows once they are closed by the watermark."""
    writer = result.writeStream.outputMode("append").format("parquet").option("path", path)
    return run_to_end(result.sparkSession, writer, name)


class FiniteStream:
    """A folder that will get no more files, as a stream that has an end.

    Windows are written once the watermark is past them, so the last ones of a finite source would wait for ever. The stream
    is therefore read together with a folder for one closing mark. After all files have been processed the mark is laid
    there, dated at the end of time, and the same query goes on from where it stopped: all windows are closed.
    """

    def __init__(self, spark: SparkSession, path: str, time_columns: list[str], ts: str, **options):
        self.spark, self.ts = spark, ts
        rows = read_stream(spark, path, time_columns, **options).withColumn(CLOSING, F.lit(False))
        self.schema, self.marks = rows.schema, new_folder(spark, "closing")
        spark.createDataFrame([], self.schema).write.parquet(self.marks)
        self.rows = rows.unionByName(spark.readStream.schema(self.schema).parquet(self.marks))

    def append_closed(self, result: DataFrame, path: str, name: str) -> StreamingQuery:
        """Write all windows of ``result``, which is made of ``rows`` by ``windowed_totals``."""
        progress = new_folder(self.spark, f"{name}-progress")
        writer = result.writeStream.outputMode("append").format("parquet").option("path", path)
        run_to_end(self.spark, writer, name, progress)
        end = [F.lit("9999-12-01 00:00:00").cast("timestamp") if f.name == self.ts else F.lit(f.name == CLOSING or None).cast(f.dataType)
               for f in self.schema]
        mark = self.spark.range(1).select(*[c.alias(f.name) for c, f in zip(end, self.schema, strict=True)])
        mark.write.mode("append").parquet(self.marks)
        return run_to_end(self.spark, writer, name, progress)


def _compacted(spark: SparkSession, path: str, batch: int, every: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Every so many batches what all earlier ones have written becomes one partition, that of the batch before.

    The batch itself stays apart, so that it can still be repeated.
    """
    if batch == 0 or batch % every:
        return
    earlier = commits.read(spark, path).where(F.col(BATCH) < batch)
    merged = merge(earlier).withColumn(BATCH, F.lit(batch - 1).cast("long"))
    write_partition(merged, path, [BATCH], owned=[{BATCH: b} for b in range(max(0, batch - 1 - every), batch)])


def customer_totals(stream: DataFrame, path: str, key: str, ts: str, amount: str, compact_every: int = 50) -> StreamingQuery:
    """Running totals per customer as partial sums per batch; ``read_customer_totals`` adds them up.

    Sums of sums need no state that grows with the number of customers, and a repeated batch replaces its
    own partials. Partials are merged every ``compact_every`` batches, so readers never meet more than that many.
    """

    def write(df: DataFrame, i: int) -> None:
        _put(
            df.groupBy(key).agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.col(amount).cast("decimal(18,2)")).alias("total"),
                F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
            ),
            path, i,
        )
        _compacted(stream.sparkSession, path, i, compact_every, lambda df: _merged_totals(df, key))

    return by_batch(stream, "totals", write)


def _merged_totals(partials: DataFrame, key: str) -> DataFrame:
    return partials.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum("total").cast(partials.schema["total"].dataType).alias("total"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )


def read_customer_totals(spark: SparkSession, path: str, key: str) -> DataFrame:
    return commits.read(spark, path).groupBy(key).agg(
        F.sum("n").alias("rows"), F.sum("total").cast("double").alias("total"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )


def quality_stream(
    stream: DataFrame, checks: list[quality.Check], path: str, layer: str, table: str, compact_every: int = 50
) -> StreamingQuery:
    """The suite over every batch; results are kept per batch, and of columns that must be unique the number of each value.

    ``read_quality`` puts the batches together.
    """
    counted = sorted({c.column for c in checks if c.kind == "unique" and c.column in stream.columns})

    def write(df: DataFrame, i: int) -> None:
        _put(quality.run_suite(df, checks, layer, table), path, i)
        for column in counted:
            keys = f"{path}_keys/{column}"
            _put(df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")), keys, i)
            _compacted(stream.sparkSession, keys, i, compact_every, lambda x: x.groupBy("value").agg(F.sum("n").alias("n")))

    return by_batch(stream, "quality", write)


def read_quality(spark: SparkSession, path: str, checks: list[quality.Check]) -> DataFrame:
    """One row per check over all batches: a value that occurs in two batches is not unique, though it is in each of them."""
    total = commits.read(spark, path).groupBy("check_name", "layer", "table_name", "threshold", "severity").agg(
        F.sum("records_checked").alias("records_checked"), F.sum("records_passed").alias("_passed"))
    limits = spark.createDataFrame([(c.name, float(c.warn_from)) for c in checks], "check_name string, _warn_from double")
    distinct = None
    for check in (c for c in checks if c.kind == "unique"):
        try:
            values = commits.read(spark, f"{path}_keys/{check.column}").select("value").distinct()
        except AnalysisException:  # the stream had no such column, its batches have failed
            continue
        seen = F.count("value") + F.when(F.lit(check.null_counts), F.max(F.col("value").isNull().cast("int"))).otherwise(0)
        row = values.agg(F.lit(check.name).alias("check_name"), F.coalesce(seen, F.lit(0)).cast("long").alias("_distinct"))
        distinct = row if distinct is None else distinct.unionByName(row)
    total = total.join(F.broadcast(limits), "check_name")  # one row a check
    total = total.withColumn("_distinct", F.lit(None).cast("long")) if distinct is None else total.join(F.broadcast(distinct), "check_name", "left")
    passed = F.coalesce("_distinct", "_passed")
    rate = F.when(F.col("records_checked") > 0, passed / F.col("records_checked") * 100).otherwise(F.lit(100.0))
    return total.select(
        "check_name", "layer", "table_name", "records_checked", passed.alias("records_passed"),
        (F.col("records_checked") - passed).alias("records_failed"), rate.alias("pass_rate"), "threshold",
        quality.status_of(rate, F.col("threshold"), F.col("_warn_from")).alias("status"), "severity")


class _Progress(StreamingQueryListener):
    """Every progress event of every run; a query itself remembers only its latest ones."""

    def __init__(self):
        self.batches, self.ended = defaultdict(list), defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.batches[str(p.runId)].append((p.batchId, p.numInputRows, dropped))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()


def late_rows(spark: SparkSession, run: Callable[[], StreamingQuery], wait: float = 60) -> list[tuple[int, int, int]]:
    """(batch, rows read, rows dropped as late) of every batch of the query that ``run`` starts and sees to its end."""
    seen = _Progress()
    spark.streams.addListener(seen)
    try:
        run_id = str(run().runId)
        if not seen.ended[run_id].wait(wait):
            raise TimeoutError(f"no end of run {run_id} was reported within {wait} s")
        return seen.batches[run_id]
    finally:
        spark.streams.removeListener(seen)
