"""Bronze: raw rows plus lineage, one partition per source and day."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.sources import sinks
from lamella.sources.readers import CORRUPT, read_source
from lamella.specs import SourceSpec
from lamella.staging import stage


def batch_id(source: str, day: str) -> str:
    """The same for every run of one source and day. Computed once per batch, not per row."""
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{source}:{day}"))


def batch_key(source: Column, day: Column) -> Column:
    """Column form for tables that hold many sources."""
    return F.sha2(F.concat_ws("/", source, day.cast("string")), 256)


def cast_all_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def add_lineage(df: DataFrame, batch: str, system: str, table: str, at: Column | None = None, **more: str) -> DataFrame:
    """Append lineage columns. The file path is the one each row was read from, where Spark knows it."""
    values = {
        "_batch_id": F.lit(batch),
        "_source_system": F.lit(system),
        "_source_table": F.lit(table),
        "_ingestion_timestamp": at if at is not None else F.current_timestamp(),
        **{f"_source_{k}": F.lit(v) for k, v in more.items()},
    }
    return df.withColumns(values)


def with_file_path(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"))


def row_positions(df: DataFrame, into: str = "_row_number") -> DataFrame:
    """Place of each row in its source file, from 1. ``df`` must be a plain file read.

    A block of a file is read in order by one task, so the task-local ids of a block are consecutive. The
    rows are written once with those ids; the place is the id within the block plus the sizes of the blocks
    before it, taken from a summary with one row per block.
    """
    at = F.monotonically_increasing_id()
    block = F.col("_metadata.file_block_start").alias("_block")
    placed = stage(df.select("*", F.col("_metadata.file_path").alias("_file_path"), block).withColumn("_at", at), "rows")
    blocks = placed.groupBy("_file_path", "_block").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(
        Window.partitionBy("_file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select("_file_path", "_block", "_lo", F.coalesce(before, F.lit(0)).alias("_before"))
    place = (F.col("_at") - F.col("_lo") + F.col("_before") + 1).alias(into)
    return placed.join(offsets, ["_file_path", "_block"]).select(*df.columns, "_file_path", place)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, malformed) rows of a read that kept malformed lines.

    The read is stored once: otherwise both sides would parse the files, and Spark would skip the columns
    that decide whether a line is malformed.
    """
    stored = stage(df, "parsed")
    return stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT), stored.where(F.col(CORRUPT).isNotNull())


def ingest(spark: SparkSession, spec: SourceSpec, day: str, at: Column | None = None) -> DataFrame:
    """One source's rows for one day, all text, with lineage."""
    raw = with_file_path(read_source(spark, spec))
    lined = add_lineage(raw, batch_id(spec.name, day), spec.system, spec.table or spec.name, at,
                        format=spec.format, **spec.lineage)
    return lined.withColumns({"_source": F.lit(spec.name), "_ingestion_date": F.lit(day).cast("date")})


def ingest_all(spark: SparkSession, specs: list[SourceSpec], day: str, path: str) -> DataFrame:
    """Write every source's partition below ``path``; one status row per source.

    A source that fails is recorded and the others go on. Each write replaces exactly the partition of its
    source and day, so a run can be repeated; a source that has become empty leaves an empty day.
    """
    status = []
    for spec in specs:
        target = f"{path}/{spec.table or spec.name}"
        try:
            written = sinks.write_partition(ingest(spark, spec, day), target, ["_source", "_ingestion_date"],
                                            owned=[{"_source": spec.name, "_ingestion_date": day}])
            status.append((spec.name, "ok", written, ""))
        except Exception as error:  # any failure of one source is an outcome, not the end of the run
            status.append((spec.name, "failed", 0, str(error) or type(error).__name__))
    return spark.createDataFrame(status, "source string, status string, rows long, error string")
