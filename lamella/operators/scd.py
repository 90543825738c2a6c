"""Slowly changing history: versions with validity, merges, change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.dates import END_OF_TIME
from lamella.functions.text import hash_key
from lamella.operators.dedupe import keep_first


def _end() -> Column:
    return F.lit(END_OF_TIME).cast("date")


def scd2_build(history: DataFrame, keys: list[str], tracked: list[str], day: str, ties: list[str] = ()) -> DataFrame:
    """Versions of each key from dated rows: a new one only where a tracked column changed.

    ``valid_from`` is the first day of a version, ``valid_to`` the first day of the next (exclusive). Rows
    of the same key and day are reduced to one before the window, which therefore sees at most one row per
    calendar day of a key.
    """
    order = [F.col(c).asc() for c in (*ties, *tracked)]
    daily = keep_first(history, [*keys, day], order) if order else history.dropDuplicates([*keys, day])
    w = Window.partitionBy(*keys).orderBy(day)
    marked = daily.withColumn("_hash", hash_key(*[F.col(c) for c in tracked]))
    changed = marked.withColumn("_before", F.lag("_hash").over(w)).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("_hash"))
    )
    following = F.lead(day).over(w)
    return changed.select(
        *keys, *tracked,
        F.col(day).alias("valid_from"),
        F.coalesce(following, _end()).alias("valid_to"),
        following.isNull().alias("is_current"),
        F.col("_hash").alias("row_hash"),
    )


def scd2_merge(current: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], day: str) -> DataFrame:
    """Merge a batch of dated rows into a versioned table.

    Versions of keys in the batch are rebuilt from their start days together with the batch, which also
    splits an interval when the batch is late. All other keys are copied as they are.
    """
    touched = batch.select(*keys).distinct()
    starts = current.join(touched, keys, "left_semi").select(
        *keys, *tracked, F.col("valid_from").alias(day), F.lit(1).alias("_rank")
    )
    arrived = batch.select(*keys, *tracked, day, F.lit(0).alias("_rank"))
    # On the same day the arriving row replaces the stored one.
    rebuilt = scd2_build(starts.unionByName(arrived), keys, tracked, day, ties=["_rank"])
    return current.join(touched, keys, "left_anti").unionByName(rebuilt)


def apply_changes(
    snapshot: DataFrame, log: DataFrame, keys: list[str], seq: str, op: str, deleted: str = "D"
) -> DataFrame:
    """A snapshot after a change log: per key the change with the greatest sequence counts.

    Snapshot rows enter as changes before all others, so one pass per key decides inserts, updates and
    deletes without a join.
    """
    columns = snapshot.columns
    base = snapshot.withColumns({seq: F.lit(None).cast(log.schema[seq].dataType), op: F.lit("S")})
    changes = base.unionByName(log.select(*columns, seq, op))
    order = [F.col(seq).desc_nulls_last(), *[F.col(c).asc() for c in columns if c not in keys]]
    return keep_first(changes, keys, order).where(F.col(op) != deleted).select(*columns)
