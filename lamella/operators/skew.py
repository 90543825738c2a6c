"""Joins whose key may be very unevenly spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.staging import stage


def place(*on: str | Column) -> Column:
    """A number that goes before the key columns ``on`` where rows are sorted by them; the columns stay part of the key.

    Sorts compare 8 bytes of the first column, and only where these are equal, rows with all columns. Ids and court names
    begin alike ("TX_Harris_County_"), so nearly every comparison would read the rows; numbers mostly differ.
    """
    return F.xxhash64(*on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    rows: str,
    spread: list[str],
    how: str = "left",
    share: int = 200,
) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key and, in ``rows``, the number of left rows of it.

    A key with at least 1/``share`` of all left rows is split: its left rows are spread by a hash of the
    unique columns ``spread``, its right row is copied once per split. There can be at most ``share`` such
    keys, so their list is small enough to broadcast and the copies add at most 2 x ``share`` rows. Rows
    without a key match nothing and are spread too. The hash makes a retried task repeat its choice.

    ``right`` is written once: its sum, its hot keys and its copies would each work it out again.
    """
    right = stage(right, "salted")
    total = right.select(F.sum(rows)).scalar()
    splits = F.ceil(F.try_divide(F.col(rows) * share, total)).cast("int")
    is_hot = (F.col(rows) * share >= total) & (F.col(rows) > 0)
    hot = right.where(is_hot).select(*on, splits.alias("_splits"))
    copies = F.when(is_hot, F.sequence(F.lit(0), splits - 1)).otherwise(F.array(F.lit(0)))
    return _salted(left, hot, right.withColumn("_salt", F.explode(copies)), on, spread, how, share)


def salted_lookup(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], share: int = 200) -> DataFrame:
    """Left join as ``salted_join``, where the rows of a key are known from ``left`` only: a stored table, counted here.

    Only the keys that are split meet ``right`` before the join, so ``right`` is neither joined to all counts nor stored.
    """
    total = left.select(F.count(F.lit(1))).scalar()
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") * share >= total)
    hot = F.broadcast(counts.select(*on, F.ceil(F.try_divide(F.col("_rows") * share, total)).cast("int").alias("_splits")))
    last = F.coalesce("_splits", F.lit(1)) - 1
    copied = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_splits")
    return _salted(left, hot, copied, on, spread, "left", share)


def _salted(
    left: DataFrame, hot: DataFrame, copied: DataFrame, on: list[str], spread: list[str], how: str, share: int
) -> DataFrame:
    """``left``, salted by the splits of its ``hot`` keys, joined to the rows that were copied once a salt."""
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    spread_over = F.when(missing, F.lit(share)).otherwise(F.coalesce("_splits", F.lit(1)))
    salted = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), spread_over).cast("int"))
        .drop("_splits")
    )
    sides = [side.withColumn("_place", place(*on, "_salt")) for side in (salted, copied)]
    return sides[0].join(sides[1], ["_place", *on, "_salt"], how).drop("_place", "_salt")


def left_join_filled(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join in which rows without a complete key bypass the shuffle.

    They match nothing, and hashed by their null they would all end up in one task.
    """
    filled = F.lit(True)
    for key in on:
        filled = filled & F.col(key).isNotNull()
    joined = left.where(filled).join(right, on, "left")
    return joined.unionByName(left.where(~filled), allowMissingColumns=True)
