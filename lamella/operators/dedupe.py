"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.skew import place


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row per key in a total order.

    The filter sits directly on the row number, so Spark keeps one row per key in every map task before
    the shuffle. A key holding a third of the table sends one row per map task, not a third of the table.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: list[str], newest: str, ties: list[str] | None = None) -> DataFrame:
    """Latest row per key; equal times fall back to all other columns, so the choice is repeatable.

    The rows are wide and their ids begin alike, so they are sorted by ``place`` first.
    """
    ties = ties if ties is not None else [c for c in df.columns if c not in (*keys, newest)]
    return keep_first(df, [place(*keys), *keys], [F.col(newest).desc(), *[F.col(c).asc() for c in ties]])


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, into: str = "rank") -> DataFrame:
    """First ``k`` rows per group with their place, cut down before the shuffle as in ``keep_first``."""
    w = Window.partitionBy(*group).orderBy(*order)
    first = df.withColumn(into, F.row_number().over(w)).where(F.col(into) <= k)
    return first.withColumn(into, F.col(into).cast("long"))


def latest_in_lookback(df: DataFrame, keys: list[str], ts: str, days: int, ties: list[str]) -> DataFrame:
    """Rows of one key form a chain while consecutive gaps stay within ``days``; keep the last of each chain.

    A row ends a chain when no later row of its key follows within ``days``. Cutting time into slots of
    exactly that length, only the last row of a slot can end one, and only the first row of the next slot
    can prevent it. So rows are reduced per (key, slot) first, and the window that looks at the next slot
    sees at most one row per slot of the calendar, however many rows a key has.
    """
    slot = F.floor(F.unix_micros(ts) / F.lit(days * 86_400_000_000)).cast("long")
    slotted = df.withColumn("_slot", slot)
    firsts = slotted.groupBy(*keys, "_slot").agg(F.min(ts).alias("_first"))
    lasts = keep_first(slotted, [*keys, "_slot"], [F.col(ts).desc(), *[F.col(t).desc() for t in ties]])
    # firsts and lasts are unique per (key, slot): joining them cannot multiply or skew.
    joined = lasts.join(firsts, [*keys, "_slot"])
    nxt = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slot"))
    return (
        joined.withColumn("_next", nxt)
        .where(F.col("_next").isNull() | (F.col("_next") > F.col(ts) + F.expr(f"interval {days} days")))
        .select(*df.columns)
    )
