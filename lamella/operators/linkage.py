"""Links between record types: integrity checks, exact and near matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.dedupe import keep_first
from lamella.operators.skew import place


def orphans(children: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``children`` that refer to no row of ``parents``."""
    return children.join(parents.select(*on), on, "left_anti")


def having(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """Rows that occur at least once in ``others``; its keys are made distinct before the join."""
    return rows.join(others.select(*on).distinct(), on, "left_semi")


def link_exact(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on equal, filled keys. A null key never links."""
    return left.join(right, on, how)


def nearest_by_key(
    probes: DataFrame, targets: DataFrame, on: list[str], probe_day: str, target_day: str, target_id: str
) -> DataFrame:
    """For each distinct (key, probe day) the target of the same key nearest in time, ties by smallest id.

    Both sides are first reduced to one row per key and day, then merged on one time line per key: the
    nearest target is the last one before or the first one after. So a key shared by very many rows costs
    one row per calendar day and never a pair of rows.
    """
    asked = probes.select(*on, F.col(probe_day).alias("_day")).distinct()
    offered = targets.groupBy(*on, F.col(target_day).alias("_day")).agg(F.min(target_id).alias("_id"))
    line = asked.select(*on, "_day", F.lit(None).cast(offered.schema["_id"].dataType).alias("_id"), F.lit(True).alias("_asks"))
    line = line.unionByName(offered.select(*on, "_day", "_id", F.lit(False).alias("_asks")))
    seen = F.when(~F.col("_asks"), F.struct(F.col("_day").alias("d"), F.col("_id").alias("i")))
    # Both frames grow, one along each direction of time (a shrinking frame would be recomputed per row), and
    # being range frames they include the targets of the same day.
    so_far = Window.unboundedPreceding, Window.currentRow
    forward = Window.partitionBy(place(*on), *on).orderBy(F.col("_day").asc()).rangeBetween(*so_far)
    backward = Window.partitionBy(place(*on), *on).orderBy(F.col("_day").desc()).rangeBetween(*so_far)
    before = F.last(seen, ignorenulls=True).over(forward)
    after = F.last(seen, ignorenulls=True).over(backward)
    both = line.withColumns({"_b": before, "_a": after}).where("_asks")
    gap_b, gap_a = F.datediff("_day", "_b.d"), F.datediff("_a.d", "_day")
    use_after = F.col("_b").isNull() | (gap_a < gap_b) | ((gap_a == gap_b) & (F.col("_a.i") < F.col("_b.i")))
    best = F.when(F.coalesce(use_after, F.lit(False)), F.col("_a")).otherwise(F.col("_b"))
    return both.select(*on, F.col("_day").alias(probe_day), best["i"].alias(target_id)).where(F.col(target_id).isNotNull())


def _amount_slot(amount: Column) -> Column:
    """Amounts within 1 % of each other fall into the same or neighbouring slots; zero has its own."""
    return F.when(amount > 0, F.floor(F.log(amount.cast("double")) / F.log(F.lit(1.02))).cast("long")).otherwise(F.lit(-(10**6)))


def near_by_amount_and_day(
    probes: DataFrame,
    targets: DataFrame,
    key: str,
    probe_amount: str,
    probe_day: str,
    target_amount: str,
    target_day: str,
    target_id: str,
    days: int = 90,
) -> DataFrame:
    """Best target of the same key, amount within 1 % of its own, ``days`` or less before the probe.

    Rows of one key are cut into cells of time (``days`` long) and amount (2 % wide); a probe looks into its
    own and the neighbouring cells. Both sides are reduced to distinct (key, amount, day) before, so copies
    meet once, and a cell can hold no more rows than it has days and cent amounts.
    """
    asked = probes.select(key, F.col(probe_amount).alias("_pa"), F.col(probe_day).alias("_pd")).distinct()
    offered = targets.groupBy(key, F.col(target_amount).alias("_ta"), F.col(target_day).alias("_td")).agg(
        F.min(target_id).alias("_id")
    )

    def day_slot(c: str) -> Column:
        return F.floor(F.unix_date(c) / days).cast("long")

    offered = offered.withColumns({"_ds": day_slot("_td"), "_as": _amount_slot(F.col("_ta"))})
    slot = _amount_slot(F.col("_pa"))
    asked = asked.withColumn("_ds", F.explode(F.array(day_slot("_pd"), day_slot("_pd") - 1))).withColumn(
        "_as", F.explode(F.array(slot - 1, slot, slot + 1))
    )
    gap = F.datediff("_pd", "_td")
    pairs = asked.join(offered, [key, "_ds", "_as"]).where(
        gap.between(0, days) & (F.abs(F.col("_pa") - F.col("_ta")) * 100 <= F.col("_ta"))
    )
    best = keep_first(pairs.withColumn("_gap", gap), [key, "_pa", "_pd"], [F.col("_gap").asc(), F.col("_id").asc()])
    return best.select(
        key, F.col("_pa").alias(probe_amount), F.col("_pd").alias(probe_day), F.col("_id").alias(target_id)
    )
