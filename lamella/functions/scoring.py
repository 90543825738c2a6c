"""Customer value tiers and recency/frequency/monetary segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest lifetime revenue of each tier, highest tier first; everything below is bronze.
LTV_TIERS = {"platinum": 5000, "gold": 1000, "silver": 250}


def ltv_tier(revenue: Column, tiers: dict[str, float] = LTV_TIERS) -> Column:
    result = None
    for name, floor in sorted(tiers.items(), key=lambda t: -t[1]):
        result = F.when(revenue >= floor, name) if result is None else result.when(revenue >= floor, name)
    return result.otherwise("bronze")


def rfm_score(r: Column, f: Column, m: Column) -> Column:
    return (r * 100 + f * 10 + m).cast("long")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Named segment of three scores; the rules overlap and the first that holds counts."""
    recent, stale = r >= 4, r <= 2
    return (
        F.when(recent & (f >= 4) & (m >= 4), "Champions")
        .when(recent & (f >= 3), "Loyal")
        .when(recent, "New Customers")
        .when((r == 3) & (f >= 2) & (m >= 2), "Potential Loyalists")
        .when(stale & (f >= 3), "At Risk")
        .when(stale & (m <= 2), "Lost")
        .when((r == 3) & (f <= 2), "About to Sleep")
        .when(stale & (f == 2), "Cant Lose Them")
        .otherwise("Other")
    )
