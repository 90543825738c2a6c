"""Exact global ranks, quantile cuts, percent ranks and medians without sending a table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.operators.skew import salted_join
from lamella.staging import stage

_LOW_BITS = 33  # monotonically_increasing_id keeps the row position below, the partition above


def global_rank(df: DataFrame, order: list[Column], into: str) -> DataFrame:
    """Number all rows 1..n in the given total order.

    The table is range-sorted (Spark samples the bounds; ties are split as long as ``order`` ends in a
    unique column), each row is numbered inside its partition, and the partition sizes turn that into a
    global number. The sorted table is written once, because sizes and numbers must come from the same
    partitions. The window over sizes has one row per partition, and the same few rows are broadcast.
    """
    numbered = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "rank")
    part = F.shiftright("_at", _LOW_BITS)
    place = F.col("_at").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(into, (F.col("_start") + place + 1).cast("long"))
        .select(*df.columns, into)
    )


def _cuts(df: DataFrame, value: str, parts: int) -> Column:
    """Ascending values that cut the distinct values of ``df`` into about equal parts, as an array of constant size."""
    shares = [i / parts for i in range(1, parts)]
    return df.select(F.array_distinct(F.percentile_approx(value, shares, 20 * parts))).scalar()


def percent_rank(df: DataFrame, value: str, unique: str, into: str, parts: int = 64) -> DataFrame:
    """``(first rank of the value - 1) / (n - 1)``, as the SQL function over the whole table.

    Rows are counted by value. A sketch of the values gives ``parts`` ranges that hold about equally many of them; counts
    are summed up inside a range, and the totals of the ranges before are added. So neither rows nor values are sorted as
    a whole, equal values are one row from the first aggregate on, and only the join back sees rows, split where a value is
    very frequent. ``df`` is read twice and should be a stored table if it is costly.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_ties"))
    below_it = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    ranged = counts.withColumn("_cuts", _cuts(counts, value, parts)).withColumn("_part", F.coalesce(below_it, F.lit(0))).drop("_cuts")
    totals = ranged.groupBy("_part").agg(F.sum("_ties").alias("_n"))
    # one row a range
    before = totals.select("_part", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    missing = df.select(F.count_if(F.col(value).isNull())).scalar()
    below = ranged.withColumn("_below", F.coalesce(F.sum("_ties").over(inside), F.lit(0))).join(F.broadcast(before), "_part")
    below = below.select(value, "_ties", (F.col("_below") + F.col("_before")).alias("_below"))
    total = df.select(F.count(F.lit(1))).scalar()
    joined = salted_join(df, below, [value], "_ties", [unique])
    # nulls come first, as in SQL
    lower = F.when(F.col(value).isNull(), 0).otherwise(F.col("_below") + missing)
    share = F.when(total > 1, lower / (total - 1)).otherwise(F.lit(0.0))
    return joined.withColumn(into, share.cast("double")).drop("_below", "_ties")


def quantile_cuts(df: DataFrame, unique: str, values: list[str], n: int = 5) -> dict[str, list[tuple]] | None:
    """Per value column the last (value, id) pair of every quantile but the highest.

    Quantiles follow linear interpolation on the ranks 1..N: rank r belongs to quantile
    ``max(1, ceil((r-1)*n/(N-1)))``, so quantile k ends at rank ``k*(N-1) div n + 1``. All columns are
    ranked in one sort of (column, value, id) triples. Only ``(n-1) * len(values)`` rows come back.
    Returns None when there are fewer rows than quantiles.
    """
    pairs = F.array(*[
        F.struct(F.lit(i).alias("_col"), F.col(v).cast("decimal(28,2)").alias("_val"))
        for i, v in enumerate(values)
    ])
    long = df.select(F.explode(pairs).alias("_p"), F.col(unique).alias("_id")).select("_p.*", "_id")
    ranked = global_rank(long, [F.col("_col"), F.col("_val"), F.col("_id")], "_rank")
    total = df.count()
    if total < n:
        return None
    ends = [k * (total - 1) // n + 1 for k in range(1, n)]
    wanted = [i * total + e for i in range(len(values)) for e in ends]
    cuts: dict[str, list[tuple]] = {v: [] for v in values}
    for row in ranked.where(F.col("_rank").isin(wanted)).orderBy("_rank").collect():
        cuts[values[row["_col"]]].append((row["_val"], row["_id"]))
    return cuts


def quantile_of(value: str, unique: str, cuts: list[tuple]) -> Column:
    """Quantile of a row, 1 = lowest: one more than the number of cuts below it."""
    v = F.col(value).cast("decimal(28,2)")
    above = F.lit(1)
    for cut_value, cut_id in cuts:
        limit = F.lit(cut_value).cast("decimal(28,2)")
        above = above + F.when((v > limit) | ((v == limit) & (F.col(unique) > F.lit(cut_id))), 1).otherwise(0)
    return above


def _magnitude(v: Column, steps: int = 256) -> Column:
    """Number of a cell of the number line: ``steps`` cells between a power of two and the next, in the order of values."""
    size = F.abs(v)
    power = F.floor(F.log2(size))
    # where a logarithm is rounded to the neighbouring power, the second term makes up for it
    cell = power * steps + F.floor((size / F.pow(F.lit(2.0), power) - 1) * steps) + F.lit(1 << 20)
    return F.when(v > 0, cell).when(v < 0, -cell).otherwise(0)


def exact_median(df: DataFrame, group: list[str], value: str, unique: str | None = None, into: str = "median") -> DataFrame:
    """Median of the non-null, finite values per group, with no group ever sorted or held in one task.

    A first aggregate counts rows by group and cell of the number line (256 to an octave), which tells in which cells the
    middle ranks lie. A second one counts the rows of those cells by value. Only counts are brought in order: a few
    thousand cells and the distinct values of a cell or two for each group. Nothing is stored; ``df`` is read twice.
    ``unique``, if given, spreads the rows of a very full cell over tasks, by default the value does.
    """
    key, cell = F.struct(*group).alias("_group"), _magnitude(F.col(value).cast("double")).alias("_cell")  # in a struct nulls are equal
    present = df.where(F.col(value).isNotNull()).select(key, cell, F.col(value).alias("_value"), F.col(unique or value).alias("_id"))

    def upto(*by: str, order: str) -> Column:
        return F.sum("_rows").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))

    cells = present.groupBy("_group", "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    placed = cells.withColumns({"_upto": upto("_group", order="_cell"), "_n": F.sum("_rows").over(Window.partitionBy("_group"))})
    lower, upper = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    holds = lambda r: (F.col("_upto") >= r) & (F.col("_upto") - F.col("_rows") < r)
    middle = placed.where(holds(lower) | holds(upper)).select(
        "_group", "_cell", "_rows", "_n", (F.col("_upto") - F.col("_rows")).alias("_before"))
    seen = salted_join(present, middle, ["_group", "_cell"], "_rows", ["_id"], how="inner")
    counts = seen.groupBy("_group", "_cell", "_value").agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_n").alias("_n"), F.first("_before").alias("_before"))
    exact = counts.withColumn("_upto", upto("_group", "_cell", order="_value") + F.col("_before"))
    found = exact.groupBy("_group").agg(
        F.max(F.when(holds(lower), F.col("_value"))).alias("_a"), F.max(F.when(holds(upper), F.col("_value"))).alias("_b"))
    return found.select("_group.*", ((F.col("_a") + F.col("_b")) / 2).cast("double").alias(into))
