"""Writers of layer tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamella.sources import commits


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of by a second job."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_partition(df: DataFrame, path: str, keys: list[str], owned: list[dict] | None = None) -> int:
    """Replace the partitions that ``owned`` names, or else those that occur in ``df``; returns the number of rows written.

    A run that names what it owns also clears what it no longer has rows for. The switch is whole: a run that fails leaves
    the table as it was. Rows of a partition are brought together before the write, so that it does not end in many small files;
    ``rebalance`` lets Spark split a partition value that holds a large part of all rows.
    """
    counted, seen = _counted(df.hint("rebalance", *keys))
    commits.commit(counted, path, keys, owned)
    return seen.get["rows"]


def write_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> int:
    """Replace a whole table."""
    balanced = df.hint("rebalance", *partition_by) if partition_by else df
    counted, seen = _counted(balanced)
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def write_clustered(df: DataFrame, path: str, day: str, cluster: list[str], unique: str) -> int:
    """Month partitions, rows ordered by the cluster columns inside them.

    The range ends in a unique column, so that one busy month or state is cut into several tasks. Sorted
    files have narrow min/max statistics, by which readers skip row groups.
    """
    keyed = df.withColumn("month", F.trunc(day, "MM"))
    order = ["month", *cluster, unique]
    counted, seen = _counted(keyed.repartitionByRange(*order).sortWithinPartitions(*order))
    counted.write.mode("overwrite").partitionBy("month").parquet(path)
    return seen.get["rows"]


def oldest_kept(reference_date: str, years: int = 0, days: int = 0) -> Column:
    return F.date_sub(F.add_months(F.lit(reference_date).cast("date"), -12 * years), days)


def retention_prune(df: DataFrame, day: str, reference_date: str, years: int = 0, days: int = 0) -> DataFrame:
    """Rows still inside the retention time. On a partition column this reads no expired file."""
    return df.where(F.col(day) >= oldest_kept(reference_date, years, days))


# How long each layer is kept.
RETENTION = {"bronze": {"years": 7}, "silver": {"years": 3}, "gold": {"years": 2}, "quarantine": {"days": 90}}


_DIGITS = 12  # hexadecimal digits of a text that a double holds exactly


def _numbers(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """For each column a number in the order of its values; texts by the six bytes after the prefix that all of them share."""
    texts = [c for c in columns if df.schema[c].dataType.simpleString() == "string"]
    ends = df.select(*(f(F.substring(F.hex(c), 1, 2000)).alias(f"{n}_{i}") for i, c in enumerate(texts)
                       for n, f in (("low", F.min), ("high", F.max)))).first() if texts else {}
    numbers = {}
    for name in columns:
        kind, c = df.schema[name].dataType.simpleString(), F.col(name)
        if kind == "string":
            i = texts.index(name)
            shared = os.path.commonprefix([ends[f"low_{i}"] or "", ends[f"high_{i}"] or ""])
            numbers[name] = F.conv(F.rpad(F.substring(F.hex(c), len(shared) + 1, _DIGITS), _DIGITS, "0"), 16, 10).cast("double")
        else:
            numbers[name] = (F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else c).cast("double")
    return numbers


def interleaved_key(df: DataFrame, columns: list[str], bits: int = 8) -> Column:
    """Bits of the columns' places in turn, the highest first: near keys are near in every column.

    A column's place is the number of its quantiles below the value, of ``2 ** bits - 1`` that a sketch over all rows gives, so
    dense ranges of values get more places than thin ones. The cuts have a constant size, and a value is placed among
    them by halving. Nulls stand first.
    """
    numbers, shares = _numbers(df, columns), [i / 2**bits for i in range(1, 2**bits)]
    row = df.select(*(F.percentile_approx(numbers[c], shares, 20 * 2**bits).alias(c) for c in columns)).first()
    halves = F.array(*(F.lit(2**b) for b in reversed(range(bits))))
    key = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        cuts, value = F.array(*(F.lit(x) for x in row[name] or [])).cast("array<double>"), numbers[name]
        place = F.aggregate(
            halves, F.lit(0),
            lambda at, half: F.when(F.get(cuts, at + half - 1) < value, at + half).otherwise(at))  # noqa: B023
        for b in range(bits):
            moved = F.shiftleft(F.shiftright(place, b).bitwiseAND(1).cast("long"), b * len(columns) + len(columns) - 1 - i)
            key = key.bitwiseOR(moved)
    return key


def write_interleaved(df: DataFrame, path: str, columns: list[str], unique: str, files: int | None = None, bits: int = 8) -> int:
    """Rows in the order of an interleaved key, so that a filter on any one of ``columns`` skips files.

    With rows sorted by one column after the other only the first one has narrow minima and maxima in files; here all have.
    The range ends in a unique column, so equal values can be cut over files. ``df`` is read up to four times (shared prefixes of texts,
    sketch, bounds of the range, rows) and should be a stored table. At most 63 bits fit a key.
    """
    if bits * len(columns) > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a key")
    keyed = df.withColumn("_z", interleaved_key(df, columns, bits))  # one number a row, dropped before the write
    order = ["_z", unique]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    counted, seen = _counted(ranged.sortWithinPartitions(*order).drop("_z"))
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]
