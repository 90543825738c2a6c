"""Shards by jump consistent hashing.

A document's key alone decides where it goes, and one more shard takes documents only into itself. Everything is
a column expression; only the optional numbering of a shard's rows needs a shuffle, and that of a few numbers a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import digest, fresh, hex_number

# The published generator: key * 2862933555777941757 + 1 modulo 2**64, here in 32- and 16-bit parts of the factor,
# because a product of longs is an error in Spark SQL when it overflows.
_HIGH, _LOW_1, _LOW_0 = 0x27BB2EE6, 0x87B0, 0xB0FD
_MASK = 0xFFFFFFFF
#: Steps that every key takes; beyond them only keys whose walk has not ended.
JUMPS = 64


def jump(key: str | Column, shards: int) -> Column:
    """struct(shard, grown): the shard of a key among ``shards``, and among one more.

    The state holds the current shard and the generator's halves; the next jump follows from them. A jump beyond the
    last shard ends the walk: later steps only return the state. A walk takes about as many jumps as the natural logarithm
    of ``shards``, so ``JUMPS`` steps end nearly all; the keys that are not through go on for as many as there can be.
    """

    def next_jump(s: Column) -> Column:
        return F.floor((s["b"] + 1) * (F.lit(2147483648.0) / (F.shiftright(s["hi"], 1) + 1))).cast("long")

    def step(s: Column, _: Column) -> Column:
        low = s["lo"] * _LOW_0 + 1 + F.shiftleft((s["lo"] * _LOW_1).bitwiseAND(0xFFFF), 16)
        carry = F.shiftright(low, 32) + F.shiftright(s["lo"] * _LOW_1, 16)
        high = carry + s["lo"] * _HIGH + s["hi"] * _LOW_0 + F.shiftleft((s["hi"] * _LOW_1).bitwiseAND(0xFFFF), 16)
        moved = F.struct(
            s["b"].alias("prev"), next_jump(s).alias("b"), high.bitwiseAND(_MASK).alias("hi"), low.bitwiseAND(_MASK).alias("lo")
        )
        return F.when(next_jump(s) <= shards, moved).otherwise(s)

    hex_digits = digest(key)
    start = F.struct(
        F.lit(-1).cast("long").alias("prev"), F.lit(-1).cast("long").alias("b"),
        hex_number(F.substring(hex_digits, 1, 8)).alias("hi"), hex_number(F.substring(hex_digits, 9, 8)).alias("lo"),
    )

    def result(s: Column) -> Column:
        return F.struct(
            F.when(s["b"] == shards, s["prev"]).otherwise(s["b"]).cast("int").alias("shard"), s["b"].cast("int").alias("grown"))

    def finish(s: Column) -> Column:
        if shards <= JUMPS:
            return result(s)
        rest = F.aggregate(F.sequence(F.lit(JUMPS), F.lit(shards)), s, step, result)
        return F.when(next_jump(s) <= shards, rest).otherwise(result(s))

    return F.aggregate(F.sequence(F.lit(0), F.lit(min(shards, JUMPS))), start, step, finish)


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """``docs`` with a column ``shard`` from 0 to ``shards`` - 1 (an own column of that name is replaced).

    Rows of equal key, repeated rows too, share a shard; a null key counts as an empty text. Texts are not looked at.
    An empty table stays empty.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    return docs.withColumn(shard, jump(key, shards)["shard"])


def with_slots(rows: DataFrame, shard: str = "shard", key: str = "doc_id", rows_a_bucket: int = 50_000) -> DataFrame:
    """``rows`` with a column ``slot``: 0, 1, 2, ... within each shard, without gaps.

    Rows stand in the order of a hash of their key, then of the other columns. The hash range is cut into buckets of
    about ``rows_a_bucket`` rows of a shard, which are numbered on their own and shifted by the rows before them; equal
    rows are counted first and numbered as one. So no task sees a whole shard, or all copies of a row.
    """
    slot, order, bucket, n, before = (fresh(rows, x) for x in ("slot", "_order", "_bucket", "_n", "_before"))
    total, columns = rows.count(), list(rows.columns)
    sizes = rows.select(shard).distinct().count()
    buckets = 1 + total // (max(1, sizes) * rows_a_bucket)
    keyed = rows.withColumn(order, hex_number(F.substring(digest(key), 17, 8))).withColumn(
        bucket, F.floor(F.col(order) * buckets / F.lit(2.0**32)).cast("long")
    )
    counted = keyed.groupBy(*columns, order, bucket).agg(F.count(F.lit(1)).alias(n))
    inside = Window.partitionBy(shard, bucket).orderBy(order, *(c for c in columns if c != shard))
    numbered = counted.withColumn(slot, F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(n))
    offsets = (
        keyed.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(n))
        .withColumn(before, F.coalesce(
            F.sum(n).over(Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop(n)
    )
    first = numbered.join(offsets, [shard, bucket]).withColumn(slot, F.col(slot) + F.col(before))
    return first.select(*columns, F.explode(F.sequence(F.col(slot), F.col(slot) + F.col(n) - 1)).alias(slot))
