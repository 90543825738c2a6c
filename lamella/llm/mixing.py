"""Mixing sources to target weights: Efraimidis-Spirakis sampling to word budgets.

Every document gets an exponential key scaled by its quality weight. A source first gives as many complete epochs as
its target holds; the rest goes to its documents of smallest keys, by prefix sums up to the budget. Sums run over a
fixed grid of key ranges, and only the range in which a source's budget ends is sorted, so a source with most of the
rows is never in one task. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import WORD, digest, discard, fresh, hex_number, join_small, staged

#: Ranges of keys for which sums are kept, for each source.
RANGES = 4096
# Characters that text rarely needs and markup, tables and junk are full of.
_SYMBOLS = "!#$%&*+/<=>@[]^_`{|}~\\"


def words(text: str | Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str | Column) -> Column:
    """From 0.1 to 1: the less symbols a text has, the heavier; an empty or null text weighs 1."""
    text = F.col(text) if isinstance(text, str) else text
    share = (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 4 * share), F.lit(1.0))


def sampling_key(doc_id: str | Column, weight: Column) -> Column:
    """-ln(u) / weight, where u in (0, 1) is a hash of the id: smallest first is sampling in proportion to weight."""
    u = (hex_number(F.substring(digest(doc_id), 20, 13)) + F.lit(0.5)) / F.lit(2.0**52)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources by code point, null last, get ``weights`` in turn and share ``share`` times all sizes by weight. No target
    goes beyond ``epochs`` times its source's size; what is cut off is shared anew among the others. Filling sources in
    the order of limit / weight gives that in one pass. The windows without a partition see one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = (
        sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int") + 1))
        .withColumn("limit", epochs * F.col("source_size"))
    )
    by = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = each.select(
        "source", "source_size", "w", "limit", F.row_number().over(by).alias("i"),
        ((share * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))).alias("level"),
    )
    # the first source whose limit is above the level sets it for itself and all after it
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.struct("i", "level"))).over(every)
    target = F.when(F.col("i") >= level["i"], level["level"] * F.col("w")).otherwise(F.col("limit"))
    return filled.select("source", "source_size", F.least(F.col("limit"), target).alias("target"))


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null"))


def _range_of(key: Column) -> Column:
    return F.least(F.lit(RANGES - 1), F.floor(RANGES * (1 - F.exp(-key)))).cast("int")


def _cut(rows: DataFrame, budgets: DataFrame, nearest: bool) -> DataFrame:
    """(source_key, cut, taken): the last (key, id) of each source that its budget reaches, and the words up to there.

    ``rows`` has source_key, doc_id, size, key; ``budgets`` has source_key, budget. Documents are taken while they fit,
    or, with ``nearest``, while half of them fits. A source in which none fits has a null cut.
    """
    at = _range_of(F.col("key"))
    sums = rows.groupBy("source_key", at.alias("at")).agg(F.sum("size").alias("size"))
    up_to = Window.partitionBy("source_key").orderBy("at")
    ends = (
        join_small(sums, budgets, "source_key")
        .withColumn("upto", F.sum("size").over(up_to.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("source_key").agg(
            F.first("budget").alias("budget"),
            F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("at", (F.col("upto") - F.col("size")).alias("before")))).alias("end"),
            F.max("at").alias("last"), F.sum("size").alias("all"),
        )
        # a budget that is never reached ends behind the last range
        .select("source_key", "budget", F.coalesce(F.col("end.at"), F.col("last") + 1).alias("end"),
                F.coalesce(F.col("end.before"), F.col("all")).alias("before"))
    )
    ends = staged(ends, "mix-ends")
    near = join_small(rows.withColumn("at", at), ends, "source_key")
    # of the ranges before the last one only the greatest key is needed, of the last one every document
    inside = near.where("at = end").withColumn(
        "upto", F.col("before") + F.sum("size").over(
            Window.partitionBy("source_key").orderBy("key", F.col("doc_id").cast("string"), "size").rowsBetween(Window.unboundedPreceding, 0)))
    fits = F.col("upto") - (F.col("size") / 2 if nearest else F.lit(0)) <= F.col("budget")
    place = F.struct("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    whole = near.where("at < end").groupBy("source_key").agg(F.max(place).alias("cut"), F.first("before").alias("taken"))
    some = inside.where(fits).groupBy("source_key").agg(F.max(place).alias("cut"), F.max("upto").alias("taken"))
    return whole.unionByName(some).groupBy("source_key").agg(F.max("cut").alias("cut"), F.max("taken").alias("taken"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0,
             doc_id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """The slim rows of ``docs`` (doc_id, source_key, size, key) and the plan of each source, both staged.

    A plan holds source_size, target, the number of complete epochs, and where the fractional selection ends: at
    ``cut`` (key, id); documents behind it join up to ``cut_2`` if they have at most twice the ``gap`` that is left, which
    brings a source whose budget ends in a long document near its target: it is missed by half a document at most.
    """
    slim = staged(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), _source_key(source).alias("source_key"),
        words(text).alias("size"), sampling_key(doc_id, quality_weight(text)).alias("key")), "mix-rows")
    sizes = slim.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weights, share, epochs)
    plans = staged(
        targets.select(_source_key("source").alias("source_key"), "source_size", "target")
        .withColumn("epochs", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("int"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    rows = slim.where("size > 0").select("source_key", "doc_id", "size", "key")
    first = staged(
        plans.join(_cut(rows, plans.select("source_key", "budget"), nearest=False), "source_key", "left")
        .withColumn("gap", F.col("budget") - F.coalesce("taken", F.lit(0))).drop("taken"), "mix-cut")
    left = join_small(rows, first.select("source_key", "cut", "gap"), "source_key")
    place = F.struct("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    left = left.where(F.col("cut").isNull() | (place > F.col("cut"))).where("size <= 2 * gap")
    second = _cut(left.select("source_key", "doc_id", "size", "key"), first.select("source_key", F.col("gap").alias("budget")), nearest=True)
    full = staged(first.join(second.select("source_key", F.col("cut").alias("cut_2")), "source_key", "left"), "mix-plan")
    discard(plans)
    return slim, full


def copies(size: str, key: str, doc_id: str) -> Column:
    """How often a document is taken, from its own columns and those of its source's plan."""
    place = F.struct(F.col(key).alias("key"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"))
    chosen = (place <= F.col("cut")) | ((F.col(size) <= 2 * F.col("gap")) & (place <= F.col("cut_2")))
    return F.col("epochs") + F.coalesce(chosen & (F.col(size) > 0), F.lit(False)).cast("int")


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of ``docs``.

    Rows with a null source form one source. Rows that agree in id, source and text are taken or left together. Texts
    that are empty or null have size 0 and add nothing. An empty table gives no rows. Reruns agree: keys are hashes.
    """
    slim, plan = plan_mix(docs, **options)
    return join_small(slim, plan, "source_key").select(
        "doc_id", "size", "source_size", "target", (copies("size", "key", "doc_id") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as its source's plan takes it, with the columns of ``docs``.

    Rows without words stand for nothing in a budget and are kept as often as their source has complete epochs. Columns
    of any other name pass through.
    """
    _, plan = plan_mix(docs, doc_id=doc_id, text=text, source=source, **options)
    names = {x: fresh(docs, f"_mix_{x}") for x in ("size", "key", "copy")}
    held = "_mix_row"
    own = docs.select(
        F.struct(*docs.columns).alias(held), F.col(doc_id).alias("doc_id"), _source_key(source).alias("source_key"),
        words(text).alias(names["size"]), sampling_key(doc_id, quality_weight(text)).alias(names["key"]))
    taken = join_small(own, plan, "source_key").withColumn(names["copy"], copies(names["size"], names["key"], "doc_id"))
    return taken.where(F.col(names["copy"]) > 0).select(
        held, F.explode(F.sequence(F.lit(1), F.col(names["copy"])))).select(f"{held}.*")
