"""I-Match fingerprints: hashes of the terms within a band of document frequencies, for many random lexicon subsets.

A lexicon of terms that are neither rare nor common is taken from all documents. A text's distinct lexicon terms are
hashed once for each subset of the lexicon. Subsets come in families: each level of a family drops half of the terms of
the level before, so short texts agree in large subsets and long texts in small ones. The hash of a set of terms is the
exclusive or of their hashes, which is what hashing the sorted list stands for: one value for a set in any order, and
Spark can aggregate it. Everything is a column expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import fresh, staged

#: A lexicon of at most so many terms is sent to all tasks, a larger one is joined by shuffle.
SENT = 100_000
FAMILIES, LEVELS = 8, 10
#: A fingerprint is this many longs of four marks of 16 bits; mark i belongs to level i // FAMILIES.
LONGS = FAMILIES * LEVELS // 4
_MARKS = [f"mark_{i}" for i in range(LONGS)]


def terms(text: str | Column) -> Column:
    """Distinct terms of a text: lower-cased runs of letters and digits, and sometimes an empty one; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"))


def learn_lexicon(docs: DataFrame, text: str = "text", least: float = 0.001, most: float = 0.2) -> DataFrame:
    """The lexicon (term, mark_0, mark_1, ...), staged: terms in a share of documents from ``least`` to ``most``, but two
    documents at least, with their hash in the subsets that they belong to and 0 in the others.

    Frequencies are counted over all documents and every term of the band belongs. There are at most as many rows as the
    mean number of distinct terms of a document divided by ``least``, however many documents there are.
    """
    total = docs.count()
    each = docs.select(F.explode(terms(text)).alias("term")).where("term <> ''").select(F.xxhash64("term").alias("term"))
    counted = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = counted.where((F.col("df") >= max(2.0, least * total)) & (F.col("df") <= max(2.0, most * total)))

    def mark(i: int) -> Column:
        """The hash of a term in subset i, if it belongs there: the lowest bits of its family's hash are zero."""
        level, family = divmod(i, FAMILIES)
        inside = F.xxhash64("term", F.lit(family)).bitwiseAND(2 ** (level + 1) - 1) == 0
        return F.when(inside, F.pmod(F.xxhash64("term", F.lit(1000 + i)), F.lit(65_535)) + 1).otherwise(F.lit(0))

    packed = [
        reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(mark(4 * n + k).cast("long"), 16 * k) for k in range(4)]).alias(name)
        for n, name in enumerate(_MARKS)
    ]
    return staged(band.select("term", *packed), "imatch-lexicon")


def mark_texts(rows: DataFrame, texts: dict[str, str], lexicon: DataFrame, sent: int = SENT) -> DataFrame:
    """``rows`` with, for each item ``name: text column`` of ``texts``, a fingerprint array<long> in place of the text.

    Terms are looked up in the lexicon, which is counted and sent to all tasks if it has at most ``sent`` rows, otherwise
    joined by shuffle. A text without a lexicon term is represented by all of its terms, so that short texts differ too.
    If ``rows`` are partitioned by one of the other columns and the lexicon is sent, nothing is shuffled.
    """
    row, side, term, known = (fresh(rows, x) for x in ("_row", "_side", "_term", "_known"))
    names, kept = list(texts), [c for c in rows.columns if c not in texts.values()]
    numbered, small = rows.withColumn(row, F.monotonically_increasing_id()), lexicon.count() <= sent
    if not small:
        # row numbers must not change when a task that feeds the shuffle is repeated
        numbered = staged(numbered, "imatch-rows")
    lexicon = lexicon.withColumnRenamed("term", known)
    sides = numbered.select(
        *kept, row, F.explode(F.array(*(F.struct(F.lit(i).alias("side"), terms(texts[x]).alias("terms")) for i, x in enumerate(names)))).alias(side))
    found = (
        sides.select(*kept, row, F.col(f"{side}.side").alias(side), F.explode(f"{side}.terms").alias(term))
        .withColumn(term, F.when(F.col(term) != "", F.xxhash64(term)))
        .join(F.broadcast(lexicon) if small else lexicon.hint("merge"), F.col(term) == F.col(known), "left")
    )
    hashed = found.groupBy(*kept, row, side).agg(
        *(F.bit_xor(m).alias(m) for m in _MARKS), F.count(known).alias(known), F.bit_xor(term).alias(term))
    whole = [F.coalesce(F.xxhash64(F.col(term), F.lit(n)) * F.col(term).isNotNull().cast("long"), F.lit(0).cast("long")) for n in range(LONGS)]
    marks = F.array(*(F.when(F.col(known) > 0, F.coalesce(m, F.lit(0))).otherwise(w) for m, w in zip(_MARKS, whole, strict=True)))
    marked = hashed.select(*kept, row, side, marks.alias(term))
    if len(names) == 1:
        return marked.select(*kept, F.col(term).alias(names[0]))
    return marked.groupBy(*kept, row).agg(*(F.max(F.when(F.col(side) == i, F.col(term))).alias(x) for i, x in enumerate(names))).drop(row)


def as_text(marks: Column) -> Column:
    """A fingerprint as hexadecimal text, sixteen digits a long."""
    return F.concat(*(F.lpad(F.lower(F.hex(marks[i])), 16, "0") for i in range(LONGS)))


def _lanes(marks: Column) -> Column:
    """The single marks, by level and family."""
    each = lambda x: F.array(*(F.shiftright(x, 16 * k).bitwiseAND(65_535) for k in range(4)))
    return F.flatten(F.transform(marks, each))


def likeness(left: Column, right: Column) -> Column:
    """From 0 to 1: the share of equal subsets among those that are not empty on both sides.

    It is taken over the levels from the first on in which some subset is empty on both sides: denser levels hold so many
    terms each that any edit changes all of them. If every level is dense the last one counts; equal fingerprints give 1.
    """
    states = F.zip_with(_lanes(left), _lanes(right), lambda a, b: F.when((a == 0) & (b == 0), 0).when(a == b, 1).otherwise(2))

    def share(part: Column) -> Column:
        return F.size(F.filter(part, lambda s: s == 1)) / F.nullif(F.size(F.filter(part, lambda s: s > 0)), F.lit(0))

    first = F.array_position(states, F.lit(0))
    start = F.when(first == 0, F.lit((LEVELS - 1) * FAMILIES)).otherwise(F.floor((first - 1) / FAMILIES) * FAMILIES).cast("int")
    sparse = F.slice(states, start + 1, F.lit(LEVELS * FAMILIES))
    return F.when(left == right, F.lit(1.0)).otherwise(F.coalesce(share(sparse), share(states), F.lit(0.0))).cast("double")


def fingerprints(docs: DataFrame, lexicon: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``; null texts count as empty, repeated rows are each returned."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return mark_texts(slim, {"marks": "text"}, lexicon).select("doc_id", as_text(F.col("marks")).alias("fingerprint"))


def ring(ids: DataFrame) -> DataFrame:
    """(doc_id, ..., next_id) of distinct ids: the following id in ascending order, after the last the first.

    Ids are sorted in ranges, and the last id of each range follows up with the first of the next; no task sees all ids.
    """
    ranged = staged(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "imatch-ids")
    inside = ranged.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id")))
    parts = ranged.groupBy("part").agg(F.min("doc_id").alias("first"))
    # one row a range
    follow = parts.select("part", F.coalesce(
        F.lead("first").over(Window.orderBy("part")), F.min("first").over(Window.partitionBy())).alias("follower"))
    return inside.join(follow, "part").select(*ids.columns, F.coalesce("next_id", "follower").alias("next_id"))


def compare_with_edits(docs: DataFrame, lexicon: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Fingerprints of texts and of their edited forms, and how alike they are.

    The edited form replaces the last quarter of a text (code points, rounded down) by the beginning of the next document
    in ascending id, after the last the first. Of several rows of one id the first text is the next one of the id before;
    rows without id have no next document: their last quarter is cut. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """
    # an alias only where it renames: the two joins must read texts by the same plan for Spark to shuffle them once
    id_column = F.col(doc_id) if doc_id == "doc_id" else F.col(doc_id).alias("doc_id")
    base = docs.select(id_column, F.coalesce(F.col(text), F.lit("")).alias("text"))
    alone = base.where("doc_id IS NULL").withColumns({"next_id": F.col("doc_id"), "head": F.lit("")})
    base = base.where("doc_id IS NOT NULL")
    ids = base.groupBy("doc_id").agg((F.max(F.length("text")) / 4).cast("int").alias("room"), F.count(F.lit(1)).alias("rows"))
    links = staged(ring(ids), "imatch-ring")
    repeated = not links.where("rows > 1").isEmpty()
    heads = base.join(links.select(F.col("doc_id").alias("for_id"), "room", F.col("next_id").alias("doc_id")), "doc_id").select(
        F.col("for_id").alias("doc_id"), F.col("doc_id").alias("next_id"), F.substr("text", F.lit(1), F.col("room")).alias("head"))
    if repeated:
        heads = heads.groupBy("doc_id", "next_id").agg(F.min("head").alias("head"))
    n, cut = F.length("text"), (F.length("text") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.coalesce(F.substr("head", F.lit(1), cut), F.lit("")))
    rows = base.join(heads, "doc_id")
    if not alone.isEmpty():
        rows = rows.unionByName(alone)
    rows = rows.select("doc_id", "next_id", "text", edited.alias("edited"), n.cast("long").alias("n_chars"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    marked = staged(mark_texts(rows, {"marks": "text", "edited_marks": "edited"}, lexicon), "imatch-marks")
    following = marked.select(F.col("doc_id").alias("next_id"), F.col("marks").alias("next_marks")).where("next_id IS NOT NULL")
    if repeated:
        following = following.groupBy("next_id").agg(F.min("next_marks").alias("next_marks"))
    return marked.join(following, "next_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("marks")).alias("fingerprint"),
        as_text(F.col("edited_marks")).alias("edited_fingerprint"), likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        F.coalesce(likeness(F.col("marks"), F.col("next_marks")), F.lit(0.0)).alias("near_next"))
