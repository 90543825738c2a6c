"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six characters, in Java, RE2 and Python patterns alike.
WORD = r"[^\x20\x09-\x0D]+"
_CHECKPOINTS = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset (as in tests)."""
    root = spark.conf.get(_CHECKPOINTS, None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; the copy outlives lost executors.

    Shuffle files of the write go as it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_folder(spark, name), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def id_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % folds


def digest(key: str | Column) -> Column:
    """32 hex digits of a key as text; null counts as an empty text."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.coalesce(col.cast("string"), F.lit("")))


def hex_number(digits: Column) -> Column:
    """Up to 15 hex digits as a long."""
    return F.conv(digits, 16, 10).cast("long")


def join_small(big: DataFrame, small: DataFrame, on: str, max_rows: int = 100_000) -> DataFrame:
    """Left join with a staged table: broadcast if it is counted to be small, otherwise left to Spark (AQE splits skew)."""
    if small.count() <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on, "left")


def slices(texts: Sequence[str | None], max_chars: int = 250_000) -> Iterator[tuple[int, int]]:
    """Cut a batch of texts into runs of at most ``max_chars``, or of one text, so that work arrays stay small."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and held + n > max_chars:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) reaches, over links in either direction.

    Every round sends each node's neighbours to its smallest neighbour and keeps the smaller links (alternating
    large-star and small-star); the number of rounds grows with the logarithm of a component's size. Each round is
    written to the shared folder. Null ends and loops are ignored; a table without links gives no rows.
    """
    def digest_of(table: DataFrame) -> tuple:
        """Equal for equal sets of links."""
        h = F.xxhash64("a", "b")
        return tuple(table.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 32))).first())

    links = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    seen = digest_of(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        # large star: larger neighbours of a node go to its smallest neighbour
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        new = staged(small, name)
        discard(links)
        links, before, seen = new, seen, digest_of(new)
        if seen == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, keep: Column | None = None,
                    text: str = "text", doc_id: str = "doc_id") -> list:
    """Rows (text, label) of about ``most`` labelled documents, at most, in a fixed order: those of smallest id hash.

    A count tells which hashes to take, so only chosen texts reach the driver. Documents that occur several times count
    several times; labels that disagree on an id are each used.
    """
    slim = labels.where(F.col(label).isNotNull()) if keep is None else labels.where(F.col(label).isNotNull() & keep)
    slim = slim.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"), F.xxhash64(F.col(doc_id)).alias("h"))
    below = 2.0**64 * min(1.0, most / max(1, slim.count())) - 2.0**63
    chosen = slim.where(F.col("h").cast("double") <= below)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL").join(chosen, "doc_id")
    return sorted(rows.orderBy("h", F.md5("text")).limit(most).collect(), key=lambda r: (r.h, r.text))
