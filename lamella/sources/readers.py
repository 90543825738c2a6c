"""Readers of raw files. Every source field arrives as text; nothing is interpreted here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lamella.sources import commits
from lamella.specs import SourceSpec

CORRUPT = "_corrupt_record"

# Control characters, which JSON must escape: no document holds them, so a file read in lines that end there is one line.
_NEVER_IN_JSON = "\x1e" * 8


def all_text(names: list[str], corrupt: bool = False) -> StructType:
    names = [*names, CORRUPT] if corrupt else names
    return StructType([StructField(n, StringType()) for n in names])


def read_csv_raw(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8",
    fields: list[str] | None = None, keep_malformed: bool = False,
) -> DataFrame:
    """Delimited text with a header. With ``fields`` the header is not read to find the columns, and with
    ``keep_malformed`` lines of the wrong width keep their text in ``_corrupt_record``."""
    options = {"header": True, "sep": sep, "encoding": encoding, "inferSchema": False}
    if not fields:
        return spark.read.options(**options).csv(path)
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.options(**options).schema(all_text(fields, keep_malformed)).csv(path)


def read_json_raw(
    spark: SparkSession, path: str, fields: list[str] | None = None, multiline: bool = True,
    keep_malformed: bool = False,
) -> DataFrame:
    """JSON documents; objects and arrays inside a field stay as their JSON text.

    ``multiline`` reads pretty-printed files and top-level arrays, whole file by file. Without ``fields``
    their names are found by one extra pass.

    A whole file is read as one long line. Spark's ``multiLine`` would parse the open file and, to keep the text of
    each object or array, seek back and forth in it once per field; out of a line in memory the text is copied.
    """
    reader = spark.read.option("lineSep", _NEVER_IN_JSON) if multiline else spark.read
    if not fields:
        fields = [f.name for f in reader.json(path).schema if f.name != CORRUPT]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return reader.options(**options).schema(all_text(fields, keep_malformed)).json(path)


def read_jsonl_raw(spark: SparkSession, path: str, fields: list[str] | None = None, **more) -> DataFrame:
    """One JSON document per line; files are split among tasks."""
    return read_json_raw(spark, path, fields, multiline=False, **more)


def read_xml_raw(spark: SparkSession, path: str, row_tag: str, fields: list[str] | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", False)
    if fields:
        return reader.schema(all_text(fields)).load(path)
    df = reader.load(path)
    nested = [f.name for f in df.schema if not isinstance(f.dataType, StringType)]
    return df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns])


def read_fixed_width(spark: SparkSession, path: str, layout: list[tuple[str, int, int]], encoding: str = "utf-8"):
    """``layout`` lists (name, first position from 1, length). Blank fields become empty text."""
    lines = spark.read.option("encoding", encoding).text(path)
    return lines.select(*[F.trim(F.substring("value", start, length)).alias(n) for n, start, length in layout])


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """All partitions of a stored table; columns are matched by name and absent ones are null."""
    return commits.read(spark, path)


def read_partition(spark: SparkSession, path: str, **keys) -> DataFrame:
    """Only the partitions with these values. The filter stays on the bare columns, so files are pruned."""
    df = read_layer(spark, path)
    for name, value in keys.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


# Several formats share names of options; unknown formats must fail, never fall back.
READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv_raw,
    "json": read_json_raw,
    "jsonl": read_jsonl_raw,
    "xml": read_xml_raw,
    "fixed_width": read_fixed_width,
}


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.format not in READERS:
        raise ValueError(f"unknown format {spec.format!r} of source {spec.name!r}; known: {sorted(READERS)}")
    return READERS[spec.format](spark, spec.path, **spec.options)


def external_table(spark: SparkSession, name: str, path: str, schema: StructType, partition_by: list[str]) -> DataFrame:
    """Register stored Parquet partitions as a table; dropping the table leaves the files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{k}`" for k in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)
