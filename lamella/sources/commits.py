"""Whole commits of partitions: a run replaces the partitions it owns, all of them or none.

A run writes its files into a hidden folder beside the live partitions, then publishes a manifest that says which
partitions it owns and which it has written. The manifest is the commit: before it the table is as it was, after it the
switch is carried out, and whoever opens the table next finishes a switch that was cut short. Owned partitions that the
run did not write are cleared, so a rerun without rows leaves none. Live partitions are plain ``key=value`` folders, which
any reader understands; folders that begin with an underscore and have no ``=`` are not seen by Spark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_PENDING, _MANIFESTS, _SCHEMA = "_pending", "_manifests", "_schema/schema.json"


class _Files:
    """The file operations of the table's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def clear(self, name: str) -> None:
        """Remove a partition and the folders above it that it leaves empty."""
        self.remove(name)
        above = name.rpartition("/")[0]
        while above and self.exists(above) and not self.names(above):
            self.remove(above)
            above = above.rpartition("/")[0]

    def move(self, name: str, to: str) -> None:
        self.fs.mkdirs(self.path(to).getParent())
        if not self.fs.rename(self.path(name), self.path(to)) and self.exists(name):
            raise OSError(f"cannot move {name} to {to} below {self.root}")

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.fs.create(self.path(draft), True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        self.remove(name)
        self.move(draft, name)

    def partition(self, keys: list[str], values: dict) -> str:
        """Folder of the partitions with these values; ``values`` names the first keys."""
        if list(values) != keys[: len(values)] or not values:
            raise ValueError(f"owned partitions are named by the first of the keys {keys}, not by {list(values)}")
        named = self.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join(named(k, None if v is None else str(v)) for k, v in values.items())

    def leaves(self, name: str, depth: int) -> Iterator[str]:
        """Partition folders ``depth`` levels below ``name``, relative to it."""
        for child in self.names(name):
            if "=" in child and not child.startswith("."):
                yield from [child] if depth == 1 else (f"{child}/{x}" for x in self.leaves(f"{name}/{child}" if name else child, depth - 1))


def commit(df: DataFrame, path: str, keys: list[str], owned: list[dict] | None = None) -> None:
    """Replace the partitions named by ``owned`` (values of the first keys) with the rows of ``df``.

    Without ``owned`` a run owns what it writes. Rows outside of the owned partitions are an error, found before anything
    is replaced. Two runs at a time must own different partitions.
    """
    spark = df.sparkSession
    files = _Files(spark, path)
    recover(spark, path)
    claims = None if owned is None else [files.partition(keys, o) for o in owned]
    run = uuid.uuid4().hex
    df.write.partitionBy(*keys).parquet(f"{files.root}/{_PENDING}/{run}")
    written = list(files.leaves(f"{_PENDING}/{run}", len(keys)))
    stray = [] if claims is None else [w for w in written if not any(w == c or w.startswith(c + "/") for c in claims)]
    if stray:
        files.remove(f"{_PENDING}/{run}")
        raise ValueError(f"rows outside of the owned partitions of {path}: {stray[:5]}")
    known = StructType.fromJson(json.loads(files.read(_SCHEMA))) if files.exists(_SCHEMA) else StructType()
    fresh = [f for f in df.schema if f.name not in known.names]
    if fresh:
        files.publish(_SCHEMA, StructType([*known, *fresh]).json())
    manifest = {"run": run, "owned": written if claims is None else claims, "written": written, "depth": len(keys)}
    files.publish(f"{_MANIFESTS}/{run}.json", json.dumps(manifest))
    _switch(files, manifest)


def _switch(files: _Files, manifest: dict) -> None:
    """Put a published run in place. Every step can be repeated, also by another session at the same time."""
    pending, written = f"{_PENDING}/{manifest['run']}", set(manifest["written"])
    for claim in manifest["owned"]:
        below = manifest["depth"] - 1 - claim.count("/")
        for live in [f"{claim}/{x}" for x in files.leaves(claim, below)] if below else [claim]:
            if live not in written:
                files.clear(live)
    for w in sorted(written):
        if files.exists(f"{pending}/{w}"):
            files.remove(w)
            files.move(f"{pending}/{w}", w)
    files.remove(pending)
    files.remove(f"{_MANIFESTS}/{manifest['run']}.json")


def recover(spark: SparkSession, path: str) -> int:
    """Finish runs that were published but not fully switched; their number. Unpublished files are left alone."""
    files = _Files(spark, path)
    published = [n for n in files.names(_MANIFESTS) if n.endswith(".json")]
    for name in published:
        _switch(files, json.loads(files.read(f"{_MANIFESTS}/{name}")))
    return len(published)


def forget_failed_runs(spark: SparkSession, path: str) -> int:
    """Delete files of runs that never committed; to be called while nothing writes to the table."""
    recover(spark, path)
    files = _Files(spark, path)
    runs = files.names(_PENDING)
    for run in runs:
        files.remove(f"{_PENDING}/{run}")
    return len(runs)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as last committed; columns are matched by name, and one without partitions has its columns and no rows."""
    recover(spark, path)
    files = _Files(spark, path)
    if files.exists(_SCHEMA) and not any("=" in n and not n.startswith(".") for n in files.names("")):
        return spark.createDataFrame([], StructType.fromJson(json.loads(files.read(_SCHEMA))))
    return spark.read.option("mergeSchema", True).parquet(path)
