"""Files that a filter has to open, by the minima and maxima in their footers."""

import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lamella.sources import sinks

SCHEMA = "id long, state string, kind string, amount double"


def _rows(n=4000):
    rnd = random.Random(5)
    states = ["CA"] * 6 + ["AZ", "FL", "GA", "IL", "NY", "TX"]  # half of all rows in one state
    return [(i, rnd.choice(states), f"kind {rnd.randint(0, 11):02d}", rnd.random() * 1000) for i in range(n)]


def _opened(path, column, low, high):
    """(files whose range meets the filter, files)."""
    metas = [pq.ParquetFile(f).metadata for f in sorted(Path(path).rglob("*.parquet"))]
    at = metas[0].schema.names.index(column)
    hit = 0
    for m in metas:
        stats = [m.row_group(g).column(at).statistics for g in range(m.num_row_groups)]
        hit += any(s.min <= high and s.max >= low for s in stats)
    return hit, len(metas)


def test_each_column_alone_skips_files(spark, tmp_path):
    df = spark.createDataFrame(_rows(), SCHEMA)
    assert sinks.write_interleaved(df, str(tmp_path / "z"), ["state", "kind", "amount"], "id", files=64) == 4000
    order = ["state", "kind", "amount", "id"]
    df.repartitionByRange(64, *order).sortWithinPartitions(*order).write.parquet(str(tmp_path / "sorted"))
    filters = {"state": ("NY", "NY"), "kind": ("kind 03", "kind 03"), "amount": (100.0, 150.0)}
    z = {c: _opened(tmp_path / "z", c, *f) for c, f in filters.items()}
    plain = {c: _opened(tmp_path / "sorted", c, *f) for c, f in filters.items()}
    assert all(hit <= files * 0.5 for hit, files in z.values()), z
    assert max(hit for hit, _ in plain.values()) > 64 * 0.5, f"a sort serves its last column badly: {plain}"
    back = spark.read.parquet(str(tmp_path / "z"))
    assert sorted(map(tuple, back.collect())) == sorted(_rows())
    assert back.where("kind = 'kind 03'").count() == df.where("kind = 'kind 03'").count()


def test_nulls_empty_tables_and_one_value(spark, tmp_path):
    rows = [(1, None, "k", None), (2, "", "k", 1.0), (3, "ÅÄ", "k", -5.0), (4, "ÅÄ", "k", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name, table, n in (("odd", df, 4), ("none", df.where("id < 0"), 0)):
        path = str(tmp_path / name)
        assert sinks.write_interleaved(table, path, ["state", "kind", "amount"], "id") == n
        assert spark.read.schema(SCHEMA).parquet(path).count() == n
    key = {r.id: r.k for r in df.withColumn("k", sinks.interleaved_key(df, ["amount"])).collect()}
    assert key[3] <= key[2] == key[4] and key[1] == 0
