"""Partition commits: what a run owns is replaced whole, cleared when empty, and kept when the run fails."""

import os

import pytest
from pyspark.sql import functions as F

from lamella.operators import validate
from lamella.plans import pipelines
from lamella.sources import commits, readers, sinks
from test_layers import commerce_files, court_files


def ids(spark, path):
    return sorted(r.id for r in commits.read(spark, path).collect())


def test_empty_rerun_leaves_no_rows(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(10).withColumn("day", F.lit("2024-01-01").cast("date"))
    assert sinks.write_partition(rows, path, ["day"], owned=[{"day": "2024-01-01"}]) == 10
    other = rows.withColumn("day", F.lit("2024-01-02").cast("date")).withColumn("more", F.lit("x"))
    sinks.write_partition(other, path, ["day"], owned=[{"day": "2024-01-02"}])
    assert commits.read(spark, path).count() == 20
    assert sinks.write_partition(rows.limit(0), path, ["day"], owned=[{"day": "2024-01-01"}]) == 0
    assert commits.read(spark, path).select("day").distinct().count() == 1
    sinks.write_partition(rows.limit(0), path, ["day"], owned=[{"day": "2024-01-02"}])
    left = commits.read(spark, path)
    assert left.count() == 0 and set(left.columns) == {"id", "day", "more"}


def test_failed_run_leaves_the_old_rows(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(10).withColumn("day", F.col("id") % 2)
    sinks.write_partition(rows, path, ["day"])
    bad = rows.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id") + 100).cast("long"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_partition(bad, path, ["day"])
    assert ids(spark, path) == list(range(10)) == sorted(r.id for r in spark.read.parquet(path).collect())
    with pytest.raises(ValueError, match="outside"):
        sinks.write_partition(rows, path, ["day"], owned=[{"day": 1}])
    assert ids(spark, path) == list(range(10))
    rows.write.parquet(f"{path}/_pending/driver-lost")
    assert ids(spark, path) == list(range(10))
    assert commits.forget_failed_runs(spark, path) == 1 and commits.forget_failed_runs(spark, path) == 0


@pytest.mark.parametrize("steps", range(4))
def test_a_switch_that_is_cut_short_is_finished(spark, tmp_path, monkeypatch, steps):
    """The run dies after any number of moves; the next reader sees all of it."""
    path = str(tmp_path / "t")
    sinks.write_partition(spark.range(6).withColumn("day", F.col("id") % 3), path, ["day"])
    new = spark.range(100, 104).withColumn("day", F.col("id") % 2)
    moved, move = [], commits._Files.move

    def dies(self, name, to):
        if name.startswith("_pending"):
            if len(moved) == steps:
                raise KeyboardInterrupt
            moved.append(to)
        move(self, name, to)

    monkeypatch.setattr(commits._Files, "move", dies)
    try:
        sinks.write_partition(new, path, ["day"], owned=[{"day": d} for d in range(3)])
        assert steps >= 2
    except KeyboardInterrupt:
        assert steps < 2
    monkeypatch.undo()
    assert ids(spark, path) == [100, 101, 102, 103]
    assert commits.recover(spark, path) == 0 and not os.listdir(f"{path}/_pending")


def test_owned_by_first_key_and_odd_values(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a/b=c", "x"), (2, "a/b=c", "y"), (3, None, "x"), (4, "z", "x")], "id long, k string, day string")
    sinks.write_partition(rows, path, ["k", "day"])
    sinks.write_partition(rows.where("id = 2"), path, ["k", "day"], owned=[{"k": "a/b=c"}])
    assert ids(spark, path) == [2, 3, 4]
    sinks.write_partition(rows.limit(0), path, ["k", "day"], owned=[{"k": None}])
    assert ids(spark, path) == [2, 4]
    with pytest.raises(ValueError, match="first of the keys"):
        sinks.write_partition(rows, path, ["k", "day"], owned=[{"day": "x"}])


def test_clean_rerun_clears_rejects(spark, tmp_path):
    specs, root = commerce_files(tmp_path / "in"), str(tmp_path / "out")
    pipelines.run_commerce(spark, specs, root, "2025-01-15", "2025-01-15")
    assert readers.read_layer(spark, f"{root}/quarantine/customers").count() == 1
    source = tmp_path / "in" / "customers.csv"
    source.write_text("\n".join(line for line in source.read_text().splitlines() if "invalid" not in line) + "\n")
    rows = {(r.layer, r.table_name): r.rows for r in pipelines.run_commerce(spark, specs, root, "2025-01-15", "2025-01-15").collect()}
    assert rows["quarantine", "customers"] == 0 and readers.read_layer(spark, f"{root}/quarantine/customers").count() == 0
    assert rows["silver", "customers"] == 100


def test_split_reads_its_input_once(spark, tmp_path, monkeypatch):
    """Neither pipeline reads a bronze table twice, and a half opens its own files only."""
    seen, split = [], validate.SplitOnce.__call__

    def counted(self, df, rules):
        out = split(self, df, rules)
        seen.append([len(x._jdf.queryExecution().optimizedPlan().collectLeaves().toList().mkString(" ").split("bronze")) - 1 for x in (*out, self.rows)])
        return out

    monkeypatch.setattr(validate.SplitOnce, "__call__", counted)
    pipelines.run_records(spark, court_files(tmp_path / "in"), str(tmp_path / "out"), "2025-01-15", "2025-01-15")
    assert seen == [[0, 0, 0]]
    once = validate.SplitOnce("t")
    valid, rejected = once(spark.range(100).withColumn("v", F.col("id") % 10), [validate.Rule("TOO_LOW", F.col("v") > 0)])
    assert (valid.count(), rejected.count(), once.rows.count()) == (90, 10, 100)
    assert valid.columns == ["id", "v"] and rejected.first()["_reasons"] == ["TOO_LOW"]
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(rejected.inputFiles()) == len(valid.inputFiles())
