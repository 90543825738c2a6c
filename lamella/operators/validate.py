"""Rules, and the split of a table into valid rows and rejected rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.staging import new_folder

REASONS = "_reasons"
IS_VALID = "_is_valid"


@dataclass(frozen=True)
class Rule:
    """``ok`` must hold; a row where it is false or null is rejected with ``reason``."""

    reason: str
    ok: Column


#: How a table is split by rules into (valid, quarantine).
Split = Callable[[DataFrame, list[Rule]], tuple[DataFrame, DataFrame]]


def holds_all(rules: list[Rule]) -> Column:
    condition = F.lit(True)
    for rule in rules:
        condition = condition & F.coalesce(rule.ok, F.lit(False))
    return condition


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the array of broken rules; one pass whatever the number of rules."""
    none = F.array().cast("array<string>")
    broken = [F.when(~F.coalesce(r.ok, F.lit(False)), F.array(F.lit(r.reason))).otherwise(none) for r in rules]
    return df.withColumn(REASONS, F.concat(*broken))


def valid_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """A plain filter: it stays in generated code and can be pushed towards the scan."""
    return df.where(holds_all(rules))


def rejected_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rejected rows with their reasons, which are worked out for these rows only."""
    return tag(df.where(~holds_all(rules)), rules)


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): complementary, and the quarantine keeps every raw column plus the reasons."""
    return valid_rows(df, rules), rejected_rows(df, rules)


class SplitOnce:
    """A split that reads its input once: rows are written with their reasons, valid ones and others in two partitions.

    Both halves, and ``rows`` (all of them as they came, for checks of the input), are then reads of the written copy; a
    half opens the files of its partition only. Called like ``split_valid``.
    """

    def __init__(self, name: str):
        self.name = name
        self.rows: DataFrame | None = None

    def __call__(self, df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
        spark, path = df.sparkSession, new_folder(df.sparkSession, self.name)
        tagged = tag(df, rules).withColumn(IS_VALID, F.size(REASONS) == 0)
        tagged.write.partitionBy(IS_VALID).parquet(path)
        stored = spark.read.schema(tagged.schema).parquet(path)
        self.rows = stored.select(*df.columns)
        return stored.where(F.col(IS_VALID)).select(*df.columns), stored.where(~F.col(IS_VALID)).drop(IS_VALID)
