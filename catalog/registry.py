"""Where queries and their comparison SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.bindings import with_bindings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, money: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows are checked.

    ``money`` names decimal result columns. They are compared as doubles, because clients show decimals of the
    two engines differently (``1.50`` and ``1.5``).
    """

    def add(fn: Query) -> Query:
        assert name not in QUERIES, name

        def as_double(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in money})

        QUERIES[name] = as_double if money else fn
        if oracle is not None:
            if money:
                casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
                oracle_sql = f"SELECT * REPLACE ({casts}) FROM ({oracle})"
            else:
                oracle_sql = oracle
            ORACLES[name] = with_bindings(oracle_sql)
        return fn

    return add


def half_up(num: str, den: str, places: int) -> str:
    """SQL for ``num / den`` of whole numbers, rounded half away from zero to ``places``."""
    n, d, p = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**places
    return (
        f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ((2 * abs({n}) * {p} + {d}) // nullif(2 * {d}, 0)))::DOUBLE / {p}"
    )
