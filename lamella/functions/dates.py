"""Dates in many written forms, and calendar attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END_OF_TIME = "9999-12-31"


def parse_date(c: Column, fmt: str) -> Column:
    """Empty text is taken out before: a text that cannot be read costs the parser an exception a row."""
    return F.try_to_date(F.nullif(F.trim(c), F.lit("")), fmt)


def parse_date_by(c: Column, fmt: Column, formats: Iterable[str]) -> Column:
    """Parse with the format named in another column.

    Every format is a constant inside its own branch, so its parser is built once per task and not per row.
    """
    branches = [F.when(fmt == f, parse_date(c, f)) for f in sorted(set(formats))]
    return F.coalesce(*branches)


def iso_date(c: Column) -> Column:
    return F.trim(c).try_cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def to_utc(local: Column, zone: Column | str) -> Column:
    """A wall-clock time in ``zone`` to the UTC wall clock."""
    return F.to_utc_timestamp(local, zone)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def dim_date(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """Calendar between the two dates of the one-row frame ``bounds(first_day, last_day)``."""
    day = F.col("date")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    return days.select(
        day,
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_key"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.day(day).cast("long").alias("day"),
        F.weekday(day).cast("long").alias("weekday"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        month_key(day).alias("year_month"),
        F.last_day(day).alias("month_end"),
    )
