"""Data quality: checks as data, a whole suite in one pass over the table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lamella.functions import numbers

BLOCK, WARN = "BLOCK", "WARN"


@dataclass(frozen=True)
class Check:
    """One check. ``kind`` picks the measure; the other fields parametrize it.

    kind           column  passes when
    not_null       yes     not null; with ``empty_is_null`` also not '' (only tested on text columns)
    unique         yes     distinct values count, null as one value if ``null_counts``
    accepted       yes     value in ``accepted``; null fails
    range          yes     number within the bounds; unreadable and null fail as soon as a bound is set
    holds          no      ``condition`` is true
    """

    kind: str
    column: str = ""
    threshold: float = 95.0
    warn_from: float = 80.0
    severity: str = BLOCK
    empty_is_null: bool = False
    null_counts: bool = False
    accepted: tuple = ()
    low: float | None = None
    high: float | None = None
    condition: Column | None = field(default=None, compare=False)
    label: str = ""

    @property
    def name(self) -> str:
        prefix = {"accepted": "accepted_values"}.get(self.kind, self.kind)
        return self.label or f"{prefix}_{self.column}"


def not_null(column: str, threshold: float = 95.0, **more) -> Check:
    return Check("not_null", column, threshold, **more)


def unique(column: str, threshold: float = 100.0, **more) -> Check:
    return Check("unique", column, threshold, **more)


def accepted_values(column: str, accepted: list, threshold: float = 95.0, **more) -> Check:
    return Check("accepted", column, threshold, accepted=tuple(accepted), **more)


def in_range(column: str, low: float | None = None, high: float | None = None, threshold: float = 95.0, **more):
    return Check("range", column, threshold, low=low, high=high, **more)


def holds(label: str, condition: Column, threshold: float = 95.0, **more) -> Check:
    return Check("holds", "", threshold, label=label, condition=condition, **more)


def _number(c: float) -> str:
    return "None" if c is None else str(c)


def _passed(df: DataFrame, check: Check) -> Column:
    """Aggregate that counts passing rows."""
    if check.kind == "holds":
        return F.count_if(F.coalesce(check.condition, F.lit(False)))
    c = F.col(check.column)
    if check.kind == "not_null":
        ok = c.isNotNull()
        if check.empty_is_null and isinstance(df.schema[check.column].dataType, StringType):
            ok = ok & (c != "")
        return F.count_if(ok)
    if check.kind == "unique":
        distinct = F.count_distinct(c)
        return distinct + F.max(c.isNull().cast("int")) if check.null_counts else distinct
    if check.kind == "accepted":
        return F.count_if(F.coalesce(c.isin(list(check.accepted)), F.lit(False)))
    if check.kind == "range":
        value, ok = c.try_cast("double"), F.lit(True)
        if check.low is not None:
            ok = ok & (value >= check.low)
        if check.high is not None:
            ok = ok & (value <= check.high)
        return F.count_if(F.coalesce(ok, F.lit(False)))
    raise ValueError(f"unknown check kind {check.kind}")


def _details(check: Check, failed: Column) -> Column:
    if check.kind == "unique":
        return F.concat(F.lit("Duplicates found: "), failed.cast("string"))
    if check.kind == "range":
        return F.lit(f"Range: [{_number(check.low)}, {_number(check.high)}]")
    if check.kind == "accepted":
        return F.lit(f"Accepted: {', '.join(str(v) for v in check.accepted)}")
    if check.kind == "holds":
        return F.lit(f"Condition: {check.label}")
    return F.lit(f"Column: {check.column}")


def status_of(rate: Column, threshold: Column, warn_from: Column) -> Column:
    return F.when(rate >= threshold, "PASS").when(rate >= warn_from, "WARN").otherwise("FAIL")


def run_suite(df: DataFrame, checks: list[Check], layer: str, table: str, checked_at: Column | None = None) -> DataFrame:
    """One row per check. All checks are one aggregate over ``df``, unpivoted afterwards.

    A check that cannot be computed (no such column) becomes a FAIL row instead of an error, so a broken
    suite can never look like a passed one.
    """
    usable = [c.kind == "holds" or c.column in df.columns for c in checks]
    measures = [F.count(F.lit(1)).alias("_total")]
    measures += [_passed(df, c).alias(f"_p{i}") for i, c in enumerate(checks) if usable[i]]
    total = F.col("_total")
    records = []
    for i, check in enumerate(checks):
        passed = F.coalesce(F.col(f"_p{i}"), F.lit(0)) if usable[i] else F.lit(0)
        failed = total - passed
        rate = F.when(total > 0, passed / total * 100).otherwise(F.lit(100.0))
        details, status = _details(check, failed), status_of(
            rate, F.lit(float(check.threshold)), F.lit(float(check.warn_from)))
        if not usable[i]:
            rate, status, details = F.lit(0.0), F.lit("FAIL"), F.lit(f"Check error: no column {check.column}")
        records.append(F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            total.alias("records_checked"),
            passed.cast("long").alias("records_passed"),
            failed.cast("long").alias("records_failed"),
            rate.alias("pass_rate"),
            F.lit(float(check.threshold)).alias("threshold"),
            status.alias("status"),
            F.lit(check.severity).alias("severity"),
            details.alias("details"),
        ))
    rows = df.agg(*measures).select(F.explode(F.array(*records)).alias("r"))
    result = rows.select("r.*")
    return result.withColumn("checked_at", checked_at if checked_at is not None else F.current_timestamp())


def bad_value_sample(df: DataFrame, checks: list[Check], size: int = 5) -> DataFrame:
    """Smallest ``size`` distinct values outside each accepted list, for all such checks in one pass.

    Values are made distinct and cut to ``size`` per check before anything is collected into a list.
    """
    listed = [c for c in checks if c.kind == "accepted" and c.column in df.columns]
    pairs = F.array(*[
        F.when(
            ~F.coalesce(F.col(c.column).isin(list(c.accepted)), F.lit(False)),
            F.struct(F.lit(c.name).alias("check_name"), F.col(c.column).cast("string").alias("value")),
        )
        for c in listed
    ])
    bad = df.select(F.explode(F.array_compact(pairs)).alias("b")).select("b.*").where("value is not null").distinct()
    w = Window.partitionBy("check_name").orderBy("value")
    few = bad.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= size)
    return few.groupBy("check_name").agg(F.sort_array(F.collect_list("value")).alias("invalid_values"))


class GateFailed(Exception):
    """A blocking check failed; the next layer must not be built."""


def enforce(results: DataFrame) -> DataFrame:
    """Raise if a blocking check failed, else hand the results on. Results have one row per check."""
    failed = results.where("status = 'FAIL' and severity = 'BLOCK'").select("check_name", "details").collect()
    if failed:
        raise GateFailed("; ".join(f"{r['check_name']} ({r['details']})" for r in failed))
    return results


def report(results: DataFrame) -> DataFrame:
    """Checks per layer, table and status, with the names of the checks that did not pass."""
    not_passed = F.when(F.col("status") != "PASS", F.col("check_name"))
    return results.groupBy("layer", "table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.array_join(F.sort_array(F.collect_list(not_passed)), ", ").alias("not_passed"),
    )


def reconcile(bronze: DataFrame, valid: DataFrame, rejected: DataFrame, gold: DataFrame, by: str, tolerance: float):
    """Counts per ``by`` through the layers: bronze = valid + duplicates + rejected, gold = valid.

    The four tables are counted separately and only their counts are joined.
    """
    layers = {"bronze": bronze, "silver": valid, "rejected": rejected, "gold": gold}
    counts = None
    for name, df in layers.items():
        one = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).select(by, F.lit(name).alias("layer"), "n")
        counts = one if counts is None else counts.unionByName(one)
    wide = counts.groupBy(by).agg(*[
        F.coalesce(F.sum(F.when(F.col("layer") == n, F.col("n"))), F.lit(0)).alias(n) for n in layers
    ])
    duplicates = F.col("bronze") - F.col("silver") - F.col("rejected")
    variance = numbers.percent(F.abs(F.col("gold") - F.col("silver")), F.col("silver"))
    ok = (duplicates >= 0) & (F.col("silver") <= F.col("bronze"))
    return wide.select(
        "*",
        duplicates.alias("duplicates"),
        variance.alias("variance_pct"),
        F.when(~ok, "FAIL").when(variance > tolerance, "WARN").otherwise("PASS").alias("status"),
    )


def quarantine_report(rejected: DataFrame, day: str, by: list[str], reasons: str = "_reasons") -> DataFrame:
    """Rejected rows per week and reason."""
    week = F.date_trunc("week", F.col(day)).cast("date")
    return (
        rejected.select(week.alias("week"), *by, F.explode(reasons).alias("reason"))
        .groupBy("week", *by, "reason").agg(F.count(F.lit(1)).alias("rows"))
    )


def volume_spikes(rows: DataFrame, day: str, factor: float = 2.0, days: int = 7) -> DataFrame:
    """Days whose volume exceeds ``factor`` times the mean of the previous ``days`` days that had rows.

    The window runs over one row per calendar day. The first days, without a full baseline, give null.
    """
    w = Window.orderBy(day).rowsBetween(-days, -1)
    volume = rows.groupBy(day).agg(F.count(F.lit(1)).alias("volume"))
    full = F.count(F.lit(1)).over(w) == days
    return volume.withColumn("baseline", F.when(full, numbers.ratio(F.sum("volume").over(w), F.lit(days), 2))).withColumn(
        "is_spike", F.when(F.col("baseline").isNotNull(), F.col("volume") > F.col("baseline") * factor)
    )


def missing_partitions(rows: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Expected days without a single row. ``calendar`` has one row per expected day."""
    return calendar.select(F.col("date").alias(day)).join(rows.select(day).distinct(), day, "left_anti")


def freshness(bronze: DataFrame, bronze_ts: str, gold: DataFrame, gold_ts: str, sla_hours: int, alert_hours: int):
    """Minutes from the newest bronze row to the newest gold row, against the service level.

    Positive: gold was refreshed that much later. Negative: gold misses the newest bronze rows.
    """
    none = F.lit(None).cast("timestamp")
    stamps = bronze.select(F.col(bronze_ts).cast("timestamp").alias("b"), none.alias("g")).unionByName(
        gold.select(none.alias("b"), F.col(gold_ts).cast("timestamp").alias("g"))
    )
    newest = stamps.agg(F.max("b").alias("bronze_newest"), F.max("g").alias("gold_newest"))
    seconds = F.unix_seconds("gold_newest") - F.unix_seconds("bronze_newest")
    late = F.abs(seconds)
    return newest.select(
        "bronze_newest", "gold_newest", F.floor(seconds / 60).cast("long").alias("lag_minutes"),
        F.when(late <= sla_hours * 3600, "PASS").when(late <= alert_hours * 3600, "WARN").otherwise("FAIL").alias("status"),
    )


def rollup_matches(summary: DataFrame, count_column: str, detail: DataFrame) -> DataFrame:
    """Does the sum of a summary equal the number of detail rows?"""
    rows = summary.select(F.col(count_column).cast("long").alias("s"), F.lit(0).alias("d")).unionByName(
        detail.select(F.lit(0).cast("long").alias("s"), F.lit(1).alias("d"))
    )
    both = rows.agg(F.sum("s").alias("summary_rows"), F.sum("d").alias("detail_rows"))
    return both.select("summary_rows", "detail_rows", (F.col("summary_rows") == F.col("detail_rows")).alias("matches"))


def with_threshold(checks: list[Check], threshold: float) -> list[Check]:
    return [replace(c, threshold=threshold) for c in checks]
