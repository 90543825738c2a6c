"""The two pipelines end to end: raw files to stored gold tables, with a gate between layers.

Layers are Parquet folders below one root: ``bronze/``, ``silver/``, ``quarantine/``, ``gold/``, ``quality/``.
A layer is written once and read by the next, so a run can resume at any layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import quality
from lamella.operators.validate import SplitOnce
from lamella.operators.parties import PartyRegistry, master
from lamella.plans import commerce, filings, records
from lamella.plans import public_records as pr
from lamella.plans.court_names import court_aliases
from lamella.plans.courts import ALL_COURTS
from lamella.plans.gates import suites
from lamella.functions import text
from lamella.operators.skew import left_join_filled
from lamella.sources import bronze, sinks
from lamella.sources.readers import read_layer
from lamella.specs import SourceSpec


class Layers:
    """Reads and writes the tables of one root folder and remembers what was written."""

    def __init__(self, spark: SparkSession, root: str, day: str, reference_date: str, block: bool = True):
        self.spark, self.root, self.day, self.block = spark, root.rstrip("/"), day, block
        self.suites = suites(reference_date)
        self.written: list[tuple[str, str, int]] = []

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return read_layer(self.spark, self.path(layer, table))

    def write(self, layer: str, table: str, df: DataFrame, partition_by: list[str] = ()) -> DataFrame:
        rows = sinks.write_table(df, self.path(layer, table), partition_by)
        self.written.append((layer, table, rows))
        return self.spark.read.schema(df.schema).parquet(self.path(layer, table))

    def quarantine(self, table: str, rejected: DataFrame) -> None:
        """Rejected rows keep their raw columns; the day's partition is replaced on a second run."""
        dated = rejected.withColumn("_quarantine_date", F.lit(self.day).cast("date"))
        rows = sinks.write_partition(
            dated, self.path("quarantine", table), ["_quarantine_date"], owned=[{"_quarantine_date": self.day}])
        self.written.append(("quarantine", table, rows))

    def gate(self, layer: str, table: str, df: DataFrame) -> None:
        """Run the suite of the table, keep the results, and stop on a blocking failure."""
        checks = self.suites.get((layer, table))
        if not checks:
            return
        keyed = quality.run_suite(df, checks, layer, table).withColumn("_run_date", F.lit(self.day).cast("date"))
        path = self.path("quality", f"{layer}_{table}")
        sinks.write_partition(keyed, path, ["_run_date"], owned=[{"_run_date": self.day}])
        if self.block:
            stored = read_layer(self.spark, path).where(F.col("_run_date") == F.lit(self.day).cast("date"))
            quality.enforce(stored)

    def summary(self) -> DataFrame:
        return self.spark.createDataFrame(self.written, "layer string, table_name string, rows long")


def _stop_on_failure(status: DataFrame) -> None:
    failed = status.where("status <> 'ok'").collect()  # one row per configured source
    if failed:
        raise RuntimeError("sources failed: " + "; ".join(f"{f['source']}: {f['error']}" for f in failed))


def run_commerce(
    spark: SparkSession, specs: list[SourceSpec], root: str, day: str, reference_date: str, block: bool = True
) -> DataFrame:
    """Sources named customers, orders, order_items and products to the gold tables. Returns rows per table."""
    layers = Layers(spark, root, day, reference_date, block)
    _stop_on_failure(bronze.ingest_all(spark, specs, day, f"{layers.root}/bronze"))
    builders = {
        "customers": commerce.silver_customers,
        "orders": commerce.silver_orders,
        "order_items": commerce.silver_order_items,
        "products": commerce.silver_products,
    }
    silver = {}
    for table, build in builders.items():
        split = SplitOnce(table)
        valid, rejected = build(layers.read("bronze", table), split=split)
        layers.gate("bronze", table, split.rows)
        silver[table] = layers.write("silver", table, valid)
        layers.quarantine(table, rejected)
        layers.gate("silver", table, silver[table])
    customers, orders, items, products = (silver[t] for t in builders)
    gold = {
        "customer_360": (commerce.customer_360(customers, orders, reference_date), ["ltv_tier"]),
        "daily_revenue": (commerce.daily_revenue(orders), []),
        "product_performance": (commerce.product_performance(products, items, orders), []),
        "fact_orders": (commerce.fact_orders(orders, items), ["order_date"]),
        "dim_date": (commerce.calendar_of(spark, orders), []),
    }
    for table, (df, partition_by) in gold.items():
        layers.gate("gold", table, layers.write("gold", table, df, partition_by))
    return layers.summary()


def run_records(
    spark: SparkSession, specs: list[SourceSpec], root: str, day: str, reference_date: str, block: bool = True
) -> DataFrame:
    """One source per court, named by its state (the federal courts: FED) and stored in table ``suits``, to the gold tables.

    A court whose source fails stops the run instead of silently going missing.
    """
    unknown = {s.name for s in specs} - {c.state for c in ALL_COURTS}
    if unknown:
        raise ValueError(f"no court mapping for {sorted(unknown)}")
    layers = Layers(spark, root, day, reference_date, block)
    _stop_on_failure(bronze.ingest_all(spark, specs, day, f"{layers.root}/bronze"))
    present = {s.name for s in specs}
    feeds = {
        c.state: read_layer(spark, f"{layers.root}/bronze/suits/_source={c.state}") for c in ALL_COURTS if c.state in present
    }
    canonical = records.canonical_suits(spark, feeds, ["_batch_id", "_ingestion_timestamp"])
    split = SplitOnce("suits")
    valid, rejected = records.silver_suits(canonical, "_ingestion_timestamp", split)
    layers.gate("bronze", "suits", split.rows)
    suits = layers.write("silver", "suits", valid, ["state_code"])
    layers.quarantine("suits", rejected)
    layers.gate("silver", "suits", suits)
    parties = layers.write("silver", "parties", records.extract_parties(suits, ["filing_date"]), ["party_type"])
    best = layers.write("gold", "suit_best_view", records.suit_best_view(suits, parties, reference_date), ["state_code"])
    layers.gate("gold", "suit_best_view", best)
    layers.write("gold", "suit_party_best_view", records.party_best_view(parties, suits), ["party_type"])
    layers.write("gold", "suit_state_summary", records.full_state_summary(best), ["state_code"])
    layers.write("gold", "suit_monthly_trends", records.monthly_trends(best), ["state_code"])
    return layers.summary()


def _filings(layers: Layers, table: str, prefix: str, specs: list[SourceSpec], build) -> DataFrame:
    """Bronze tables named ``prefix``_KIND to valid rows; the others go to the quarantine."""
    tables = sorted({s.table for s in specs if s.table.startswith(f"{prefix}_")})
    feeds = {t.removeprefix(f"{prefix}_").upper(): layers.read("bronze", t) for t in tables}
    split = SplitOnce(table)
    valid, rejected = build(feeds, "_ingestion_timestamp", ["_batch_id", "_ingestion_timestamp"], split)
    layers.quarantine(table, rejected)
    return valid


def _losing_party(judgments: DataFrame, parties: DataFrame) -> DataFrame:
    """Judgments with ``debtor_name``, the first named party on the side that lost; no winner named: the defendant."""
    lost = F.when(F.col("prevailing_party") == "DEFENDANT", "PLAINTIFF").otherwise("DEFENDANT")
    first = parties.where("sequence = 1").select("suit_id", F.col("party_type").alias("_side"), F.col("party_name").alias("debtor_name"))
    return left_join_filled(judgments.withColumn("_side", lost), first, ["suit_id", "_side"]).drop("_side")


def run_public_records(
    spark: SparkSession, suits: list[SourceSpec], others: list[SourceSpec], root: str, day: str, reference_date: str,
    block: bool = True,
) -> DataFrame:
    """Suits, liens and judgments from raw feeds to all gold tables. Returns rows per table.

    ``suits`` as for ``run_records``. ``others`` are stored in tables ``lien_KIND`` and ``judgment_KIND`` (kinds as in
    ``filings``) and name their state, and county where the feed has none, in ``lineage``. Every record gets the
    key of its parties from a registry that lives below ``root`` and keeps ids from run to run; the debtor of a judgment is
    the party that lost its suit. Judgments that meet no suit are listed in ``review/judgments``.
    """
    done = run_records(spark, suits, root, day, reference_date, block)
    layers = Layers(spark, root, day, reference_date, block)
    _stop_on_failure(bronze.ingest_all(spark, others, day, f"{layers.root}/bronze"))
    silver = layers.read("silver", "suits")
    aliases = court_aliases(spark)

    named = records.extract_parties(silver, ["filing_date", "state_code"])
    liens = layers.write("silver", "liens_named", _filings(layers, "liens", "lien", others, filings.canonical_liens), ["lien_type"])
    decided = _filings(layers, "judgments", "judgment", others, filings.canonical_judgments).withColumn(
        "judgment_key", text.hash_key(F.col("judgment_id"), F.col("county")))
    decided = layers.write("silver", "judgments_decided", decided)
    layers.write("review", "judgments", pr.unlinked_judgments(silver, decided, aliases))
    losing = layers.write("silver", "judgments_named", _losing_party(pr.link_suit_judgment(silver, decided, aliases), named))

    def mentions(df: DataFrame, name: str, role) -> DataFrame:
        return df.where(F.col(name).isNotNull()).select(F.col(name).alias("name"), F.col("state_code").alias("state"), role.alias("role"))

    stated = [mentions(named, "party_name", F.col("party_type")), mentions(liens, "debtor_name", F.lit("DEBTOR")),
              mentions(liens, "creditor_name", F.lit("CREDITOR"))]
    mentioned = stated[0].unionByName(stated[1]).unionByName(stated[2])
    registry = PartyRegistry(spark, f"{layers.root}/parties")
    # a rerun of a day adds the names that are new in it; counts come from the records, so nothing counts twice
    registry.add(mentioned.unionByName(mentions(losing, "debtor_name", F.lit("DEBTOR"))), f"{day} {len(registry.batches())}")
    counted = registry.resolve(mentioned, "name", "state").where("party_id is not null")
    master_table = master(counted.groupBy("party_id", F.trim("name").alias("spelling"), "state", "role").agg(F.count(F.lit(1)).alias("n")))
    layers.write("silver", "party_master", master_table)
    layers.gate("silver", "party_master", layers.read("silver", "party_master"))

    keyed = registry.resolve(liens, "debtor_name", "state_code", "debtor_key")
    keyed = registry.resolve(keyed, "creditor_name", "state_code", "creditor_key")
    rules = pr.lien_rules(spark)
    expiring = pr.with_expired(pr.lien_expiration(keyed, rules, reference_date))
    stored_liens = layers.write("silver", "liens", expiring, ["lien_type"])
    layers.gate("silver", "liens", stored_liens)
    judgments = layers.write("silver", "judgments", registry.resolve(losing, "debtor_name", "state_code", "debtor_key"))
    layers.gate("silver", "judgments", judgments)
    suit_parties = layers.write("silver", "suit_parties", registry.resolve(named, "party_name", "state_code", "party_key").drop("party_id"))

    asked = judgments.drop("suit_id")
    linked = layers.write("silver", "lien_links", pr.link_judgment_lien(
        asked, stored_liens.drop("expiration_date", "is_active"), aliases))
    best = layers.read("gold", "suit_best_view")
    gold = {
        "suit_best_view_full": pr.suit_best_view_full(best, asked, linked, aliases),
        "lien_best_view": pr.lien_best_view(linked, rules, asked, silver, reference_date, aliases),
        "judgment_best_view": pr.judgment_best_view(asked, silver, linked, aliases),
        "suit_judgment_lien_xref": pr.xref_chain(silver, asked, linked, aliases),
    }
    known = suit_parties.where("party_key is not null")
    profile = pr.party_risk(pr.party_profile(
        known, judgments.where("debtor_key is not null"), stored_liens.where("debtor_key is not null or creditor_key is not null")))
    gold["party_profile"] = profile.where("party_key is not null")
    for table, df in gold.items():
        layers.gate("gold", table, layers.write("gold", table, df))
    stacked = pr.all_records(best, judgments, stored_liens)
    views = {
        "record_summary": pr.record_summary(stacked), "record_trend": pr.record_trend(stacked),
        "active_liens": pr.active_liens_by_state(stored_liens), "risk_dashboard": pr.risk_dashboard(best, judgments, stored_liens),
        "due_diligence": pr.due_diligence(known, judgments, stored_liens).where("party_key is not null"),
        "frequent_parties": pr.frequent_parties(layers.read("gold", "party_profile")),
    }
    for table, df in views.items():
        layers.write("gold", table, df)
    return done.unionByName(layers.summary())
