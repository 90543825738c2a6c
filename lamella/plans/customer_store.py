"""Customer 360 kept up to date from batches of changed customers and orders.

Below ``path`` every table is a log of partitions, one a batch:

* ``orders``: the latest valid image of each order, found again by bucket when a later batch changes it;
* ``days``: signed partials by customer and day. A changed order takes its old image out of the partials and puts the new
  one in, so sums need no earlier orders; first and last order dates are those of days that still have orders;
* ``profiles`` and ``bases``: the latest profile of a customer, and profile with metrics;
* ``gold``: finished rows. A batch writes the customers that it touches and those whose score moved with the cuts;
* ``cuts``: the ends of the quintiles and the reference date, a dozen rows a batch.

A batch counts once it is listed in ``batches``, which is written last; a run that is lost is repeated under the same name.
Only ``cuts`` and the names of batches pass through the driver. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import numbers
from lamella.operators import dedupe
from lamella.plans import commerce
from lamella.sources import commits
from lamella.staging import stage

#: Orders are looked up by bucket, so that a small batch opens few files.
BUCKETS = 64

_COUNTS = ["orders", "priced", "completed", "cancelled"]
_TABLES = {
    "orders": "order_id string, customer_id string, order_date date, status string, total_amount decimal(18,2), bucket int",
    "days": "customer_id string, order_date date, orders long, priced long, completed long, cancelled long, revenue decimal(28,2)",
    "profiles": "customer_id string, email string, first_name string, last_name string, city string, state string, "
                "signup_date date, is_active boolean",
    "bases": "customer_id string, email string, first_name string, last_name string, city string, state string, "
             "signup_date date, is_active boolean, total_orders long, total_revenue decimal(28,2), avg_order_value double, "
             "first_order_date date, last_order_date date, completed_orders long, cancelled_orders long, rfm_orders long, "
             "rfm_revenue decimal(28,2)",
    "cuts": "name string, value decimal(28,2), customer_id string, place int",
}
_KEYS = {"orders": ["order_id"], "days": ["customer_id", "order_date"], "profiles": ["customer_id"], "bases": ["customer_id"],
         "gold": ["customer_id"]}


def _bucket(order_id: Column) -> Column:
    return F.pmod(F.xxhash64(order_id), F.lit(BUCKETS)).cast("int")


class CustomerStore:
    """The store below ``path``. ``excluded`` and ``window_months`` are those of ``customer_order_metrics``."""

    def __init__(self, spark: SparkSession, path: str, excluded: str = "refunded", window_months: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.excluded, self.window_months = excluded, window_months

    def batches(self) -> list[tuple[str, str]]:
        """(name, reference date) of the batches that were added, in order; one short row each."""
        if not self._exists("batches"):
            return []
        rows = commits.read(self.spark, f"{self.path}/batches").orderBy("batch").collect()
        return [(r.name, r.reference_date) for r in rows]

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _log(self, table: str, done: int) -> DataFrame:
        """All rows of the first ``done`` batches; what an unfinished batch has written is not seen."""
        if not done or not self._exists(table):
            return self.spark.createDataFrame([], f"{_TABLES[table]}, batch int")
        return commits.read(self.spark, f"{self.path}/{table}").where(F.col("batch") <= done)

    def _latest(self, table: str, done: int) -> DataFrame:
        return dedupe.latest(self._log(table, done), _KEYS[table], "batch", ties=[]).drop("batch")

    def _commit(self, table: str, rows: DataFrame, batch: int, owned: list[dict] | None = None) -> None:
        keys = ["batch", "bucket"] if table == "orders" else ["batch"]
        commits.commit(rows.withColumn("batch", F.lit(batch)), f"{self.path}/{table}", keys, owned or [{"batch": batch}])

    def _signed(self, images: DataFrame, sign: int) -> DataFrame:
        """Partials of order images, added or taken out."""
        status, amount = F.col("status"), F.col("total_amount")
        one = F.lit(sign).cast("long")
        return images.where(status != self.excluded).groupBy("customer_id", "order_date").agg(
            (F.count(F.lit(1)) * one).alias("orders"), (F.count(amount) * one).alias("priced"),
            (F.count_if(status == "completed") * one).alias("completed"),
            (F.count_if(status == "cancelled") * one).alias("cancelled"),
            (F.coalesce(F.sum(amount), F.lit(0)) * sign).cast("decimal(28,2)").alias("revenue"))

    @staticmethod
    def _summed(days: DataFrame) -> DataFrame:
        """Partials with one row a customer and day, without days that have been emptied."""
        sums = [F.sum(c).alias(c) for c in _COUNTS] + [F.sum("revenue").cast("decimal(28,2)").alias("revenue")]
        return days.groupBy("customer_id", "order_date").agg(*sums)

    def _metrics(self, days: DataFrame, reference_date: str) -> DataFrame:
        """The columns of ``customer_order_metrics`` from partials."""
        recent = F.lit(True)
        if self.window_months is not None:
            end = F.lit(reference_date).cast("date")
            recent = F.col("order_date").between(F.add_months(end, -self.window_months), end)
        money = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(28,2)")
        return self._summed(days).where("orders > 0").groupBy("customer_id").agg(
            F.sum("orders").alias("total_orders"),
            money(F.col("revenue")).alias("total_revenue"),
            numbers.ratio(money(F.col("revenue")), F.sum("priced"), 2).alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("completed").alias("completed_orders"),
            F.sum("cancelled").alias("cancelled_orders"),
            F.coalesce(F.sum(F.when(recent, F.col("orders"))), F.lit(0)).alias("rfm_orders"),
            money(F.when(recent, F.col("revenue"))).alias("rfm_revenue"),
        )

    def _stored_cuts(self, done: int) -> dict[str, list[tuple]] | None:
        rows = self._log("cuts", done).where(F.col("batch") == done).orderBy("name", "place").collect()
        cuts: dict[str, list[tuple]] = {}
        for r in rows:
            cuts.setdefault(r["name"], []).append((r["value"], r["customer_id"]))
        return cuts or None

    def add(self, customers: DataFrame, orders: DataFrame, batch: str, reference_date: str) -> int:
        """Take in valid customers and orders of one batch; the number of rows of the 360 that were written.

        Both are silver tables, unique by id; a later batch replaces earlier rows of an id. An order may move to another
        customer, and orders may come before their customer. A batch that was added before is skipped. With a new
        reference date every customer is written again, else only those whose row can differ.
        """
        earlier = self.batches()
        if batch in [name for name, _ in earlier]:
            return 0
        done, now = len(earlier), len(earlier) + 1
        everyone = not earlier or earlier[-1][1] != reference_date

        images = orders.select("order_id", "customer_id", "order_date", "status", F.col("total_amount").cast("decimal(18,2)"))
        images = stage(images.withColumn("bucket", _bucket(F.col("order_id"))), "store_images")
        buckets = [r.bucket for r in images.select("bucket").distinct().collect()]  # BUCKETS at most
        known = self._log("orders", done).where(F.col("bucket").isin(buckets)).join(
            images.select("order_id"), "order_id", "left_semi")
        replaced = dedupe.latest(known, ["order_id"], "batch", ties=[])
        change = self._summed(self._signed(images, 1).unionByName(self._signed(replaced, -1)))
        change = stage(change.where(" OR ".join(f"{c} <> 0" for c in [*_COUNTS, "revenue"])), "store_change")
        self._commit("orders", images, now)
        self._commit("days", change, now)
        fresh = stage(customers.select(*commerce.PROFILE), "store_profiles")
        self._commit("profiles", fresh, now)

        profiles, days = self._latest("profiles", now), self._log("days", now)
        touched = stage(change.select("customer_id").unionByName(fresh.select("customer_id")).distinct(), "store_touched")
        if not everyone:
            profiles, days = (df.join(touched, "customer_id", "left_semi") for df in (profiles, days))
        rows = stage(commerce.profile_with_metrics(profiles, self._metrics(days, reference_date)), "store_rows")
        self._commit("bases", rows, now)

        current = commerce.with_recency(stage(self._latest("bases", now), "store_bases"), reference_date)
        cuts, before = commerce.rfm_cuts(current), self._stored_cuts(done)
        listed = [(n, v, i, place) for n, pairs in (cuts or {}).items() for place, (v, i) in enumerate(pairs)]
        self._commit("cuts", self.spark.createDataFrame(listed, _TABLES["cuts"]), now)
        if everyone or (cuts is None) != (before is None):
            due = current
        else:
            moved = F.lit(False)
            for a, b in zip(commerce.rfm_quintiles(before), commerce.rfm_quintiles(cuts), strict=True):
                moved = moved | ~a.eqNullSafe(b)
            due = current.join(touched.withColumn("_due", F.lit(True)), "customer_id", "left").where(
                F.coalesce("_due", F.lit(False)) | moved).drop("_due")
        gold = stage(commerce.as_customer_360(commerce.score_by(due, cuts), reference_date), "store_gold")
        self._commit("gold", gold, now)
        self._commit("batches", self.spark.createDataFrame([(batch, reference_date)], "name string, reference_date string"), now)
        return gold.count()

    def table(self) -> DataFrame:
        """The customer 360 as of the last batch."""
        done = len(self.batches())
        if not done:
            raise ValueError(f"no batch has been added to {self.path}")
        return self._latest("gold", done)

    def compact(self) -> None:
        """Bring earlier batches together in the partition of the last one: latest rows, and one partial a customer and day.

        Each table is switched as a whole, and reads the same before and after.
        """
        done = len(self.batches())
        owned = [{"batch": b} for b in range(1, done + 1)]
        for table in ("orders", "days", "profiles", "bases", "gold") if done > 1 else ():
            if table == "days":
                rows = self._summed(self._log("days", done)).where("orders > 0")
            else:
                rows = self._latest(table, done)
            self._commit(table, stage(rows, f"store_{table}"), done, owned)
