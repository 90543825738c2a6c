"""Commerce: cleansed customers, orders, items and products, and the tables computed from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.functions import dates, numbers, scoring, text
from lamella.operators import dedupe, rank
from lamella.operators.validate import Rule, Split, split_valid
from lamella.staging import stage

# Order states, and those that count as revenue.
ORDER_STATUSES = ["completed", "shipped", "processing", "cancelled", "refunded"]
REVENUE_STATUSES = ["completed", "shipped", "processing"]

LATEST_BY = "_ingestion_timestamp"
VERSION = "1.0.0"


def customer_rules() -> list[Rule]:
    return [
        Rule("MISSING_CUSTOMER_ID", text.is_filled(F.col("customer_id"))),
        Rule("BAD_EMAIL", F.col("email").contains("@")),
        Rule("MISSING_FIRST_NAME", text.is_filled(F.col("first_name"))),
    ]


def order_rules() -> list[Rule]:
    return [
        Rule("MISSING_ORDER_ID", text.is_filled(F.col("order_id"))),
        Rule("MISSING_CUSTOMER_ID", text.is_filled(F.col("customer_id"))),
        Rule("BAD_ORDER_DATE", dates.iso_date(F.col("order_date")).isNotNull()),
        Rule("BAD_STATUS", text.lowered(F.col("status")).isin(ORDER_STATUSES)),
        Rule("BAD_AMOUNT", numbers.safe_decimal(F.col("total_amount")) >= 0),
    ]


def item_rules() -> list[Rule]:
    return [
        Rule("MISSING_ORDER_ITEM_ID", text.is_filled(F.col("order_item_id"))),
        Rule("MISSING_ORDER_ID", text.is_filled(F.col("order_id"))),
        Rule("MISSING_PRODUCT_ID", text.is_filled(F.col("product_id"))),
        Rule("BAD_QUANTITY", F.trim("quantity").try_cast("int") > 0),
        Rule("BAD_UNIT_PRICE", numbers.safe_decimal(F.col("unit_price")) > 0),
    ]


def product_rules() -> list[Rule]:
    return [
        Rule("MISSING_PRODUCT_ID", text.is_filled(F.col("product_id"))),
        Rule("BAD_PRICE", numbers.safe_decimal(F.col("price")) > 0),
    ]


def _silver(raw: DataFrame, rules: list[Rule], key: str, newest: str, split: Split, columns: list[Column]):
    valid, rejected = split(raw, rules)
    kept = dedupe.latest(valid, [key], newest)
    lineage = F.col("_batch_id").alias("_bronze_batch_id"), F.lit(VERSION).alias("_silver_version")
    return kept.select(*columns, *lineage), rejected


def silver_customers(raw: DataFrame, newest: str = LATEST_BY, split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). Rows are validated before the latest of each customer is chosen."""
    return _silver(raw, customer_rules(), "customer_id", newest, split, [
        F.col("customer_id"),
        text.lowered(F.col("email")).alias("email"),
        text.clean(F.col("first_name")).alias("first_name"),
        text.clean(F.col("last_name")).alias("last_name"),
        text.clean(F.col("city")).alias("city"),
        text.uppered(F.col("state")).alias("state"),
        dates.iso_date(F.col("signup_date")).alias("signup_date"),
        text.flag(F.col("is_active")).alias("is_active"),
    ])


def silver_orders(raw: DataFrame, newest: str = LATEST_BY, split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    return _silver(raw, order_rules(), "order_id", newest, split, [
        F.col("order_id"),
        F.col("customer_id"),
        dates.iso_date(F.col("order_date")).alias("order_date"),
        text.lowered(F.col("status")).alias("status"),
        numbers.safe_decimal(F.col("total_amount")).alias("total_amount"),
        text.lowered(F.col("payment_method")).alias("payment_method"),
    ])


def silver_order_items(raw: DataFrame, newest: str = LATEST_BY, split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    return _silver(raw, item_rules(), "order_item_id", newest, split, [
        F.col("order_item_id"),
        F.col("order_id"),
        F.col("product_id"),
        F.trim("quantity").try_cast("int").alias("quantity"),
        numbers.safe_decimal(F.col("unit_price")).alias("unit_price"),
        numbers.safe_decimal(F.col("line_total")).alias("line_total"),
    ])


def silver_products(raw: DataFrame, newest: str = LATEST_BY, split: Split = split_valid) -> tuple[DataFrame, DataFrame]:
    price, cost = numbers.safe_decimal(F.col("price")), numbers.safe_decimal(F.col("cost"))
    return _silver(raw, product_rules(), "product_id", newest, split, [
        F.col("product_id"),
        text.clean(F.col("name")).alias("name"),
        text.clean(F.col("category")).alias("category"),
        price.alias("price"),
        cost.alias("cost"),
        numbers.percent(price - cost, price).alias("margin_pct"),
    ])


def customer_order_metrics(
    orders: DataFrame,
    excluded: str = "refunded",
    reference_date: str | None = None,
    window_months: int | None = None,
) -> DataFrame:
    """One row per customer with orders. ``orders`` is unique by order, so plain counts are distinct counts.

    ``rfm_orders`` and ``rfm_revenue`` cover the whole lifetime, or the last ``window_months`` before
    ``reference_date``.
    """
    amount, status = F.col("total_amount"), F.col("status")
    recent = F.lit(True)
    if window_months is not None:
        end = F.lit(reference_date).cast("date")
        recent = F.col("order_date").between(F.add_months(end, -window_months), end)
    return (
        orders.where(status != excluded)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum(amount).alias("total_revenue"),
            numbers.ratio(F.sum(amount), F.count(amount), 2).alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count_if(status == "completed").alias("completed_orders"),
            F.count_if(status == "cancelled").alias("cancelled_orders"),
            F.count_if(recent).alias("rfm_orders"),
            F.coalesce(F.sum(F.when(recent, amount)), F.lit(0)).alias("rfm_revenue"),
        )
    )


def refresh_order_metrics(
    previous: DataFrame, before: DataFrame, orders: DataFrame, changed: DataFrame, **options
) -> DataFrame:
    """Metrics after a batch: only customers of changed orders are computed again, the rest is kept.

    ``before`` and ``orders`` are the valid orders without and with the batch, ``changed`` has the ids and customers of
    the batch. An order may move to another customer, so those who had it before count as well as those who have it now.
    """
    had = before.join(changed.select("order_id"), "order_id", "left_semi").select("customer_id")
    keys = had.unionByName(changed.select("customer_id")).distinct()
    again = customer_order_metrics(orders.join(keys, "customer_id", "left_semi"), **options)
    return previous.join(keys, "customer_id", "left_anti").unionByName(again)


RFM_VALUES = ["recency_days", "rfm_orders", "rfm_revenue"]


def with_recency(metrics: DataFrame, reference_date: str) -> DataFrame:
    recency = dates.days_between(F.col("last_order_date"), F.lit(reference_date).cast("date"))
    return metrics.withColumn("recency_days", F.coalesce(recency, F.lit(9999)))


def rfm_cuts(based: DataFrame) -> dict[str, list[tuple]] | None:
    """Ends of the quintiles of customers with orders; None with fewer customers than quintiles."""
    return rank.quantile_cuts(based.where("total_orders > 0"), "customer_id", RFM_VALUES)


def rfm_quintiles(cuts: dict[str, list[tuple]] | None) -> list[Column]:
    """Scores of recency, frequency and money; null without orders, and for everyone where there are no cuts."""
    if cuts is None:
        return [F.lit(None).cast("int")] * 3
    r, f, m = (rank.quantile_of(n, "customer_id", cuts[n]) for n in RFM_VALUES)
    return [F.when(F.col("total_orders") > 0, c) for c in (6 - r, f, m)]


def score_by(based: DataFrame, cuts: dict[str, list[tuple]] | None) -> DataFrame:
    r, f, m = rfm_quintiles(cuts)
    return based.withColumns({"r_score": r, "f_score": f, "m_score": m}).withColumns({
        "rfm_score": scoring.rfm_score(F.col("r_score"), F.col("f_score"), F.col("m_score")),
        "rfm_segment": F.when(
            F.col("r_score").isNotNull(),
            scoring.rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")),
        ),
    })


def rfm_scores(metrics: DataFrame, reference_date: str) -> DataFrame:
    """Quintile scores 1-5 of recency, frequency and money; ties go by customer id.

    ``metrics`` is read twice (ranking and scoring) and should be a stored table.
    """
    based = with_recency(metrics, reference_date)
    return score_by(based, rfm_cuts(based))


PROFILE = ["customer_id", "email", "first_name", "last_name", "city", "state", "signup_date", "is_active"]


def profile_with_metrics(customers: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every customer with order metrics; zeros for those without orders."""
    joined = customers.select(*PROFILE).join(metrics, "customer_id", "left").fillna(
        {"total_orders": 0, "avg_order_value": 0.0, "completed_orders": 0, "cancelled_orders": 0, "rfm_orders": 0}
    )
    zero = F.lit(0).cast("decimal(28,2)")
    return joined.withColumns({c: F.coalesce(c, zero) for c in ("total_revenue", "rfm_revenue")})


def as_customer_360(scored: DataFrame, reference_date: str) -> DataFrame:
    ref = F.lit(reference_date).cast("date")
    tenure = F.greatest(dates.days_between(F.col("signup_date"), ref), F.lit(1))
    return scored.select(
        *PROFILE,
        "total_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        F.coalesce(dates.days_between(F.col("last_order_date"), ref), F.lit(-1)).alias("days_since_last_order"),
        numbers.ratio(tenure, F.greatest("total_orders", F.lit(1)), 1).alias("order_frequency_days"),
        "completed_orders",
        "cancelled_orders",
        scoring.ltv_tier(F.col("total_revenue")).alias("ltv_tier"),
        F.coalesce("rfm_score", F.lit(0)).alias("rfm_score"),
        F.coalesce("rfm_segment", F.when(F.col("total_orders") > 0, "Not Scored").otherwise("No Orders")).alias("rfm_segment"),
        F.lit(reference_date).alias("_gold_computed_at"),
        F.lit(VERSION).alias("_gold_version"),
    )


def customer_360(
    customers: DataFrame, orders: DataFrame, reference_date: str, window_months: int | None = None
) -> DataFrame:
    """One row per customer: profile, order metrics, value tier and RFM segment.

    With fewer than five customers with orders there are no quintiles: those customers are ``Not Scored``.
    """
    metrics = customer_order_metrics(orders, reference_date=reference_date, window_months=window_months)
    joined = stage(profile_with_metrics(customers, metrics), "customer_profile")
    return as_customer_360(rfm_scores(joined, reference_date), reference_date)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of several columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.value").agg(F.count(F.lit(1)).alias("rows"))


def revenue_by_day(orders: DataFrame) -> DataFrame:
    """Orders, buyers and revenue per day, by way of (day, customer): no distinct count, no hot day."""
    by_buyer = (
        orders.where(F.col("status").isin(REVENUE_STATUSES))
        .groupBy("order_date", "customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )
    return by_buyer.groupBy("order_date").agg(
        F.sum("n").alias("order_count"),
        F.count(F.lit(1)).alias("unique_customers"),
        F.sum("amount").cast("decimal(20,2)").alias("revenue"),
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Daily revenue with means over 7 and 30 rows and the change against the row 365 before.

    The windows run over one row per calendar day, a table that does not grow with the orders.
    """
    w = Window.orderBy("order_date")
    total = F.col("revenue")

    def mean(rows: int) -> Column:
        over = w.rowsBetween(1 - rows, 0)
        return numbers.ratio(F.sum(total).over(over), F.count(total).over(over), 2)

    previous = F.col("_previous")
    return (
        revenue_by_day(orders)
        .withColumns({
            "revenue_7d_avg": mean(7),
            "revenue_30d_avg": mean(30),
            "_previous": F.lag(total, 365).over(w),
        })
        .select(
            "order_date",
            "order_count",
            "unique_customers",
            total.cast("double").alias("total_revenue"),
            numbers.ratio(total, F.col("order_count"), 2).alias("avg_order_value"),
            "revenue_7d_avg",
            "revenue_30d_avg",
            F.when(previous > 0, numbers.percent(total - previous, previous)).alias("revenue_yoy_pct"),
        )
    )


def revenue_yoy_calendar(orders: DataFrame) -> DataFrame:
    """Change against the same calendar day one year before, whatever days are missing."""
    days = revenue_by_day(orders)
    # Looking back from each day keeps the key unique: 28 and 29 February both look at 28 February.
    before = days.select(F.col("order_date").alias("_then"), F.col("revenue").alias("previous"))
    total, previous = F.col("revenue"), F.col("previous")
    looking_back = days.withColumn("_then", F.add_months("order_date", -12))
    return looking_back.join(before, "_then", "left").select(
        "order_date",
        total.cast("double").alias("total_revenue"),
        previous.cast("double").alias("previous_year_revenue"),
        F.when(previous > 0, numbers.percent(total - previous, previous)).alias("revenue_yoy_pct"),
    )


def order_lines(items: DataFrame) -> DataFrame:
    """Units and revenue per (order, product).

    Reduced before items meet their order: even an order id that very many items carry (a placeholder, a
    marketplace account) then has no more rows than there are products.
    """
    return items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue")
    )


def category_breakdown(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue of each category per day as one JSON map."""
    paid = orders.where(F.col("status").isin(REVENUE_STATUSES)).select("order_id", "order_date")
    by_product = (
        order_lines(items).join(paid, "order_id").groupBy("order_date", "product_id").agg(F.sum("revenue").alias("revenue"))
    )
    by_category = (
        by_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("order_date", "category").agg(F.sum("revenue").cast("decimal(20,2)").alias("revenue"))
    )
    entries = F.sort_array(F.collect_list(F.struct("category", "revenue")))
    return by_category.groupBy("order_date").agg(
        F.to_json(F.map_from_entries(entries)).alias("product_category_breakdown")
    )


def product_performance(products: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales, margin and buyers per product that was sold.

    Sales are reduced in steps (order, product) -> (product, buyer) -> product. Distinct counts become plain
    counts, and a best-selling product is already small when its rows meet. Product attributes are joined to
    the finished sums.
    """
    paid = orders.where(F.col("status").isin(REVENUE_STATUSES)).select("order_id", "customer_id")
    per_buyer = order_lines(items).join(paid, "order_id").groupBy("product_id", "customer_id").agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    sales = per_buyer.groupBy("product_id").agg(
        F.sum("units").alias("units_sold"),
        F.sum("revenue").cast("decimal(24,2)").alias("total_revenue"),
        F.sum("orders").alias("order_appearances"),
        F.count(F.lit(1)).alias("unique_buyers"),
    )
    sold = stage(sales.join(products, "product_id"), "sales")  # one row a product, read for the ranks and for the result
    ranked = rank.percent_rank(sold, "total_revenue", "product_id", "revenue_percentile")
    revenue = F.col("total_revenue")
    cost = F.col("units_sold") * F.col("cost")
    return ranked.select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        F.col("price").alias("current_price"),
        F.col("cost").alias("current_cost"),
        "margin_pct",
        "units_sold",
        revenue.cast("double").alias("total_revenue"),
        cost.cast("double").alias("total_cost"),
        (revenue - cost).cast("double").alias("gross_profit"),
        "order_appearances",
        "unique_buyers",
        numbers.ratio(revenue, F.col("unique_buyers"), 2).alias("revenue_per_buyer"),
        "revenue_percentile",
    )


def fact_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order facts with the date key of the calendar and the size of the order."""
    sizes = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("quantity").alias("units")
    )
    return orders.join(sizes, "order_id", "left").select(
        "order_id",
        "customer_id",
        F.date_format("order_date", "yyyyMMdd").cast("long").alias("date_key"),
        "order_date",
        "status",
        "payment_method",
        "total_amount",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("units", F.lit(0)).alias("units"),
    )


def calendar_of(spark: SparkSession, orders: DataFrame) -> DataFrame:
    return dates.dim_date(spark, orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")))
