"""Exploratory summaries of the raw tables and of person-level behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela import settings as S
from clientela.functions.columns import amount, cents, elapsed_days
from clientela.functions.skew import spread_join
from clientela.session import materialise

PURCHASED = "order_purchase_timestamp"
PERSON = "customer_unique_id"
OUTLIER_Z = 3.0
MONTH = "yyyy-MM"


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: row count, column count, position and data type."""
    parts = []
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"))
                for i, (c, t) in enumerate(df.dtypes, 1)
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            counted.select(
                F.lit(name).alias("table"),
                "rows",
                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                F.inline(columns),
            )
        )
    return _union(parts)


def null_percentages(tables: dict[str, DataFrame]) -> DataFrame:
    """Percentage of nulls for every column that has any: ``table, column, null_pct``."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
        )
        long = counted.unpivot(["_rows"], df.columns, "column", "nulls")
        parts.append(
            long.where(F.col("nulls") > 0).select(
                F.lit(name).alias("table"),
                "column",
                (F.col("nulls") * 100.0 / F.col("_rows")).alias("null_pct"),
            )
        )
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def status_frequency(orders: DataFrame) -> DataFrame:
    counted = orders.where(F.col("order_status").isNotNull()).groupBy("order_status").count()
    return counted.orderBy(F.desc("count"), "order_status")


def month_of(column: str) -> Column:
    return F.date_format(F.col(column), MONTH)


def monthly_orders(orders: DataFrame) -> DataFrame:
    dated = orders.where(F.col(PURCHASED).isNotNull())
    counted = dated.groupBy(month_of(PURCHASED).alias("order_month"))
    return counted.agg(F.count(F.lit(1)).alias("orders")).orderBy("order_month")


def order_span(orders: DataFrame) -> DataFrame:
    """First and last purchase and the number of months with orders."""
    months = monthly_orders(orders).agg(F.count(F.lit(1))).scalar()
    return orders.agg(
        F.min(PURCHASED).alias("first_purchase"), F.max(PURCHASED).alias("last_purchase")
    ).withColumn("months", months)


def _person_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their person; a buyer with very many orders is spread over tasks."""
    known = orders.select("order_id", "customer_id", PURCHASED)
    return spread_join(known, customers.select("customer_id", PERSON), "customer_id", "inner")


def _price_per_order(items: DataFrame) -> DataFrame:
    """Item prices summed per order, so that an order meets the join as one row."""
    return items.groupBy("order_id").agg(F.sum(cents("price")).alias("_cents"))


def orders_per_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = _person_orders(orders, customers).where(F.col(PERSON).isNotNull())
    return joined.groupBy(PERSON).agg(F.count_distinct("order_id").alias("orders"))


def spend_per_person(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    joined = _person_orders(orders, customers).join(_price_per_order(items), "order_id")
    return (
        joined.where(F.col(PERSON).isNotNull())
        .groupBy(PERSON)
        .agg(amount(F.sum("_cents")).alias("spend"))
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last bin closed on the right.

    Every bin is listed, empty ones with count 0.
    """
    value = F.col(column).cast("double")
    # Read twice (edges, then counts): written once, one column.
    present = materialise(df.where(value.isNotNull()).select(value.alias("v")), "histogram")
    edges = present.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    low, high = edges["low"], edges["high"]
    # A constant column gets a unit-wide range centred on its value.
    start = F.when(low == high, low - 0.5).otherwise(low)
    width = F.when(low == high, F.lit(1.0)).otherwise(high - low) / F.lit(float(bins))
    place = F.least(F.floor((F.col("v") - start) / width), F.lit(bins - 1)).cast("int")
    counted = present.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("bin_start"),
        (start + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def repeat_share(per_person: DataFrame) -> DataFrame:
    """Persons with one order against persons with two or more."""
    counted = per_person.agg(
        F.count(F.lit(1)).alias("persons"),
        F.count_if(F.col("orders") == 1).alias("single"),
        F.count_if(F.col("orders") >= 2).alias("repeat"),
    )
    total = F.col("persons").cast("double")
    return counted.withColumns(
        {
            "single_pct": F.try_divide(F.col("single") * 100.0, total),
            "repeat_pct": F.try_divide(F.col("repeat") * 100.0, total),
        }
    )


def person_rfm(
    orders: DataFrame, customers: DataFrame, items: DataFrame, snapshot_at: Column | None = None
) -> DataFrame:
    """Recency at the latest purchase of the table, orders and spend per person."""
    if snapshot_at is None:
        snapshot_at = orders.agg(F.max(F.col(PURCHASED).cast("timestamp"))).scalar()
    joined = _person_orders(orders, customers).join(_price_per_order(items), "order_id")
    grouped = (
        joined.where(F.col(PERSON).isNotNull())
        .groupBy(PERSON)
        .agg(
            F.max(PURCHASED).alias("_last"),
            F.count_distinct("order_id").alias("frequency"),
            amount(F.sum("_cents")).alias("monetary"),
        )
    )
    return grouped.select(
        PERSON, elapsed_days(snapshot_at, F.col("_last")).alias("recency"), "frequency", "monetary"
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair as rows ``a, b, correlation``; one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [(a, a, F.lit(1.0)) for a in columns]
    for a, b in pairs:
        cells += [(a, b, F.col(f"`{a}|{b}`")), (b, a, F.col(f"`{a}|{b}`"))]
    structs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), c.alias("correlation")) for a, b, c in cells
    ]
    return row.select(F.inline(F.array(*structs)))


def _reviewed_orders(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Review counts per order and score next to the order's purchase time."""
    per_order = reviews.groupBy("order_id", "review_score").agg(F.count(F.lit(1)).alias("n"))
    return per_order.join(orders.select("order_id", PURCHASED), "order_id")


def review_distribution(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    scored = _reviewed_orders(reviews, orders).where(F.col("review_score").isNotNull())
    return scored.groupBy("review_score").agg(F.sum("n").alias("reviews")).orderBy("review_score")


def _mean_score() -> Column:
    known = F.when(F.col("review_score").isNotNull(), F.col("n"))
    total = F.sum(F.col("review_score").cast("bigint") * F.col("n"))
    return F.try_divide(total.cast("double"), F.sum(known).cast("double"))


def monthly_review_score(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    grouped = _reviewed_orders(reviews, orders).where(F.col(PURCHASED).isNotNull())
    return (
        grouped.groupBy(month_of(PURCHASED).alias("order_month"))
        .agg(_mean_score().alias("avg_score"))
        .orderBy("order_month")
    )


def overall_review_score(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    return _reviewed_orders(reviews, orders).agg(_mean_score().alias("avg_score"))


def with_churn(rfm: DataFrame, days: int = S.CHURN_DAYS) -> DataFrame:
    return rfm.withColumn("churn", F.coalesce(F.col("recency") > days, F.lit(False)).cast("int"))


def churn_balance(rfm: DataFrame, days: int = S.CHURN_DAYS) -> DataFrame:
    """Per class: persons, share of all, and the overall churn rate."""
    counted = with_churn(rfm, days).groupBy("churn").agg(F.count(F.lit(1)).alias("persons"))
    # Two rows at most, gathered into one to add the shares.
    both = counted.agg(
        F.collect_list(F.struct("churn", "persons")).alias("c"),
        F.sum("persons").alias("total"),
        F.sum(F.col("churn") * F.col("persons")).alias("churned"),
    )
    return both.select(F.inline("c"), "total", "churned").select(
        "churn",
        "persons",
        (F.col("persons") / F.col("total")).alias("share"),
        (F.col("churned") / F.col("total")).alias("churn_rate"),
    )


def person_states(customers: DataFrame) -> DataFrame:
    return customers.select(PERSON, "customer_state").distinct()


def churn_by_state(rfm: DataFrame, customers: DataFrame, days: int = S.CHURN_DAYS) -> DataFrame:
    """Mean churn per state over distinct person-state pairs, highest first."""
    joined = with_churn(rfm, days).join(person_states(customers), PERSON)
    rates = joined.where(F.col("customer_state").isNotNull()).groupBy("customer_state")
    return rates.agg(F.avg("churn").alias("churn_rate")).orderBy(F.desc("churn_rate"), "customer_state")


def outliers(rfm: DataFrame, limit: float = OUTLIER_Z) -> DataFrame:
    """Persons with z-scores (sample deviation) and whether either exceeds ``limit``.

    The person table is read by the deviation and by the scores, so it is written once.
    """
    rfm = materialise(rfm, "person-rfm")
    stats = rfm.agg(
        F.struct(
            F.avg("monetary").alias("m_mean"),
            F.stddev_samp("monetary").alias("m_sd"),
            F.avg("frequency").alias("f_mean"),
            F.stddev_samp("frequency").alias("f_sd"),
        )
    ).scalar()
    scored = rfm.withColumns(
        {
            "monetary_z": F.try_divide(F.col("monetary") - stats["m_mean"], stats["m_sd"]),
            "frequency_z": F.try_divide(F.col("frequency") - stats["f_mean"], stats["f_sd"]),
        }
    )
    beyond = (F.abs("monetary_z") > limit) | (F.abs("frequency_z") > limit)
    return scored.withColumn("anomaly_flag", F.coalesce(beyond, F.lit(False)))


def outlier_share(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count_if("anomaly_flag").alias("outliers"),
        (F.avg(F.col("anomaly_flag").cast("int")) * 100.0).alias("outlier_pct"),
    )


def top_outliers(flagged: DataFrame, count: int = 10) -> DataFrame:
    return flagged.where("anomaly_flag").orderBy(F.desc("monetary_z"), PERSON).limit(count)


def outliers_by_state(flagged: DataFrame, customers: DataFrame) -> DataFrame:
    joined = flagged.where("anomaly_flag").join(person_states(customers), PERSON)
    counted = joined.where(F.col("customer_state").isNotNull()).groupBy("customer_state").count()
    return counted.orderBy(F.desc("count"), "customer_state")
