"""Customer, product and lag features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from shelfwise.functions.ordered import HOT_ROWS, row_numbers, trailing
from shelfwise.functions.quantiles import bin_by_edges, exact_quantiles
from shelfwise.functions.shape import epoch_seconds, share
from shelfwise.functions.storage import cut

# Segment names in the order their rules are tried (fixed values); see rfm_segment.
SEGMENTS = [
    "Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost", "New Customers", "Promising",
]
CUSTOMER_BUCKETS = 8  # tasks that share the lines of one product


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def rfm_base(df: DataFrame, reference_date: str | None = None) -> DataFrame:
    """(customer_id, recency, frequency, monetary, total_profit, total_quantity).

    Recency is in whole days up to the reference time, by default a day after the last order.
    The customer totals are written once: the last order of all, quantile edges and ranks are
    then found on that table, and the lines are read a single time.
    """
    totals = cut(
        df.where(F.col("customer_id").isNotNull())
        .withColumn("_at", epoch_seconds("order_date"))
        .groupBy("customer_id")
        .agg(
            F.max("_at").alias("_last"),
            F.count_distinct("order_id").alias("frequency"),
            _total("sales").alias("monetary"),
            _total("profit").alias("total_profit"),
            _total("quantity").alias("total_quantity"),
        )
    )
    if reference_date is None:
        until = totals.agg(F.max("_last").alias("t")).scalar() + 86400
    else:
        until = F.lit(datetime.fromisoformat(reference_date).replace(tzinfo=timezone.utc).timestamp())
    return totals.select(
        "customer_id",
        F.floor((until - F.col("_last")) / 86400).cast("int").alias("recency"),
        "frequency", "monetary", "total_profit", "total_quantity",
    )


def rank_score(df: DataFrame, order: Sequence[str], bins: int, name: str) -> DataFrame:
    """Quantile bin 1..bins of each row's position in a total order."""
    n = df.agg(F.count("*").alias("n")).scalar()
    ahead = F.col("_rank") - 1
    score = F.when(n > 1, F.greatest(F.lit(1), F.ceil(ahead * bins / (n - 1)))).otherwise(1)
    return row_numbers(df, [], order, "_rank").withColumn(name, score.cast("int")).drop("_rank")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment by the first rule that holds."""
    rules = [
        (r >= 4) & (f >= 4) & (m >= 4),
        f >= 4,
        (r >= 3) & (f >= 3),
        (r <= 2) & (f >= 3),
        (r <= 2) & (f <= 2),
        (r >= 4) & (f <= 2),
    ]
    segment = F.lit(SEGMENTS[-1])
    for rule, name in reversed(list(zip(rules, SEGMENTS))):
        segment = F.when(rule, name).otherwise(segment)
    return segment


def rfm_features(
    df: DataFrame,
    reference_date: str | None = None,
    recency_bins: int = 5,
    frequency_bins: int = 5,
    monetary_bins: int = 5,
    *,
    invert_recency: bool = False,
) -> DataFrame:
    """RFM table with quantile scores and segments.

    A longer recency gives a higher r_score unless ``invert_recency`` is set.
    """
    base = rfm_base(df, reference_date)
    steps = lambda q: [i / q for i in range(q + 1)]
    if recency_bins == monetary_bins:
        edges = exact_quantiles(base, ["recency", "monetary"], steps(recency_bins))
    else:
        edges = exact_quantiles(base, ["recency"], steps(recency_bins)) | exact_quantiles(
            base, ["monetary"], steps(monetary_bins))
    r_edges, m_edges = ([e for e in edges[c] if e is not None] or [0.0] for c in ("recency", "monetary"))
    r_score = bin_by_edges(F.col("recency"), r_edges)
    if invert_recency:
        r_score = recency_bins + 1 - r_score
    scored = rank_score(base, ["frequency", "customer_id"], frequency_bins, "f_score").withColumns(
        {"r_score": r_score.cast("int"), "m_score": bin_by_edges(F.col("monetary"), m_edges).cast("int")}
    )
    return scored.select(
        *base.columns, "r_score", "f_score", "m_score",
        (F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")).alias("rfm_score"),
        rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("segment"),
    )


def segment_profile(rfm: DataFrame) -> DataFrame:
    """(segment, recency, frequency, monetary, customers): means per segment, and over all as 'All'."""
    means = [F.avg(c).alias(c) for c in ("recency", "frequency", "monetary")]
    return rfm.rollup("segment").agg(*means, F.count("*").alias("customers"), F.grouping("segment").alias("_all")).select(
        F.when(F.col("_all") == 1, "All").otherwise(F.col("segment")).alias("segment"),
        "recency", "frequency", "monetary", "customers",
    )


def segment_share(rfm: DataFrame) -> DataFrame:
    """(segment, customers, percent), largest first."""
    counts = rfm.groupBy("segment").agg(F.count("*").alias("customers"))
    total = F.sum("customers").over(Window.partitionBy())  # one row per segment
    return counts.withColumn("percent", share(F.col("customers"), total)).orderBy(F.desc("customers"), "segment")


def classification_features(rfm: DataFrame) -> DataFrame:
    """Adds avg_profit and avg_order_value per order, and profit_margin."""
    return rfm.withColumns({
        "avg_profit": F.try_divide("total_profit", "frequency"),
        "avg_order_value": F.try_divide("monetary", "frequency"),
        "profit_margin": F.try_divide("total_profit", "monetary"),
    })


def preferred(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, preferred_<column>...): most frequent value per key, the smallest among ties, else 'Unknown'.

    Values are counted per (key, value) first, so no buffer holds the values of a whole key.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_value")) for c in columns])
    counts = df.select(key, F.inline(cells)).groupBy(key, "_column", "_value").agg(F.count("*").alias("_n"))
    first = F.struct(-F.col("_n"), F.col("_value"))
    best = [
        F.min(F.when((F.col("_column") == c) & F.col("_value").isNotNull(), first))["_value"] for c in columns
    ]
    return counts.groupBy(key).agg(
        *[F.coalesce(b, F.lit("Unknown")).alias(f"preferred_{c}") for c, b in zip(columns, best)]
    )


def customer_features(df: DataFrame) -> DataFrame:
    """One row per customer: orders, dates, money, preferences, orders per 30 days and margin.

    ``avg_order_value`` is the mean per line and ``sales_variance`` a standard deviation.
    The preferred category and region are the most frequent, the smallest among ties.
    """
    days = F.date_diff("last_order_date", "first_order_date") + 1
    lines = df.where(F.col("customer_id").isNotNull())
    return (
        lines.groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            _total("sales").alias("total_sales"),
            F.avg("sales").alias("avg_order_value"),
            F.stddev_samp("sales").alias("sales_variance"),
            F.min("sales").alias("min_order_value"),
            F.max("sales").alias("max_order_value"),
            _total("profit").alias("total_profit"),
            F.avg("profit").alias("avg_profit"),
            _total("quantity").alias("total_quantity"),
            F.avg("quantity").alias("avg_quantity"),
            F.avg("discount").alias("avg_discount"),
            F.max("discount").alias("max_discount"),
        )
        .join(preferred(lines, "customer_id", ["category", "region"]), "customer_id")
        .withColumns({
            "order_frequency": F.col("total_orders") / days * 30,
            "profit_margin": F.try_divide("total_profit", "total_sales"),
        })
    )


def product_features(df: DataFrame) -> DataFrame:
    """One row per (product_id, product_name).

    Lines are added up per order, which needs no shuffle where they were joined by order, then once dealt out by product
    and ``CUSTOMER_BUCKETS`` groups of customers, so that a product with most lines is shared by several tasks. Counting
    distinct orders and customers of the lines themselves would shuffle three rows for each.
    """
    keys, parts = ["product_id", "product_name"], ["sales", "profit", "quantity", "discount"]
    sums = [f(c).alias(f"_{name}_{c}") for c in parts for name, f in (("sum", F.sum), ("n", F.count))]
    added = [s for c in parts for s in (f"_sum_{c}", f"_n_{c}")]
    per_order = (
        df.where(F.col("product_id").isNotNull() & F.col("product_name").isNotNull())
        .groupBy(*keys, "order_id").agg(*sums, F.collect_set("customer_id").alias("_customers"))
    )
    first = F.coalesce(F.col("_place"), F.lit(0)) == 0  # an order of several customers counts once
    per_customer = (
        per_order.select("*", F.posexplode_outer("_customers").alias("_place", "customer_id"))
        .select(*keys, "customer_id", F.pmod(F.xxhash64("customer_id"), F.lit(CUSTOMER_BUCKETS)).alias("_bucket"),
                (first & F.col("order_id").isNotNull()).cast("long").alias("_orders"), *[F.when(first, F.col(c)).alias(c) for c in added])
        .repartition(*keys, "_bucket")
        .groupBy(*keys, "_bucket", "customer_id").agg(*[F.sum(c).alias(c) for c in ("_orders", *added)])
    )
    total = lambda c: _total(f"_sum_{c}").alias(f"total_{c}")
    mean = lambda c: F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(f"avg_{c}")
    return (
        per_customer.groupBy(*keys)
        .agg(
            F.sum("_orders").alias("total_orders"), F.count("customer_id").alias("unique_customers"),
            *[f(c) for c in ("sales", "profit", "quantity") for f in (total, mean)], mean("discount"),
        )
        .withColumn("profit_margin", F.try_divide("total_profit", "total_sales"))
    )


def lag_features(
    df: DataFrame,
    group_col: str = "customer_id",
    target_col: str = "sales",
    lags: Sequence[int] = (1, 3, 6, 12),
    *,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Lags, trailing means over 3 and 6 rows, and the first difference within each group.

    Rows run by customer, order date and then ``order``, whatever the group. Rows without a
    group key have no history and get nulls.
    """
    x = F.col(target_col)

    def expressions(window: WindowSpec) -> dict[str, Column]:
        columns = {f"{target_col}_lag_{k}": F.lag(x, k).over(window) for k in lags}
        for length in (3, 6):
            columns[f"{target_col}_rolling_mean_{length}"] = F.avg(x).over(window.rowsBetween(1 - length, 0))
        columns[f"{target_col}_diff"] = x - F.lag(x, 1).over(window)
        return columns

    run = ["customer_id", "order_date", *[c for c in order if c not in ("customer_id", "order_date")]]
    known = trailing(
        df.where(F.col(group_col).isNotNull()), [group_col], [c for c in run if c != group_col],
        max([6, *lags]), expressions, hot_rows=hot_rows,
    )
    unknown = df.where(F.col(group_col).isNull())
    return known.unionByName(unknown, allowMissingColumns=True)


def valid_order_lines(df: DataFrame, min_order_value: float = 10) -> DataFrame:
    """Lines of the orders whose sales add up to at least the minimum."""
    worth = df.groupBy("order_id").agg(_total("sales").alias("value")).where(F.col("value") >= min_order_value)
    return df.join(worth.select("order_id"), "order_id", "left_semi")


def all_features(df: DataFrame, *, order: Sequence[str]) -> dict[str, DataFrame]:
    """Every feature table by name."""
    from shelfwise.operators.basket import baskets

    return {
        "rfm": rfm_features(df),
        "basket": baskets(df),
        "customers": customer_features(df),
        "products": product_features(df),
        "main": lag_features(df, order=order),
    }
