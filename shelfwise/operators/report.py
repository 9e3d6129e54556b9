"""Report tables: profile, insights and the final report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.shape import numeric_columns, stacked, text_columns
from shelfwise.functions.storage import cut
from shelfwise.operators import profile

# Sentences of the insight report.
SEGMENT_ADVICE = {
    "Champions": "keep them with rewards and early access",
    "At Risk": "write to them before they are gone",
    "Lost": "ask why they left",
}
GENERAL_ADVICE = [
    "Spend on advertising to Champions and Potential Loyalists first",
    "Show the partners of a rule next to the basket to raise its value",
    "Compute the segments anew each month and look at who moved",
]


def eda_report(df: DataFrame) -> DataFrame:
    """(section, column, name, number, text): shape, gaps, duplicates, numeric statistics and frequent values."""
    df = cut(df)  # read again by every section
    none = F.lit(None)

    def line(section, column, name, number: Column, text: Column = none) -> Column:
        return F.struct(
            F.lit(section).alias("section"), column.cast("string").alias("column"), name.alias("name"),
            number.cast("double").alias("number"), text.cast("string").alias("text"))

    missing = profile.null_counts(df)
    kind = {c: "numeric" for c in numeric_columns(df)} | {c: "categorical" for c in text_columns(df)}
    kinds = F.create_map(*[F.lit(x) for c, k in kind.items() for x in (c, k)])
    shape = missing.agg(F.max("rows").alias("n_rows"), F.count("*").alias("n_columns"))
    stats = profile.describe(df, numeric_columns(df), written=True)
    names = [c for c in stats.columns if c != "column"]
    top = profile.top_values(df, 5)
    return (
        shape.select(F.inline(F.array(*[line("shape", none, F.lit(c), F.col(c)) for c in ("n_rows", "n_columns")])))
        .unionByName(profile.duplicate_rows(df).select(F.inline(F.array(line("shape", none, F.lit("duplicate_rows"), F.col("duplicates"))))))
        .unionByName(missing.select(F.inline(F.array(
            line("missing_values", F.col("column"), F.lit("missing"), F.col("missing"), kinds[F.col("column")])))))
        .unionByName(stats.select(F.inline(F.array(*[line("numeric_statistics", F.col("column"), F.lit(n), F.col(n)) for n in names]))))
        .unionByName(top.where("rank = 1").select(F.inline(F.array(
            line("categorical_statistics", F.col("column"), F.lit("unique_values"), F.col("distinct_values"))))))
        .unionByName(top.select(F.inline(F.array(line(
            "categorical_statistics", F.col("column"), F.format_string("top_%d", "rank"), F.col("n"), F.col("value"))))))
    )


def eda_insights(df: DataFrame) -> DataFrame:
    """(seq, text): size of the table and number of duplicate rows."""
    df = cut(df)  # read again to find the duplicates
    rows = df.agg(F.count("*").alias("n")).select(
        F.lit(1).alias("seq"), F.format_string(f"The table has %d rows in {len(df.columns)} columns", "n").alias("text"))
    return rows.unionByName(profile.duplicate_rows(df).select(
        F.lit(2).alias("seq"), F.format_string("%d rows repeat another one", "duplicates").alias("text")))


def _said(kind: str, seq: int, text: Column) -> list[Column]:
    return [F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text")]


def actionable_insights(
    rfm: DataFrame | None = None, rules: DataFrame | None = None, profiles: DataFrame | None = None,
    forecasts: DataFrame | None = None, *, spark=None,
) -> DataFrame:
    """(seq, kind, text): sentences on segments, rules, clusters and forecasts, then general advice.

    ``forecasts`` has (model, mae); the lowest is named. Inputs that are left out are passed over.
    """
    tables = []
    if rfm is not None:
        counts = rfm.groupBy("segment").agg(F.count("*").alias("n"))
        percent = F.col("n") / F.sum("n").over(Window.partitionBy()) * 100  # one row per segment
        names = F.array(*[F.lit(s) for s in SEGMENT_ADVICE])
        advice = F.create_map(*[F.lit(x) for pair in SEGMENT_ADVICE.items() for x in pair])
        said = counts.withColumn("percent", percent).where(F.col("segment").isin(list(SEGMENT_ADVICE)))
        tables.append(said.select(
            F.array_position(names, F.col("segment")).cast("int").alias("seq"), F.lit("segment").alias("kind"),
            F.format_string("%s: %.1f%% of customers - %s", "segment", "percent", advice[F.col("segment")]).alias("text"),
        ))
    if rules is not None:
        best = rules.orderBy(F.desc("lift"), "antecedent", "consequent").limit(1)
        text = F.format_string(
            "Offer %s next to %s (lift %.2f)",
            F.concat_ws(", ", "consequent"), F.concat_ws(", ", "antecedent"), "lift")
        tables.append(best.select(*_said("rule", 4, text)))
    if profiles is not None:
        for seq, column, words in (
            (5, "monetary", "Cluster %d spends most: make it the premium offers"),
            (6, "frequency", "Cluster %d orders most often: propose a subscription"),
        ):
            top = profiles.agg(F.min_by("cluster", F.struct(-F.col(column), F.col("cluster"))).alias("cluster"))
            tables.append(top.where("cluster IS NOT NULL").select(*_said("cluster", seq, F.format_string(words, "cluster"))))
    if forecasts is not None:
        best = forecasts.agg(F.min(F.struct("mae", "model")).alias("b")).where("b IS NOT NULL")
        tables.append(best.select(*_said("forecast", 7, F.format_string(
            "The best forecast, %s, is off by %.2f on average", "b.model", "b.mae"))))
    session = spark or next(t for t in (rfm, rules, profiles, forecasts) if t is not None).sparkSession
    general = stacked(session.range(1), [(8 + i, "general", t) for i, t in enumerate(GENERAL_ADVICE)], ["seq", "kind", "text"])
    for table in tables:
        general = general.unionByName(table)
    return general.orderBy("seq")


def add_insight(insights: DataFrame, kind: str, text: str) -> DataFrame:
    """Appends a sentence after the last one."""
    after = insights.agg((F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("seq"))
    return insights.unionByName(after.select("seq", F.lit(kind).alias("kind"), F.lit(text).alias("text")))


def final_report(
    summary: DataFrame, insights: DataFrame, classification: DataFrame | None = None,
    clustering: DataFrame | None = None, forecasting: DataFrame | None = None, actions: DataFrame | None = None,
) -> DataFrame:
    """(section, seq, text): key figures, the first ten insights, one score line per model, and all recommended ``actions``.

    Scores come as (model, value): macro F1, silhouette and MAE. Actions are (seq, text), as from ``actionable_insights``.
    """
    figures = stacked(summary, [
        ("summary", 1, F.format_string("Orders: %d", "total_orders")),
        ("summary", 2, F.format_string("Customers: %d", "total_customers")),
        ("summary", 3, F.concat(F.lit("Sales: $"), F.format_number("total_sales", 2))),
        ("summary", 4, F.concat(F.lit("Profit: $"), F.format_number("total_profit", 2))),
    ], ["section", "seq", "text"])
    found = insights.orderBy("seq").limit(10).select(F.lit("findings").alias("section"), "seq", "text")
    report = figures.unionByName(found)
    for section, scores, words in (
        ("classification", classification, "%s: macro F1 %.4f"),
        ("clustering", clustering, "%s: silhouette %.4f"),
        ("forecasting", forecasting, "%s: mean absolute error %.2f"),
    ):
        if scores is not None:
            report = report.unionByName(scores.select(
                F.lit(section).alias("section"), F.lit(1).alias("seq"), F.format_string(words, "model", "value").alias("text")))
    if actions is not None:
        report = report.unionByName(actions.select(F.lit("recommendations").alias("section"), "seq", "text"))
    return report
