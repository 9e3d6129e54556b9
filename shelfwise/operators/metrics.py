"""Scores of predictions, computed from counts.

Classification works on the confusion counts, which are tiny; ROC works on the counts of
positives and negatives per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.ordered import HOT_ROWS, running_totals
from shelfwise.functions.shape import column_values, stacked
from shelfwise.functions.storage import cut

LOWER_IS_BETTER = {"mae", "rmse", "davies_bouldin"}


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, y_true, y_pred, n) of the pairs that occur."""
    return predictions.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def per_class(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, label, precision, recall, f1, support) for every true or predicted class; undefined is 0."""
    hit = F.col("y_true") == F.col("y_pred")
    n = F.col("n")
    sides = confusion_counts(predictions, by).select(*by, F.inline(F.array(
        F.struct(F.col("y_true").alias("label"), F.when(hit, n).otherwise(0).alias("tp"), n.alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("actual"), n.alias("predicted")),
    )))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, actual, predicted = F.col("tp"), F.col("actual"), F.col("predicted")
    return (
        sides.groupBy(*by, "label")
        .agg(F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
        .select(
            *by, "label", ratio(tp, predicted).alias("precision"), ratio(tp, actual).alias("recall"),
            ratio(2 * tp, actual + predicted).alias("f1"), actual.alias("support"), tp.alias("hits"),
        )
    )


def classification_metrics(predictions: DataFrame, average: str = "macro", by: Sequence[str] = ()) -> DataFrame:
    """(*by, metric, value): accuracy, averaged precision, recall and F1, and weighted F1."""
    support = F.col("support")
    if average == "macro":
        mean = F.avg
    elif average == "weighted":
        mean = lambda c: F.sum(F.col(c) * support) / F.sum(support)
    elif average == "micro":  # every row has one true and one predicted class, so all three are the accuracy
        mean = lambda c: F.sum("hits") / F.sum(support)
    else:
        raise ValueError("average must be 'macro', 'weighted' or 'micro'")
    table = per_class(predictions, by).groupBy(*by).agg(
        (F.sum("hits") / F.sum(support)).alias("accuracy"),
        *[mean(c).alias(c) for c in ("precision", "recall", "f1")],
        (F.sum(F.col("f1") * support) / F.sum(support)).alias("f1_weighted"),
    )
    names = ["accuracy", "precision", "recall", "f1", "f1_weighted"]
    suffix = {c: f"{c}_{average}" for c in ("precision", "recall", "f1")}
    cells = F.array(*[F.struct(F.lit(suffix.get(c, c)).alias("metric"), F.col(c).alias("value")) for c in names])
    return table.select(*by, F.inline(cells))


def confusion_matrix(predictions: DataFrame, normalize: bool = False) -> DataFrame:
    """(y_true, one column per class): counts, or shares of each row; a class that never occurs has null shares."""
    counts = confusion_counts(predictions)
    labels = counts.select(F.explode(F.array("y_true", "y_pred")).alias("y_true")).distinct()
    names = column_values(labels, "y_true")
    wide = labels.join(counts.groupBy("y_true").pivot("y_pred", names).agg(F.sum("n")), "y_true", "left").na.fill(0)
    if not normalize:
        return wide
    total = sum((F.col(f"`{c}`") for c in names[1:]), F.col(f"`{names[0]}`"))
    return wide.select("y_true", *[F.try_divide(F.col(f"`{c}`"), total).alias(c) for c in names])


def _score_counts(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """(*by, label, score, pos, neg) per distinct score of each class, one against the rest."""
    exploded = scores.select(*by, "y_true", F.explode("proba").alias("label", "score"))
    positive = F.col("y_true") == F.col("label")
    return exploded.groupBy(*by, "label", "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def auc_per_class(scores: DataFrame, by: Sequence[str] = (), *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(*by, label, auc) from columns y_true and proba (class -> score); null where a class is missing.

    The area is the share of (positive, negative) pairs ranked rightly, ties counting half.
    """
    keys = [*by, "label"]
    ranked = running_totals(cut(_score_counts(scores, by)), keys, ["score"], {"neg_upto": F.col("neg")}, hot_rows=hot_rows)
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(*keys).agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def roc_auc(scores: DataFrame, by: Sequence[str] = (), *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(*by, roc_auc): mean over the classes; null when any class has no positives or no negatives."""
    table = auc_per_class(scores, by, hot_rows=hot_rows)
    complete = F.count("auc") == F.count("*")
    return table.groupBy(*by).agg(F.when(complete, F.avg("auc")).alias("roc_auc"))


def roc_curve(scores: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(label, threshold, fpr, tpr): one point per distinct score, and the origin at an infinite threshold."""
    counts = cut(_score_counts(scores, ()))
    climbed = running_totals(
        counts, ["label"], [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")}, hot_rows=hot_rows
    )
    totals = counts.groupBy("label").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    points = climbed.join(totals, "label").select(
        "label", F.col("score").alias("threshold"),
        F.try_divide("fp", "_n").alias("fpr"), F.try_divide("tp", "_p").alias("tpr"),
    )
    origin = totals.select("label", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def error_pairs(predictions: DataFrame) -> DataFrame:
    """(y_true, y_pred, n) of the wrong predictions, most frequent first."""
    return confusion_counts(predictions).where("y_true <> y_pred").orderBy(F.desc("n"), "y_true", "y_pred")


def analyze_errors(predictions: DataFrame) -> DataFrame:
    """(section, name, value): confused pairs, per-class report and number of errors."""
    line = lambda section, name, value: F.struct(
        F.lit(section).alias("section"), name.alias("name"), value.cast("double").alias("value"))
    pairs = error_pairs(predictions)
    report = per_class(predictions)
    return (
        pairs.select(F.inline(F.array(line("confusion_pairs", F.concat_ws(" -> ", "y_true", "y_pred"), F.col("n")))))
        .unionByName(report.select(F.inline(F.array(*[
            line("per_class", F.concat_ws(".", "label", F.lit(c)), F.col(c)) for c in ("precision", "recall", "f1", "support")
        ]))))
        .unionByName(pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.inline(F.array(
            line("total_errors", F.lit("rows"), F.col("n"))))))
    )


def _regression_columns(y: Column, p: Column) -> dict[str, Column]:
    error = p - y
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    return {
        "mae": F.avg(F.abs(error)),
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.avg(F.abs(error / (y + 1e-8))) * 100,
        "smape": F.avg(2 * F.abs(error) / (F.abs(y) + F.abs(p) + 1e-8)) * 100,
        "r2": F.when(spread > 0, 1 - squares / spread).otherwise(F.when(squares == 0, 1.0).otherwise(0.0)),
    }


def regression_metrics(
    df: DataFrame, by: Sequence[str] = (), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """(*by, mae, mse, rmse, mape, smape, r2) in one pass."""
    columns = _regression_columns(F.col(y), F.col(yhat))
    return df.groupBy(*by).agg(*[value.alias(name) for name, value in columns.items()])


def forecast_metrics(forecasts: DataFrame, by: Sequence[str] = ("series", "model")) -> DataFrame:
    """Regression metrics and the share of steps whose direction is right.

    Steps follow ``period`` inside each series, which is as long as its calendar.
    """
    window = Window.partitionBy(*by).orderBy("period")
    rises = lambda c: F.col(c) > F.lag(c).over(window)
    stepped = forecasts.withColumn("_agree", (rises("y") == rises("yhat")).cast("double"))
    columns = _regression_columns(F.col("y"), F.col("yhat"))
    return stepped.groupBy(*by).agg(
        *[value.alias(name) for name, value in columns.items()], F.avg("_agree").alias("direction_accuracy")
    )


def residuals(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(yhat))


def long_metrics(wide: DataFrame, model: str = "model") -> DataFrame:
    """(model, metric, value) from one column per metric."""
    names = [c for c in wide.columns if c != model]
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
    return wide.select(F.col(model).alias("model"), F.inline(cells))


def compare_models(
    results: DataFrame, metrics: Sequence[str], metric: str = "f1_score", descending: bool = True
) -> DataFrame:
    """(model, one column per metric) from (model, metric, value), best model first."""
    wide = results.groupBy("model").pivot("metric", list(metrics)).agg(F.first("value", ignorenulls=True))
    if metric not in metrics:
        return wide
    key = F.col(f"`{metric}`")
    return wide.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), "model")


def model_comparison_report(results: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``compare_models`` by f1_score, else mae, else silhouette, with the best model marked."""
    metric = next((m for m in ("f1_score", "mae", "silhouette") if m in metrics), None)
    if metric is None:
        return compare_models(results, metrics, "").withColumn("best", F.lit(False))
    down = metric not in LOWER_IS_BETTER
    wide = compare_models(results, metrics, metric, down)
    key = F.col(f"`{metric}`")
    first = F.min_by("model", F.struct(-key if down else key, F.col("model")))
    best = wide.where(key.isNotNull()).agg(first.alias("model")).scalar()
    return wide.withColumn("best", F.coalesce(F.col("model") == best, F.lit(False)))


def summary_text(results: DataFrame) -> DataFrame:
    """(model, seq, text): one line per metric, for reading."""
    window = Window.partitionBy("model").orderBy("metric")
    return results.select(
        "model", F.row_number().over(window).alias("seq"), F.format_string("%s: %.4f", "metric", "value").alias("text")
    )
