"""Metric queries.

Predictions are derived from whole tables by rule: the market segment is the truth, and some
customers are given the alphabetically next segment instead.
"""

from pyspark.sql import functions as F

from shelfwise.operators import metrics, profile
from shelfwise.operators.timeseries import resample
from shelfwise.plans.common import rounded
from shelfwise.plans.registry import SALES, query
from shelfwise.plans.series import series_sql
from shelfwise.sources.tables import sales_lines, table

_CLASSES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_NEXT = dict(zip(_CLASSES, _CLASSES[1:] + _CLASSES[:1]))
_NEXT_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _NEXT.items()) + " END"

# Scores per class with many ties, higher for the true class.
_PREDICTIONS = "pred AS (" + " UNION ALL ".join(
    f"""SELECT '{model}' AS model, c_custkey AS key, c_mktsegment AS y_true,
    CASE WHEN c_custkey % {every} = 0 THEN {_NEXT_SQL} ELSE c_mktsegment END AS y_pred FROM customer"""
    for model, every in (("often", 5), ("rarely", 11))) + ")"
_SCORES = "scores AS (" + " UNION ALL ".join(
    f"""SELECT c_custkey AS key, c_mktsegment AS y_true, '{c}' AS label,
    ((c_custkey * 7 + {i * 13}) % 20 + CASE WHEN c_mktsegment = '{c}' THEN 10 ELSE 0 END) / 40.0 AS score FROM customer"""
    for i, c in enumerate(_CLASSES)) + ")"


def predictions(spark, sf_dir):
    following = F.create_map(*[F.lit(x) for pair in _NEXT.items() for x in pair])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("y_true"))
    wrong = lambda every: F.when(F.col("key") % every == 0, following[F.col("y_true")]).otherwise(F.col("y_true"))
    return customers.select("key", "y_true", F.inline(F.array(
        F.struct(F.lit("often").alias("model"), wrong(5).alias("y_pred")),
        F.struct(F.lit("rarely").alias("model"), wrong(11).alias("y_pred")),
    )))


def _often(spark, sf_dir):
    return predictions(spark, sf_dir).where("model = 'often'")


def scores(spark, sf_dir):
    points = lambda i, c: ((F.col("c_custkey") * 7 + i * 13) % 20 + F.when(F.col("c_mktsegment") == c, 10).otherwise(0)) / 40.0
    proba = F.create_map(*[x for i, c in enumerate(_CLASSES) for x in (F.lit(c), points(i, c))])
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("y_true"), proba.alias("proba"))


_PER_CLASS = """, labels_ AS (SELECT DISTINCT model, unnest([y_true, y_pred]) AS label FROM pred),
pc AS (SELECT l.model, label, count(*) FILTER (y_true = label AND y_pred = label) AS tp,
              count(*) FILTER (y_true = label) AS actual, count(*) FILTER (y_pred = label) AS predicted
       FROM labels_ l JOIN pred p ON p.model = l.model GROUP BY l.model, label),
pcm AS (SELECT model, label, coalesce(tp / nullif(predicted, 0), 0) AS "precision", coalesce(tp / nullif(actual, 0), 0) AS recall,
               coalesce(2 * tp / nullif(actual + predicted, 0), 0) AS f1, actual AS support, tp FROM pc)"""


@query("met_per_class", f"""WITH {_PREDICTIONS}{_PER_CLASS}
SELECT model, label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pcm""")
def met_per_class(spark, sf_dir):
    return rounded(metrics.per_class(predictions(spark, sf_dir), ["model"]).drop("hits"), 6)


_MACRO = """acc AS (SELECT model, sum(tp) / sum(support) AS accuracy, avg("precision") AS p, avg(recall) AS r, avg(f1) AS f,
  sum("precision" * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1 * support) / sum(support) AS wf FROM pcm GROUP BY model)"""


def _classification_sql(average, p, r, f):
    return f"""WITH {_PREDICTIONS}{_PER_CLASS}, {_MACRO}
SELECT model, 'accuracy' AS metric, round(accuracy, 6) AS value FROM acc
UNION ALL SELECT model, 'precision_{average}', round({p}, 6) FROM acc
UNION ALL SELECT model, 'recall_{average}', round({r}, 6) FROM acc
UNION ALL SELECT model, 'f1_{average}', round({f}, 6) FROM acc
UNION ALL SELECT model, 'f1_weighted', round(wf, 6) FROM acc"""


@query("met_classification", _classification_sql("macro", "p", "r", "f"))
def met_classification(spark, sf_dir):
    return rounded(metrics.classification_metrics(predictions(spark, sf_dir), "macro", ["model"]), 6)


@query("met_classification_micro", _classification_sql("micro", "accuracy", "accuracy", "accuracy"))
def met_classification_micro(spark, sf_dir):
    return rounded(metrics.classification_metrics(predictions(spark, sf_dir), "micro", ["model"]), 6)


_AUC = f"""WITH {_SCORES}, ranked AS (
  SELECT *, rank() OVER (PARTITION BY label ORDER BY score) + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0 AS r FROM scores),
auc AS (SELECT label, (sum(r) FILTER (y_true = label) - count(*) FILTER (y_true = label) * (count(*) FILTER (y_true = label) + 1) / 2.0)
  / (count(*) FILTER (y_true = label) * count(*) FILTER (y_true <> label)) AS auc FROM ranked GROUP BY label)"""


@query("met_auc_per_class", f"{_AUC} SELECT label, round(auc, 6) AS auc FROM auc")
def met_auc_per_class(spark, sf_dir):
    return rounded(metrics.auc_per_class(scores(spark, sf_dir)), 6)


@query("met_roc_auc", f"{_AUC} SELECT round(avg(auc), 6) AS roc_auc FROM auc")
def met_roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scores(spark, sf_dir)), 6)


@query("met_roc_curve", f"""WITH {_SCORES}, g AS (
  SELECT label, score, count(*) FILTER (y_true = label) AS pos, count(*) FILTER (y_true <> label) AS neg FROM scores GROUP BY ALL)
SELECT label, CAST(score AS DOUBLE) AS threshold,
       round(sum(neg) OVER w / sum(neg) OVER (PARTITION BY label), 6) AS fpr,
       round(sum(pos) OVER w / sum(pos) OVER (PARTITION BY label), 6) AS tpr
FROM g WINDOW w AS (PARTITION BY label ORDER BY score DESC)
UNION ALL SELECT DISTINCT label, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM g""")
def met_roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(scores(spark, sf_dir)), 6)


@query("met_confusion", f"WITH {_PREDICTIONS} SELECT y_true, " + ", ".join(
    f"count(*) FILTER (y_pred = '{c}') AS \"{c}\"" for c in _CLASSES) + " FROM pred WHERE model = 'often' GROUP BY y_true")
def met_confusion(spark, sf_dir):
    return metrics.confusion_matrix(_often(spark, sf_dir))


@query("met_confusion_normalized", f"WITH {_PREDICTIONS} SELECT y_true, " + ", ".join(
    f"round(count(*) FILTER (y_pred = '{c}') / count(*), 6) AS \"{c}\"" for c in _CLASSES)
    + " FROM pred WHERE model = 'often' GROUP BY y_true")
def met_confusion_normalized(spark, sf_dir):
    return rounded(metrics.confusion_matrix(_often(spark, sf_dir), normalize=True), 6)


@query("mdl_errors", f"""WITH {_PREDICTIONS}{_PER_CLASS}, wrong AS (
  SELECT y_true || ' -> ' || y_pred AS name, count(*) AS n FROM pred WHERE model = 'often' AND y_true <> y_pred GROUP BY y_true, y_pred)
SELECT 'confusion_pairs' AS section, name, CAST(n AS DOUBLE) AS value FROM wrong
UNION ALL SELECT 'total_errors', 'rows', CAST(sum(n) AS DOUBLE) FROM wrong
UNION ALL SELECT 'per_class', label || '.precision', round("precision", 6) FROM pcm WHERE model = 'often'
UNION ALL SELECT 'per_class', label || '.recall', round(recall, 6) FROM pcm WHERE model = 'often'
UNION ALL SELECT 'per_class', label || '.f1', round(f1, 6) FROM pcm WHERE model = 'often'
UNION ALL SELECT 'per_class', label || '.support', CAST(support AS DOUBLE) FROM pcm WHERE model = 'often'""")
def mdl_errors(spark, sf_dir):
    return rounded(metrics.analyze_errors(_often(spark, sf_dir)), 6)


# Forecast of each month by the month before, per category.
_LAGGED = f"WITH {SALES}, {series_sql('M', 'category')}, fc AS (SELECT * FROM (SELECT series, period, value AS y, " \
    "lag(value) OVER (PARTITION BY series ORDER BY period) AS yhat FROM ts) WHERE yhat IS NOT NULL)"
_ERRORS = {
    "mae": "avg(abs(y - yhat))",
    "mse": "avg((y - yhat) * (y - yhat))",
    "rmse": "sqrt(avg((y - yhat) * (y - yhat)))",
    "mape": "avg(abs((y - yhat) / (y + 1e-8))) * 100",
    "smape": "avg(2 * abs(yhat - y) / (abs(y) + abs(yhat) + 1e-8)) * 100",
    "r2": "1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))",
}
# Squared errors of money are large: they are compared in millions.
_SHOWN = ", ".join(f"round({'1e-6 * ' if n == 'mse' else ''}{e}, 4) AS {n}" for n, e in _ERRORS.items())


def lagged_forecast(spark, sf_dir):
    from pyspark.sql import Window

    lines = sales_lines(spark, sf_dir, ["order_date", "sales", "category"])
    ts = resample(lines, "order_date", "sales", "M", series_col="category")
    before = F.lag("value").over(Window.partitionBy("series").orderBy("period"))
    return ts.select("series", "period", F.lit("last month").alias("model"), F.col("value").alias("y"), before.alias("yhat")).where(
        F.col("yhat").isNotNull())


def _shown(df):
    return rounded(df.withColumn("mse", F.col("mse") * 1e-6), 4)


@query("met_regression", f"{_LAGGED} SELECT series, {_SHOWN} FROM fc GROUP BY series")
def met_regression(spark, sf_dir):
    return _shown(metrics.regression_metrics(lagged_forecast(spark, sf_dir), ["series"]))


@query("met_forecast", f"""{_LAGGED}, d AS (SELECT *, CAST((y > lag(y) OVER w) = (yhat > lag(yhat) OVER w) AS INTEGER) AS agree
  FROM fc WINDOW w AS (PARTITION BY series ORDER BY period))
SELECT series, 'last month' AS model, {_SHOWN}, round(avg(agree), 4) AS direction_accuracy FROM d GROUP BY series""")
def met_forecast(spark, sf_dir):
    table_ = metrics.forecast_metrics(lagged_forecast(spark, sf_dir))
    return _shown(table_)


@query("met_residuals", f"{_LAGGED} SELECT series, period, model, y, yhat, residual FROM (SELECT series, period, "
       "'last month' AS model, round(y, 2) AS y, round(yhat, 2) AS yhat, round(y - yhat, 2) AS residual FROM fc)")
def met_residuals(spark, sf_dir):
    return rounded(metrics.residuals(lagged_forecast(spark, sf_dir)), 2)


@query("met_residual_histogram", f"""{_LAGGED}, r AS (SELECT y - yhat AS x FROM fc), ends AS (SELECT min(x) AS lo, max(x) AS hi FROM r),
counted AS (SELECT least(CAST(floor((x - lo) * 30 / (hi - lo)) AS INTEGER), 29) AS bin, count(*) AS n FROM r, ends GROUP BY ALL)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 30), 2) AS lower, round(lo + (b.bin + 1) * ((hi - lo) / 30), 2) AS upper, coalesce(n, 0) AS n
FROM (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin) b CROSS JOIN ends LEFT JOIN counted USING (bin)""")
def met_residual_histogram(spark, sf_dir):
    return rounded(profile.histogram(metrics.residuals(lagged_forecast(spark, sf_dir)), "residual", 30), 2)


_RESULTS_SQL = f"WITH {_PREDICTIONS}{_PER_CLASS}, {_MACRO}"


def _results(spark, sf_dir):
    table_ = metrics.classification_metrics(predictions(spark, sf_dir), "macro", ["model"])
    return table_.withColumn("metric", F.when(F.col("metric") == "f1_macro", "f1_score").otherwise(F.col("metric")))


@query("met_compare", f"{_RESULTS_SQL} SELECT model, round(accuracy, 6) AS accuracy, round(f, 6) AS f1_score FROM acc")
def met_compare(spark, sf_dir):
    return rounded(metrics.compare_models(_results(spark, sf_dir), ["accuracy", "f1_score"]), 6)


@query("met_summary_text", f"""{_RESULTS_SQL}, long AS (
  SELECT model, 'accuracy' AS metric, accuracy AS value FROM acc UNION ALL SELECT model, 'precision_macro', p FROM acc
  UNION ALL SELECT model, 'recall_macro', r FROM acc UNION ALL SELECT model, 'f1_score', f FROM acc
  UNION ALL SELECT model, 'f1_weighted', wf FROM acc)
SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY metric) AS INTEGER) AS seq, printf('%s: %.4f', metric, value) AS text FROM long""")
def met_summary_text(spark, sf_dir):
    return metrics.summary_text(_results(spark, sf_dir))


@query("rep_model_comparison", f"""{_RESULTS_SQL}
SELECT model, round(accuracy, 6) AS accuracy, round(f, 6) AS f1_score, model = (SELECT max_by(model, f) FROM acc) AS best FROM acc""")
def rep_model_comparison(spark, sf_dir):
    return rounded(metrics.model_comparison_report(_results(spark, sf_dir), ["accuracy", "f1_score"]), 6)
