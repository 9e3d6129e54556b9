"""Classification queries: the RFM segment predicted from recency, frequency, money and profit."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.storage import cut, scratch_path
from shelfwise.operators import classify, cluster
from shelfwise.operators.encode import scale
from shelfwise.operators.features import classification_features
from shelfwise.plans.clusters import RAW, X
from shelfwise.plans.common import RFM, rfm_table, rounded
from shelfwise.plans.registry import query

FEATURES = ["recency", "frequency", "monetary", "total_profit", "avg_profit", "avg_order_value"]


SEVEN = ["recency", "frequency", "monetary", "total_profit", "avg_profit", "avg_order_value", "profit_margin"]
LETTERS, ROUNDS = 4, 12


def lettered_customers(spark, sf_dir):
    """Customers with seven features and the letter of their k-means cluster of scaled recency, frequency and money."""
    points = cut(scale(classification_features(rfm_table(spark, sf_dir)), RAW, "standard").select("customer_id", *SEVEN, *X))
    clustered, _ = cluster.lloyd(points, X, cluster.quantile_start(points, X, LETTERS), ROUNDS)
    return clustered.withColumn("segment", cluster.segment_letters(F.col("cluster")))


def _letters_sql():
    """Lloyd's rounds one after the other, centres in ``c0``, ``c1``, ...; a cluster's number is the rank of its centre."""
    gap = "(x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz)"
    shares = [(i + 0.5) / LETTERS for i in range(LETTERS)]
    first = " UNION ALL ".join(f"SELECT {i} AS k, quantile_cont(x, {s}) AS cx, quantile_cont(y, {s}) AS cy, quantile_cont(z, {s}) AS cz FROM pts"
                               for i, s in enumerate(shares))
    steps = [f"c0 AS MATERIALIZED ({first})"]
    for i in range(ROUNDS):
        steps += [
            f"a{i} AS MATERIALIZED (SELECT id, any_value(x) AS x, any_value(y) AS y, any_value(z) AS z, arg_min(k, {{'d': {gap}, 'k': k}}) AS k FROM pts, c{i} GROUP BY id)",
            f"""c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.cx, c.cx) AS cx, coalesce(m.cy, c.cy) AS cy, coalesce(m.cz, c.cz) AS cz
  FROM c{i} c LEFT JOIN (SELECT k, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM a{i} GROUP BY k) m ON m.k = c.k)"""]
    return f"""st AS (SELECT avg(recency) AS mr, stddev_pop(recency) AS sr, avg(frequency) AS mf, stddev_pop(frequency) AS sf,
  avg(monetary) AS mm, stddev_pop(monetary) AS sm FROM rfm),
pts AS MATERIALIZED (SELECT customer_id AS id, (recency - mr) / sr AS x, (frequency - mf) / sf AS y, (monetary - mm) / sm AS z FROM rfm, st),
{', '.join(steps)}, cen AS (SELECT row_number() OVER (ORDER BY cx, cy, cz) - 1 AS k, cx, cy, cz FROM c{ROUNDS}),
named AS (SELECT id, arg_min(k, {{'d': {gap}, 'k': k}}) AS k FROM pts, cen GROUP BY id)"""


@query("mdl_segment_letters", f"""WITH {RFM}, {_letters_sql()}
SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, round(total_profit, 4) AS total_profit,
  round(total_profit / frequency, 4) AS avg_profit, round(monetary / frequency, 4) AS avg_order_value,
  round(total_profit / monetary, 4) AS profit_margin, 'Segment ' || chr(CAST(65 + k AS INTEGER)) AS segment
FROM rfm JOIN named ON id = customer_id""")
def mdl_segment_letters(spark, sf_dir):
    return rounded(lettered_customers(spark, sf_dir).select("customer_id", *SEVEN, "segment"))


@query("mdl_letter_models")
def mdl_letter_models(spark, sf_dir):
    table = lettered_customers(spark, sf_dir).select("customer_id", "segment", *SEVEN)
    rows = cut(classify.stratified_split(table, "customer_id", "segment"))
    return reduce(DataFrame.unionByName, classify.side_by_side(spark, lambda name: _scored(rows, _train(rows, name, SEVEN)), classify.MODELS))


def split_customers(spark, sf_dir):
    table = classification_features(rfm_table(spark, sf_dir)).select("customer_id", "segment", *FEATURES)
    return cut(classify.stratified_split(table, "customer_id", "segment"))


def _train(rows, name, features=FEATURES):
    return classify.train(rows.where("part = 'train'"), features, "segment", name)


def _scored(rows, fitted):
    predictions = fitted.predict(rows.where("part = 'test'"), "customer_id", "segment")
    return classify.evaluate(cut(predictions), fitted.name)


def _validated(rows):
    """Mean and deviation of the folds' F1 of every model, over the training rows."""
    known = rows.where("part = 'train'")
    validated = lambda name: classify.cross_validate(known, "customer_id", FEATURES, "segment", name)
    folds = classify.side_by_side(rows.sparkSession, validated, classify.MODELS)
    return classify.cv_summary(reduce(DataFrame.unionByName, folds))


@query("mdl_stratified_split", f"""WITH {RFM}
SELECT customer_id, segment, CASE WHEN row_number() OVER (PARTITION BY segment ORDER BY md5('42' || customer_id), customer_id)
  <= floor(count(*) OVER (PARTITION BY segment) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM rfm""")
def mdl_stratified_split(spark, sf_dir):
    return split_customers(spark, sf_dir).select("customer_id", "segment", "part")


@query("mdl_stratified_folds", f"""WITH {RFM}
SELECT customer_id, segment, CAST((row_number() OVER (PARTITION BY segment ORDER BY md5('42' || customer_id), customer_id) - 1) % 5
  AS INTEGER) AS fold FROM rfm""")
def mdl_stratified_folds(spark, sf_dir):
    return classify.stratified_folds(rfm_table(spark, sf_dir).select("customer_id", "segment"), "customer_id", "segment")


@query("mdl_logreg")
def mdl_logreg(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    return _scored(rows, _train(rows, "LogisticRegression"))


@query("mdl_tree")
def mdl_tree(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    return _scored(rows, _train(rows, "DecisionTree"))


@query("mdl_forest")
def mdl_forest(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    return _scored(rows, _train(rows, "RandomForest"))


@query("mdl_cv")
def mdl_cv(spark, sf_dir):
    return _validated(split_customers(spark, sf_dir))


@query("mdl_importance")
def mdl_importance(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    weighed = lambda name: classify.feature_importance(_train(rows, name), spark, 15).withColumn("model", F.lit(name))
    return reduce(DataFrame.unionByName, classify.side_by_side(spark, weighed, classify.MODELS))


@query("mdl_compare")
def mdl_compare(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    scored = classify.side_by_side(spark, lambda name: _scored(rows, _train(rows, name)), classify.MODELS)
    return classify.compare_models(reduce(DataFrame.unionByName, scored, _validated(rows)))


@query("mdl_save_load")
def mdl_save_load(spark, sf_dir):
    rows = split_customers(spark, sf_dir)
    path = scratch_path(spark, "model")
    _train(rows, "DecisionTree").save(path)
    loaded = classify.Fitted.load(path)
    return loaded.predict(rows.where("part = 'test'"), "customer_id", "segment").select("key", "y_true", "y_pred")
