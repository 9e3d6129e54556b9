"""Small cases with answers known by hand."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.lookup import modes
from shelfwise.functions.quantiles import bin_by_edges, exact_quantiles
from shelfwise.operators import basket, clean, encode, features, forecast, metrics, profile, report, timeseries
from shelfwise.sources import files


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("values", [list(range(237)), [1] * 40 + [2] * 3 + list(range(30)), [5, 5, 5, 5], [3]])
def test_quantile_bins_equal_qcut(spark, values):
    df = frame(spark, [(i, float(v)) for i, v in enumerate(values)], "id int, x double")
    edges = exact_quantiles(df, ["x"], [0, 0.2, 0.4, 0.6, 0.8, 1])["x"]
    got = [r["b"] for r in df.select("id", bin_by_edges(F.col("x"), edges).alias("b")).orderBy("id").collect()]
    codes = pd.qcut(pd.Series(values, dtype=float), 5, labels=False, duplicates="drop")
    assert got == [1 if np.isnan(c) else int(c) + 1 for c in codes]  # a constant column has no bins there


@pytest.mark.parametrize("n", [1, 2, 7, 237])
def test_rank_score_equals_qcut_of_ranks(spark, n):
    rng = np.random.default_rng(n)
    values = rng.integers(1, 6, n)
    df = frame(spark, [(i, int(v)) for i, v in enumerate(values)], "id int, f int")
    got = [r["s"] for r in features.rank_score(df, ["f", "id"], 5, "s").orderBy("id").collect()]
    if n == 1:
        assert got == [1]
    else:
        codes = pd.qcut(pd.Series(values).rank(method="first"), 5, labels=False, duplicates="drop")
        assert got == [int(c) + 1 for c in codes]


@pytest.mark.parametrize("keep, want", [("first", [1, 3, 4]), ("last", [2, 3, 5]), (False, [3])])
def test_dedup_treats_nulls_as_equal(spark, keep, want):
    df = frame(spark, [(1, "a", None), (2, "a", None), (3, "a", 1), (4, None, 1), (5, None, 1)], "id int, a string, b int")
    got = clean.drop_duplicates(df, ["a", "b"], keep, ["id"])
    assert sorted(r["id"] for r in got.collect()) == want
    removed = clean.duplicates_removed(df, ["a", "b"], keep).first()[0]
    assert removed == 5 - len(want)


def test_dedup_of_whole_rows(spark):
    df = frame(spark, [(1, None), (1, None), (2, "x")], "a int, b string")
    assert clean.drop_duplicates(df).count() == 2
    assert clean.drop_duplicates(df, keep=False).count() == 1


def test_iqr_methods_and_nulls(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = frame(spark, [(i, v) for i, v in enumerate(values)], "id int, x double")
    low, high = 2 - 1.5 * 2, 4 + 1.5 * 2
    column = lambda d: [r["x"] for r in d.orderBy("id").collect()]
    clipped = clean.outliers_iqr(df, ["x", "absent"])
    assert column(clipped) == [1.0, 2.0, 3.0, 4.0, high, None]
    assert all(v is None or low <= v <= high for v in column(clipped))
    assert column(clean.outliers_iqr(df, ["x"], method="NaN")) == [1.0, 2.0, 3.0, 4.0, None, None]
    assert column(clean.outliers_iqr(df, ["x"], method="remove")) == [1.0, 2.0, 3.0, 4.0]
    assert clean.iqr_outlier_counts(df, ["x"]).first()["outliers"] == 1
    assert clean.iqr_outlier_counts(df, ["x"], method="remove").first()["outliers"] == 2  # the null row goes too


def test_zscore_of_constant_column_flags_nothing(spark):
    df = frame(spark, [(i, 4.0) for i in range(5)], "id int, x double")
    assert clean.outliers_zscore(df, ["x"], method="remove").count() == 5
    assert clean.zscore_outlier_counts(df, ["x"]).first()["outliers"] == 0


def test_missing_values(spark):
    rows = [(1, 10, "a", None), (2, None, None, None), (3, 20, "b", 1), (4, 20, "b", 1), (5, 30, "a", None)]
    df = frame(spark, rows, "id int, n int, s string, sparse int")
    filled = clean.handle_missing(df)
    assert filled.columns == ["id", "n", "s"]
    row = filled.where("id = 2").first()
    assert (row["n"], row["s"]) == (20.0, "a")  # 'a' and 'b' tie: the smaller wins
    assert clean.handle_missing(df, "mean").where("id = 2").first()["n"] == 20.0
    assert clean.handle_missing(df, "mode", "constant").where("id = 2").first()["s"] == "Unknown"


def test_scalers_on_constant_and_known_columns(spark):
    df = frame(spark, [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    for method in ("standard", "minmax", "robust"):
        assert {r["c_scaled"] for r in encode.scale(df, ["c"], method).collect()} == {0.0}
    spread = np.std([1, 2, 4])
    got = [r["x_scaled"] for r in encode.scale(df, ["x"]).orderBy("x").collect()]
    assert got == pytest.approx([(v - 7 / 3) / spread for v in (1, 2, 4)])
    with pytest.raises(ValueError):
        encode.scale(df, ["x"], "unknown")


def test_encoders(spark):
    df = frame(spark, [(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, s string")
    coded = encode.encode_categorical(df, ["s"], "label", ["id"]).orderBy("id").collect()
    assert [r["s_encoded"] for r in coded] == [0, 1, -1, 0]
    hot = encode.encode_categorical(df, ["s"], "onehot").orderBy("id")
    assert hot.columns == ["id", "s", "s_b"] and [r["s_b"] for r in hot.collect()] == [True, False, False, True]
    shares = [r["s_freq"] for r in encode.encode_frequency(df, ["s"]).orderBy("id").collect()]
    assert shares == [pytest.approx(2 / 3), pytest.approx(1 / 3), None, pytest.approx(2 / 3)]
    with pytest.raises(ValueError):
        encode.encode_categorical(df, ["s"], "ordinal")


def test_long_forms_agree_with_the_wide_ones(spark):
    df = frame(spark, [(1, "b", 5), (2, "a", 6), (3, None, 5), (4, "c", 7)], "id int, s string, n int")
    wide = encode.encode_onehot(df, ["s", "n"]).collect()
    flags = {(r["id"], c, v) for r in wide for c, v in (("s", "b"), ("s", "c"), ("n", "6"), ("n", "7")) if r[f"{c}_{v}"]}
    assert {tuple(r) for r in encode.onehot_flags(df, ["id"], ["s", "n"]).collect()} == flags
    assert encode.encode_onehot(df, ["s"], {"s": ["a", "b", "c"]}).columns == ["id", "s", "n", "s_b", "s_c"]
    many = frame(spark, [(i, f"v{i:05d}") for i in range(5001)], "id int, s string")
    assert encode.onehot_flags(many, ["id"], ["s"]).count() == 5000
    baskets = frame(spark, [(1, ["a", "b"]), (2, ["b"])], "order_id int, items array<string>")
    cells = {(r["order_id"], i) for r in basket.transaction_matrix(baskets).collect() for i in ("a", "b") if r[i]}
    assert {tuple(r) for r in basket.transaction_items(baskets).collect()} == cells


def test_dates_from_text(spark):
    df = frame(spark, [("2024-03-02",), ("no date",)], "d string")
    good, bad = encode.process_dates(df, ["d"]).orderBy(F.col("d").asc_nulls_last()).collect()
    assert (good["d_year"], good["d_quarter"], good["d_dayofweek"], good["d_is_weekend"]) == (2024, 1, 5, 1)
    assert bad["d"] is None and bad["d_month"] is None and bad["d_is_weekend"] == 0


def test_segment_rules(spark):
    cases = {
        (4, 4, 4): "Champions", (1, 5, 1): "Loyal Customers", (3, 3, 1): "Potential Loyalists", (2, 3, 5): "At Risk",
        (1, 2, 5): "Lost", (5, 1, 1): "New Customers", (3, 2, 1): "Promising",
    }
    df = frame(spark, list(cases), "r int, f int, m int")
    got = {tuple(r)[:3]: r["s"] for r in df.withColumn("s", features.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()}
    assert got == cases


def test_recency_counts_whole_days_from_a_reference(spark):
    rows = [(1, 1, datetime.datetime(2024, 1, 1, 12), 1.0), (2, 2, datetime.datetime(2024, 1, 5, 6), 1.0)]
    df = frame(spark, rows, "customer_id int, order_id int, order_date timestamp_ntz, sales double")
    df = df.withColumns({"profit": F.lit(0.0), "quantity": F.lit(1.0)})
    days = {r["customer_id"]: r["recency"] for r in features.rfm_base(df).collect()}
    assert days == {1: 4, 2: 1}
    days = {r["customer_id"]: r["recency"] for r in features.rfm_base(df, "2024-01-06").collect()}
    assert days == {1: 4, 2: 0}


@pytest.mark.parametrize("day, label", [("2024-01-07", "2024-01-07"), ("2024-01-08", "2024-01-14"), ("2024-01-10", "2024-01-14")])
def test_weeks_end_on_sunday(spark, day, label):
    assert str(spark.range(1).select(timeseries.period_label(F.lit(day).cast("date"), "W")).first()[0]) == label


def test_zero_runs_collapse_to_their_first_period(spark):
    days = [("2024-01-01", 57.0), ("2024-01-02", 67.0), ("2024-01-05", 4.0)]
    df = frame(spark, days, "d string, v double").withColumn("d", F.to_date("d"))
    got = [r["value"] for r in timeseries.prepare_time_series(df, "d", "v", freq="D").orderBy("period").collect()]
    assert got == [57.0, 67.0, 0.0, 4.0]
    with pytest.raises(ValueError):
        timeseries.prepare_time_series(df, "d", "v", "product", freq="D")


def _series(spark, values, name="s"):
    start = datetime.date(2020, 1, 1)
    return frame(
        spark, [(name, start + datetime.timedelta(days=i), float(v)) for i, v in enumerate(values)],
        "series string, period date, value double")


def test_split_and_baselines(spark):
    parts = timeseries.split(_series(spark, range(1, 11)), 3)
    assert timeseries.test_part(parts).count() == 3
    assert timeseries.split(_series(spark, range(1, 11)), 0).where("part = 'test'").count() == 0
    assert timeseries.split(_series(spark, range(1, 11))).where("part = 'test'").count() == 2
    assert {r["yhat"] for r in timeseries.naive(parts).collect()} == {7.0}
    assert {r["yhat"] for r in timeseries.moving_average(parts, 4).collect()} == {5.5}


def test_models_follow_an_obvious_series(spark):
    season = [10, 20, 30, 40, 30, 20, 10, 5, 0, 5, 10, 15]
    values = [100 + 2 * i + season[i % 12] for i in range(72)]
    parts = timeseries.split(_series(spark, values), 12)
    error = lambda table: metrics.regression_metrics(table).first()["mae"]
    naive = error(timeseries.naive(parts))
    assert error(forecast.holt_winters(parts)) < naive / 2
    assert error(forecast.holt_winters(parts, "mul")) < naive
    steps = timeseries.split(_series(spark, [3.0 * i for i in range(60)]), 6)
    assert error(forecast.arima(steps, (1, 1, 0))) < 1e-6
    year = [50 * np.sin(2 * np.pi * i / 365.25) + 0.1 * i for i in range(1000)]
    assert error(forecast.fourier(timeseries.split(_series(spark, year), 50))) < 1.0
    short = timeseries.split(_series(spark, values[:20]), 2)
    unfitted = forecast.holt_winters(short)  # under two seasons
    assert [r["yhat"] for r in unfitted.collect()] == [None, None]
    for n, fits in ((13, False), (14, True)):  # twelve training values are needed
        table = forecast.arima(timeseries.split(_series(spark, values[:n]), 2), (1, 1, 1))
        assert [r["yhat"] is not None for r in table.collect()] == [fits, fits]
    errors = timeseries.with_errors(metrics.forecast_metrics(timeseries.naive(short).unionByName(unfitted))).collect()
    assert {r["model"]: r["error"] is not None for r in errors} == {"Naive": False, "HoltWinters": True}


def test_large_whole_numbers_stay_apart(spark):
    table = spark.createDataFrame([(2**53,), (2**53 + 1,), (2**53 + 1,)], "n long")
    info = profile.column_info(table).first()
    assert info["distinct_values"] == 2 and info["sample_values"] == "9007199254740992, 9007199254740993"
    assert modes(table, ["n"]) == {"n": 2**53 + 1}


def test_autocorrelation_against_definition(spark):
    rng = np.random.default_rng(1)
    r = rng.normal(size=30)
    table = _series(spark, r).select("series", "period", F.lit("m").alias("model"), F.col("value").alias("y"), F.lit(0.0).alias("yhat"))
    got = timeseries.autocorrelation(table, 5).orderBy("lag").collect()
    d = r - r.mean()
    acf = [1.0] + [float((d[k:] * d[:-k]).sum() / (d * d).sum()) for k in range(1, 6)]
    assert [g["acf"] for g in got] == pytest.approx(acf)
    for k in range(1, 6):  # the last coefficient of the Yule-Walker equations of order k
        matrix = [[acf[abs(i - j)] for j in range(k)] for i in range(k)]
        assert got[k]["pacf"] == pytest.approx(np.linalg.solve(matrix, acf[1 : k + 1])[-1])


def test_rules_have_two_item_consequents(spark):
    rows = [(i, list(b), len(b)) for i, b in enumerate(["abc"] * 6 + ["ab"] * 2 + ["c"] * 1 + ["d"] * 3)]
    df = frame(spark, rows, "order_id int, items array<string>, item_count int")
    itemsets, total = basket.frequent_itemsets(df, 0.3)
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r for r in basket.association_rules(itemsets, 0.5, 0.0).collect()}
    rule = rules[("a",), ("b", "c")]
    assert rule["confidence"] == pytest.approx(6 / 8) and rule["lift"] == pytest.approx(6 / 8 / (6 / 12))
    sure = rules[("a", "c"), ("b",)]
    assert sure["confidence"] == 1.0 and sure["conviction"] == float("inf")
    lifts = {k: r["lift"] for k, r in rules.items()}
    assert lifts[("a",), ("b",)] == pytest.approx(lifts[("b",), ("a",)])
    none, _ = basket.frequent_itemsets(df, 0.99)
    empty = basket.association_rules(none)
    assert empty.count() == 0
    assert [r["text"] for r in basket.rule_insights(empty).collect()] == ["No rule passed the thresholds."]


def _predictions(spark, truth, predicted):
    return frame(spark, list(zip(truth, predicted)), "y_true string, y_pred string")


def test_classification_scores_by_hand(spark):
    df = _predictions(spark, "012012", "022011")
    scores = {r["metric"]: r["value"] for r in metrics.classification_metrics(df).collect()}
    assert scores["accuracy"] == pytest.approx(4 / 6)
    per = {r["label"]: (r["precision"], r["recall"], r["f1"]) for r in metrics.per_class(df).collect()}
    assert per == {"0": (1.0, 1.0, 1.0), "1": (0.5, 0.5, 0.5), "2": (0.5, 0.5, 0.5)}


def test_macro_f1_counts_classes_only_predicted_or_never_predicted(spark):
    df = _predictions(spark, "aaab", "aacc")  # b is never predicted, c never true
    scores = {r["metric"]: r["value"] for r in metrics.classification_metrics(df).collect()}
    assert scores["f1_macro"] == pytest.approx((2 * 2 / 5 + 0 + 0) / 3)
    matrix = {r["y_true"]: (r["a"], r["b"], r["c"]) for r in metrics.confusion_matrix(df).collect()}
    assert matrix == {"a": (2, 0, 1), "b": (0, 0, 1), "c": (0, 0, 0)}
    assert metrics.confusion_matrix(df, True).where("y_true = 'c'").first()["a"] is None


def test_auc_is_null_when_a_class_is_missing(spark):
    df = frame(spark, [("a", {"a": 0.9, "b": 0.1}), ("a", {"a": 0.8, "b": 0.2})], "y_true string, proba map<string,double>")
    assert metrics.roc_auc(df).first()["roc_auc"] is None


def test_regression_scores_by_hand(spark):
    df = frame(spark, list(zip([1.0, 2.0, 3.0, 4.0, 5.0], [1.1, 2.2, 2.9, 4.1, 4.8])), "y double, yhat double")
    row = metrics.regression_metrics(df).first()
    assert (row["mae"], row["mse"], row["r2"]) == (pytest.approx(0.14), pytest.approx(0.022), pytest.approx(0.989))


def test_model_report_falls_back_to_mae(spark):
    df = frame(spark, [("x", "mae", 3.0), ("y", "mae", 2.0), ("y", "rmse", 9.0)], "model string, metric string, value double")
    rows = metrics.model_comparison_report(df, ["mae", "rmse"]).collect()
    assert [(r["model"], r["best"]) for r in rows] == [("y", True), ("x", False)]


def test_insight_shares(spark):
    counts = {"Champions": 120, "Loyal Customers": 200, "Potential Loyalists": 180, "At Risk": 150, "Lost": 80, "New Customers": 100, "Promising": 170}
    df = frame(spark, [(s,) for s, n in counts.items() for _ in range(n)], "segment string")
    texts = [r["text"] for r in report.actionable_insights(df).collect()]
    assert texts[0].startswith("Champions: 12.0% of customers") and texts[1].startswith("At Risk: 15.0%")
    assert len(texts) == 3 + 3


def test_inspect_counts_repeated_rows(spark):
    df = frame(spark, [(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert profile.duplicate_rows(df).first()[0] == 2
    info = {r["column"]: r for r in profile.column_info(df).collect()}
    assert (info["b"]["nulls"], info["b"]["distinct_values"], info["b"]["sample_values"]) == (3, 1, "x")


def test_histogram_of_a_constant_column(spark):
    got = profile.histogram(frame(spark, [(5.0,), (5.0,), (None,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [(r["lower"], r["n"]) for r in got] == [(4.5, 0), (4.75, 0), (5.0, 2), (5.25, 0)]


def test_csv_json_and_text_files(spark, tmp_path):
    df = frame(spark, [(1, ["a", "b"]), (2, ["c"])], "id int, items array<string>").coalesce(1)
    files.save_csv(df, f"{tmp_path}/raw/sales.csv")
    back = files.load_csv(spark, f"{tmp_path}/raw", "sales.csv", "id int, items string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a, b"), (2, "c")]
    inferred = files.load_csv(spark, f"{tmp_path}/raw/sales.csv", "missing.csv")  # first csv of the folder
    assert dict(inferred.dtypes)["id"] == "int" and inferred.count() > 0
    with pytest.raises(ValueError):
        files.load_csv(spark, str(tmp_path), "sales.xlsx")
    files.save_report(df, f"{tmp_path}/report.csv")
    assert spark.read.json(f"{tmp_path}/report.json").count() == 2
    notes = frame(spark, [(1, "k", "first"), (2, "k", "second")], "seq int, kind string, text string")
    files.save_insights(report.add_insight(notes, "k", "third"), f"{tmp_path}/insights")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/insights").collect()] == ["1. first", "2. second", "3. third"]


def test_zscore_removal_plan_grows_linearly(spark):
    rows = [(float(i % 7), float(i % 5), float(i % 3)) for i in range(60)] + [(500.0, 1.0, 1.0), (1.0, 900.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    for columns, left in ((["a"], 61), (["a", "b"], 60), (["a", "b", "c"], 60)):
        kept = clean.outliers_zscore(df, columns, method="remove")
        assert kept.count() == left
        assert kept._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_report_path_keeps_its_folders(spark, tmp_path):
    from shelfwise.sources.files import save_report

    save_report(spark.range(3), str(tmp_path / "a.csv.d" / "out.csv"))
    assert spark.read.json(str(tmp_path / "a.csv.d" / "out.json")).count() == 3


def test_amounts_do_not_depend_on_the_order_of_lines(spark):
    # Plain sums lose much of the 0.1 of every line against the large amounts.
    rows = [(i // 7, i % 3, 4e15 if i == 0 else 0.1, -0.75) for i in range(4000)]
    lines = frame(spark, rows, "order_id int, customer_id int, sales double, profit double")
    row = profile.summary_stats(lines.coalesce(1)).first()
    assert row["total_sales"] == 4e15 + 399.9 and row["total_profit"] == -3000.0
    odd = frame(spark, [(1, 1, float("inf"), None), (2, 1, 2.5, None)], "order_id int, customer_id int, sales double, profit double")
    row = profile.summary_stats(odd).first()
    assert row["total_sales"] == float("inf") and row["total_profit"] == 0.0


def test_insight_query_has_no_line_without_rules(spark, monkeypatch):
    from shelfwise.plans import basket as plan

    monkeypatch.setattr(plan, "SUPPORT", 0.99)
    assert plan.asc_insights(spark, "/root/testdata/sf0.001").collect() == []
