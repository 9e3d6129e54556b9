"""The paths for oversized groups, forced by tiny limits, against pandas.

One key holds a third of the rows or more.
"""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.ordered import row_numbers, running_totals
from shelfwise.functions.quantiles import exact_quantiles, grouped_medians
from shelfwise.operators import basket, clean, features, metrics


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(7)
    n = 3000
    customer = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 60, n))
    pdf = pd.DataFrame({
        "row_id": np.arange(n),
        "customer_id": customer,
        "order_date": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 90, n), unit="D"),
        "sales": rng.integers(1, 500, n) / 4.0,
    })
    return spark.createDataFrame(pdf).repartition(5), pdf


def test_row_numbers_over_slices(lines):
    df, pdf = lines
    got = row_numbers(df, ["customer_id"], ["sales", "row_id"], "place", hot_rows=100).toPandas()
    want = pdf.sort_values(["sales", "row_id"])
    want["place"] = want.groupby("customer_id").cumcount() + 1
    merged = got.merge(want[["row_id", "place"]], on="row_id")
    assert len(got) == len(pdf) and (merged["place_x"] == merged["place_y"]).all()


def test_global_running_total_over_slices_descending(lines):
    df, pdf = lines
    got = running_totals(df, [], [F.desc("sales"), "row_id"], {"upto": F.col("sales")}, hot_rows=50).toPandas()
    want = pdf.sort_values(["sales", "row_id"], ascending=[False, True])
    want["upto"] = want["sales"].cumsum()
    merged = got.merge(want[["row_id", "upto"]], on="row_id")
    assert np.allclose(merged["upto_x"], merged["upto_y"])


@pytest.mark.parametrize("hot_rows", [60, 10_000])
def test_lag_features_of_a_hot_customer(lines, hot_rows):
    df, pdf = lines
    got = features.lag_features(df, order=["row_id"], hot_rows=hot_rows).toPandas().sort_values("row_id").reset_index(drop=True)
    want = pdf.sort_values(["customer_id", "order_date", "row_id"])
    groups = want.groupby("customer_id")["sales"]
    for k in (1, 3, 6, 12):
        want[f"sales_lag_{k}"] = groups.shift(k)
    for k in (3, 6):
        want[f"sales_rolling_mean_{k}"] = groups.transform(lambda x: x.rolling(k, min_periods=1).mean())
    want["sales_diff"] = groups.diff()
    want = want.sort_values("row_id").reset_index(drop=True)
    assert len(got) == len(want) and list(got.columns) == list(want.columns)
    for c in want.columns[4:]:
        assert np.allclose(got[c], want[c], equal_nan=True), c


@pytest.mark.parametrize("small, error", [(10**9, 1e-3), (800, 1e-2), (40, 0.03)])
def test_exact_quantiles_by_narrowing(lines, spark, small, error):
    df, pdf = lines
    mixed = df.withColumn("hot", F.when(F.col("row_id") % 3 == 0, 5.0).otherwise(F.col("sales")))
    mixed = mixed.withColumn("gaps", F.when(F.col("row_id") % 7 > 0, F.col("sales"))).withColumn("none", F.lit(None).cast("double"))
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(mixed, ["sales", "hot", "gaps", "none"], points, small=small, rank_error=error)
    table = mixed.select("sales", "hot", "gaps").toPandas()
    for c in ("sales", "hot", "gaps"):
        assert np.allclose(got[c], table[c].dropna().quantile(points)), c
    assert got["none"] == [None] * len(points)


def test_grouped_medians(lines):
    df, pdf = lines
    got = grouped_medians(df, ["customer_id"], "sales", "m").toPandas().set_index("customer_id")["m"]
    want = pdf.groupby("customer_id")["sales"].median()
    assert np.allclose(got.sort_index(), want.sort_index())


def test_auc_over_slices_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    truth = rng.choice(["a", "b", "c"], 400, p=[0.6, 0.3, 0.1])
    rows = [(t, {c: float(rng.integers(0, 25) + 5 * (c == t)) for c in "abc"}) for t in truth]
    df = spark.createDataFrame(rows, "y_true string, proba map<string,double>")
    got = {r["label"]: r["auc"] for r in metrics.auc_per_class(df, hot_rows=10).collect()}
    for c in "abc":
        pos = np.array([p[c] for t, p in rows if t == c])[:, None]
        neg = np.array([p[c] for t, p in rows if t != c])[None, :]
        assert got[c] == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean())


def test_dedup_keeps_whole_result_for_a_hot_key(lines):
    df, pdf = lines
    got = clean.drop_duplicates(df, ["customer_id"], "last", ["order_date", "row_id"]).toPandas()
    want = pdf.sort_values(["order_date", "row_id"]).drop_duplicates("customer_id", keep="last")
    assert sorted(got["row_id"]) == sorted(want["row_id"])


def test_basket_of_a_hot_order(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 9 + 2).alias("order_id"),
        F.concat(F.lit("i"), (F.col("id") % 6).cast("string")).alias("sub_category"), F.lit(1.0).alias("sales"))
    hot = basket.baskets(df).where("order_id = 1").first()
    assert hot["items"] == [f"i{k}" for k in range(6)] and hot["item_count"] == 6


def windows_over(plan):
    """The keys of every window in a plan, as text."""
    return [line.split("Window [", 1)[1] for line in plan.splitlines() if "Window [" in line]


def test_only_the_hot_group_is_sliced(lines, monkeypatch):
    df, pdf = lines
    ranged = []
    from shelfwise.functions import ordered

    sliced = ordered._sliced_totals
    monkeypatch.setattr(ordered, "_sliced_totals", lambda rows, *a: ranged.append(rows) or sliced(rows, *a))
    plain = features.lag_features(df, order=["row_id"], hot_rows=10_000)
    assert not ranged
    split = features.lag_features(df, order=["row_id"], hot_rows=200)
    hot = {r["customer_id"]: r["count"] for r in ranged[0].groupBy("customer_id").count().collect()}
    sizes = {r["customer_id"]: r["count"] for r in df.groupBy("customer_id").count().collect()}
    assert hot == {1: sizes[1]} and len(sizes) > 50
    plan = split._jdf.queryExecution().toString()
    assert any("_chunk" in w for w in windows_over(plan)) and any("_chunk" not in w for w in windows_over(plan))
    assert split.columns == plain.columns
    key = lambda r: r["row_id"]
    for a, b in zip(sorted(plain.collect(), key=key), sorted(split.collect(), key=key)):
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b) if not (x is None and y is None))


def test_slices_are_bounded(monkeypatch):
    from shelfwise.functions import ordered

    assert ordered._slices(10**12, 500_000) == ordered.MAX_SLICES
    assert ordered._slices(10, 3) == 4 and ordered._slices(0, 0) == 1


def test_running_totals_with_hot_and_null_keys(lines):
    df, pdf = lines
    df = df.withColumn("customer_id", F.when(F.col("customer_id") % 2 == 0, None).otherwise(F.col("customer_id")))
    got = row_numbers(df, ["customer_id"], ["sales", "row_id"], "place", hot_rows=150).toPandas()
    want = df.toPandas().sort_values(["sales", "row_id"])
    want["place"] = want.groupby("customer_id", dropna=False).cumcount() + 1
    merged = got.merge(want[["row_id", "place"]], on="row_id")
    assert len(merged) == len(pdf) and (merged["place_x"] == merged["place_y"]).all()
