"""What moves: queries with several passes join the lines once; products are added up without widening the lines."""

import pytest

import __spark_entry__ as entry
from shelfwise.operators import clean, features, profile
from shelfwise.plans.common import sales_with_gaps
from shelfwise.sources.tables import ROW_KEY
from test_scans import SF_DIR, line_scans


@pytest.mark.parametrize("name", [
    "cln_fill_categorical", "cln_drop_sparse_columns", "cln_fill_numeric_median", "cln_fill_numeric_mode", "enc_label", "enc_onehot"])
def test_several_passes_join_the_lines_once(spark, name):
    assert line_scans(spark, lambda: entry.queries()[name](spark, SF_DIR).collect()) == 1


def test_products_with_orders_of_several_customers_and_gaps(spark):
    rows = [
        (1, "a", 10, 7, 2.0, 1.0, 3.0, 0.5), (1, "a", 10, 8, 4.0, None, 1.0, 0.1), (1, "a", 10, 9, 6.0, 2.0, 1.0, None),
        (1, "a", 11, 7, 8.0, 1.0, 1.0, 0.0), (1, "a", 12, None, None, 1.0, 1.0, 0.0), (1, "a", None, 6, 1.0, 1.0, 1.0, 0.0),
        (1, "a", None, None, 1.0, 1.0, 1.0, 0.0), (1, "b", 10, 7, 1.0, 1.0, 1.0, 0.0), (2, "c", 13, None, None, None, None, None),
        (None, "a", 10, 7, 1.0, 1.0, 1.0, 0.0), (1, None, 10, 7, 1.0, 1.0, 1.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "product_id long, product_name string, order_id long, customer_id long, sales double, "
                                     "profit double, quantity double, discount double").repartition(3)
    table = features.product_features(df)
    assert "Expand" not in table._jdf.queryExecution().executedPlan().toString()
    got = {(r["product_id"], r["product_name"]): r for r in table.collect()}
    assert set(got) == {(1, "a"), (1, "b"), (2, "c")}
    a, c = got[1, "a"], got[2, "c"]
    assert (a["total_orders"], a["unique_customers"], a["total_sales"], a["total_quantity"]) == (3, 4, 22.0, 9.0)
    assert a["avg_sales"] == pytest.approx(22 / 6) and a["avg_profit"] == pytest.approx(7 / 6) and a["avg_discount"] == pytest.approx(0.1)
    assert (c["total_orders"], c["unique_customers"], c["total_sales"], c["avg_sales"]) == (1, 0, 0.0, None)


@pytest.mark.parametrize("many", [False, True])
def test_only_possible_duplicates_are_moved(spark, monkeypatch, many):
    written = []
    monkeypatch.setattr(clean, "cut", lambda df, cut=clean.cut: written.append(df.count()) or cut(df))
    if many:
        monkeypatch.setattr(clean, "BROADCAST_ROWS", 1)
    nan = float("nan")
    rows = [(i, "x", float(i), i) for i in range(500)]
    rows += [(7, "x", 7.0, -1), (None, "b", 0.0, 3), (None, "b", -0.0, 2), (9000, None, 0.0, 5), (1, "x", nan, 8), (1, "x", nan, 9)]
    df = spark.createDataFrame(rows, "a long, b string, c double, at long").repartition(5)
    keys = ["a", "b", "c"]
    got = sorted(map(str, clean.first_of_each(df, keys, ["at"]).collect()))
    assert got == sorted(map(str, clean.drop_duplicates(df, keys, "first", ["at"]).collect())) and len(got) == 503
    assert many or max(written) < 10
    assert clean.first_of_each(df, ["at", "a"], ["at"]).count() == len(rows)
    lines = sales_with_gaps(spark, SF_DIR, ["order_id", "line_number", "product_id", "supplier_id", "ship_date", "order_date", "ship_mode", "sales", "profit"])
    written.clear()
    clean.preprocess(lines, ["sales"], ["ship_mode"], ["order_date"], ["profit"], order=ROW_KEY).count()
    assert many or sum(n > 1000 for n in written) == 1


@pytest.mark.parametrize("most, some", [(100, True), (1, False)])
def test_only_rows_that_may_repeat_are_grouped_whole(spark, monkeypatch, most, some):
    monkeypatch.setattr(profile, "BROADCAST_ROWS", most)
    rows = [(i, float(i), str(i)) for i in range(199)] + [(5, None, "x")] * 3 + [(6, 0.0, None), (6, -0.0, None)]
    df = spark.createDataFrame(rows, "a long, b double, c string").repartition(3)
    counted = profile.duplicate_rows(df)
    assert counted.first()[0] == 3
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == some
