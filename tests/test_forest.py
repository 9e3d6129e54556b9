"""Forests grown tree by tree in tasks, against the library's trees."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler

from shelfwise.operators import classify, forest

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes with noise; one feature takes few values, one a single value."""
    rng = np.random.default_rng(4)
    out = []
    for i in range(900):
        a, b, c = float(rng.normal()), float(rng.integers(0, 6)), float(rng.integers(0, 400))
        kind = 2 if rng.random() < 0.15 else int(a + b / 3 > 0.8) if c < 300 else int(rng.integers(0, 3))
        out.append((i, f"kind {kind}", kind, a, b, c, 1.0))
    return spark.createDataFrame(out, "id long, kind string, code int, a double, b double, c double, d double").cache()


@pytest.mark.parametrize("depth, bins", [(4, 16), (12, 128), (12, 256)])
def test_one_tree_of_all_rows_is_the_librarys(spark, rows, depth, bins):
    labels = ["kind 0", "kind 1", "kind 2"]
    grown = forest.fit(rows, NAMES, "code", labels, "tree", trees=1, depth=depth, bins=bins, least_leaf=2, least_split=0, tried=4, bootstrap=False)
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    known = DecisionTreeClassifier(labelCol="code", maxDepth=depth, maxBins=bins, minInstancesPerNode=2).fit(vectors)
    tree = grown.trees.first()
    assert len(tree["feature"]) == known.numNodes
    shares = {r["key"]: [r["proba"][x] for x in labels] for r in grown.predict(rows, "id", "kind").collect()}
    assert len(shares) == 900
    for r in known.transform(vectors).collect():
        assert shares[r["id"]] == pytest.approx(list(r["probability"]), abs=1e-12)
    assert grown.importances() == pytest.approx(known.featureImportances.toArray())


def test_forest_of_many_rows_is_grown_in_tasks(spark, rows, tmp_path, monkeypatch):
    def scores(predictions):
        return {r["metric"]: r["value"] for r in classify.evaluate(predictions, "x").collect()}

    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    known = classify.train(train, NAMES, "kind", n_estimators=20)
    monkeypatch.setattr(classify, "GROWN_ROWS", (500, 1000))
    monkeypatch.setattr(forest, "BLOCK_BITS", 4)
    grown = classify.train(train, NAMES, "kind", n_estimators=20)
    assert isinstance(grown, forest.Forest) and grown.trees.count() == 20
    predictions = grown.predict(test, "id", "kind")
    assert predictions.columns == known.predict(test, "id", "kind").columns
    mine, theirs = scores(predictions), scores(known.predict(test, "id", "kind"))
    assert all(abs(mine[m] - theirs[m]) < 0.06 for m in theirs)
    weights = {r["feature"]: r["importance"] for r in classify.feature_importance(grown, spark).collect()}
    others = {r["feature"]: r["importance"] for r in classify.feature_importance(known, spark).collect()}
    assert all(abs(weights[f] - others[f]) < 0.06 for f in NAMES) and weights["d"] == 0
    # The same trees however the rows are dealt out, and after saving.
    before = sorted(map(tuple, predictions.select("key", "y_true", "y_pred").collect()))
    again = classify.train(train.repartition(5, "a"), NAMES, "kind", n_estimators=20)
    assert sorted(map(tuple, again.predict(test, "id", "kind").select("key", "y_true", "y_pred").collect())) == before
    grown.save(f"{tmp_path}/model")
    loaded = classify.Fitted.load(f"{tmp_path}/model")
    assert loaded.features == NAMES
    assert sorted(map(tuple, loaded.predict(test, "id", "kind").select("key", "y_true", "y_pred").collect())) == before


def test_nodes_of_a_grown_forest_keep_their_limits(rows):
    grown = forest.fit(rows, NAMES, "code", ["kind 0", "kind 1", "kind 2"], "f", trees=6, depth=5, bins=32, least_leaf=2, least_split=30)
    for tree in grown.trees.collect():
        sizes = np.array(tree["counts"]).reshape(-1, 3).sum(1)
        inner = np.array(tree["feature"]) >= 0
        first = np.array(tree["first"])[inner]
        assert sizes[inner].min() >= 30 and sizes.min() >= 2 and len(sizes) <= 63
        assert (sizes[first] + sizes[first + 1] == sizes[inner]).all()
    assert grown.trees.select("feature").distinct().count() > 1


def test_missing_features_are_refused(rows):
    bad = rows.selectExpr("id", "kind", "code", "IF(id = 7, NULL, a) AS a", "b", "c", "d")
    with pytest.raises(Exception, match="null or NaN"):
        forest.fit(bad, NAMES, "code", ["kind 0", "kind 1", "kind 2"], "f", trees=2, depth=3, bins=8, least_leaf=2, least_split=0)


def test_thresholds():
    assert forest.thresholds(np.array([3.0, 1.0, 2.0, 1.0]), 8).tolist() == [1.5, 2.5]
    assert forest.thresholds(np.ones(5), 8).tolist() == []
    assert forest.thresholds(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]
    assert len(forest.thresholds(np.concatenate([np.zeros(900), np.arange(1, 101)]), 4)) <= 3


def test_no_predictions_for_no_rows(rows):
    grown = forest.fit(rows, NAMES, "code", ["kind 0", "kind 1", "kind 2"], "f", trees=2, depth=3, bins=8, least_leaf=2, least_split=0)
    assert grown.predict(rows.where("false"), "id", "kind").count() == 0


def test_no_tree_of_many_rows_is_held_by_the_driver(rows, monkeypatch):
    """Fits, folds and scores of a grown forest use no model of the library, whose trees lie on the driver."""
    def refuse(*args):
        raise AssertionError("a model of the library")

    monkeypatch.setattr(classify, "GROWN_ROWS", (500, 1000))
    monkeypatch.setattr(classify, "_classifier", refuse)
    monkeypatch.setattr(classify, "pruned", refuse)
    folds = classify.cross_validate(rows.drop("code"), "id", NAMES, "kind", "RandomForest", n_estimators=3, max_depth=4).collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4] and all(0.5 < r["f1_macro"] <= 1 for r in folds)
    grown = classify.train(rows, NAMES, "kind", n_estimators=3)
    assert len(grown.trees.inputFiles()) > 0  # a table that was written
