"""Classification pipelines."""

import numpy as np
import pytest

from shelfwise.operators import classify


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        kind = "common" if i % 3 else "rare"
        rows.append((i, kind, float(rng.normal(kind == "rare", 0.3)), float(rng.normal()), 1.0))
    return spark.createDataFrame(rows, "id long, kind string, a double, b double, constant double")


def test_split_keeps_class_shares(customers):
    parts = classify.stratified_split(customers, "id", "kind")
    counts = {(r["kind"], r["part"]): r["count"] for r in parts.groupBy("kind", "part").count().collect()}
    assert counts == {("common", "test"): 40, ("common", "train"): 160, ("rare", "test"): 20, ("rare", "train"): 80}
    folds = classify.stratified_folds(customers, "id", "kind").groupBy("kind", "fold").count().collect()
    assert {(r["kind"], r["count"]) for r in folds} == {("common", 40), ("rare", 20)}


@pytest.mark.parametrize("model", classify.MODELS)
def test_models_beat_the_majority_and_survive_saving(spark, customers, tmp_path, model):
    parts = classify.stratified_split(customers, "id", "kind").cache()
    fitted = classify.train(parts.where("part = 'train'"), ["a", "b", "constant"], "kind", model, n_estimators=10, max_depth=5)
    test = parts.where("part = 'test'")
    predictions = fitted.predict(test, "id", "kind")
    scores = {r["metric"]: r["value"] for r in classify.evaluate(predictions, model).collect()}
    assert scores["accuracy"] > 0.8 and scores["roc_auc"] > 0.8
    best = classify.feature_importance(fitted, spark).first()
    assert best["feature"] == "a"
    fitted.save(f"{tmp_path}/model")
    restored = classify.Fitted.load(f"{tmp_path}/model")
    assert restored.features == fitted.features
    loaded = restored.predict(test, "id", "kind")
    assert sorted(map(tuple, loaded.select("key", "y_pred").collect())) == sorted(map(tuple, predictions.select("key", "y_pred").collect()))


def test_cross_validation(customers):
    folds = classify.cross_validate(customers, "id", ["a", "b"], "kind", "DecisionTree", max_depth=3)
    rows = folds.collect()
    assert len(rows) == 5
    scores = [r["f1_macro"] for r in rows]
    summary = {r["metric"]: r["value"] for r in classify.cv_summary(folds).collect()}
    assert summary["cv_f1_mean"] == pytest.approx(np.mean(scores)) and summary["cv_f1_std"] == pytest.approx(np.std(scores))


def test_unknown_model(customers):
    with pytest.raises(ValueError):
        classify.train(customers, ["a"], "kind", "Boosting")


@pytest.mark.parametrize("model", ["DecisionTree", "RandomForest"])
def test_small_nodes_are_not_split(spark, customers, tmp_path, model):
    classifier = classify._classifier(model, 300, 1, 8, 5)
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    rows = StringIndexer(inputCol="kind", outputCol="label").fit(customers).transform(customers)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    grown = classifier.fit(rows)
    for least in (5, 40, 10_000):
        cut_back = classify.pruned(grown, spark, least)
        path = f"{tmp_path}/{least}"
        cut_back.save(path)
        nodes = spark.read.parquet(f"{path}/data")
        nodes = nodes.select("treeID", "nodeData.*") if "nodeData" in nodes.columns else nodes.selectExpr("0 AS treeID", "*")
        inner = nodes.where("leftChild >= 0")
        assert inner.where(f"rawCount < {least}").count() == 0
        if least == 40:
            assert nodes.count() < (grown.totalNumNodes if model == "RandomForest" else grown.numNodes)
        if least == 5:
            # Rows whose path has no small inner node keep their prediction: the leaf's class counts are the node's.
            before = {r["id"]: r["probability"] for r in grown.transform(rows).select("id", "probability").collect()}
            after = {r["id"]: r["probability"] for r in cut_back.transform(rows).select("id", "probability").collect()}
            assert 0 < sum(before[i] == after[i] for i in before)
        if least == 10_000:
            assert nodes.count() == nodes.select("treeID").distinct().count()  # only roots are left


def test_pruned_nodes_by_hand():
    leaf = {"leftChild": -1, "rightChild": -1, "gain": -1.0, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
    node = lambda id, count, left=-1, right=-1: leaf | {"id": id, "rawCount": count} | (
        {"leftChild": left, "rightChild": right, "gain": 0.1, "split": {"featureIndex": 0, "leftCategoriesOrThreshold": [0.5], "numCategories": -1}} if left >= 0 else {})
    tree = [node(0, 11, 1, 4), node(1, 4, 2, 3), node(2, 2), node(3, 2), node(4, 7, 5, 6), node(5, 2), node(6, 5)]
    got = [(n["id"], n["rawCount"], n["leftChild"], n["rightChild"], n["split"]["featureIndex"]) for n in classify._pruned_nodes(tree, 5)]
    assert got == [(0, 11, 1, 2, 0), (1, 4, -1, -1, -1), (2, 7, 3, 4, 0), (3, 2, -1, -1, -1), (4, 5, -1, -1, -1)]


def test_training_rows_are_dealt_out(spark, tmp_path, monkeypatch):
    """A table written as one small file is trained on by more than one task, and folds are fitted at the same time."""
    spark.range(400).selectExpr("id", "IF(id % 2 = 0, 'even', 'odd') AS kind", "id % 2 + rand(3) AS a").coalesce(1).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert rows.rdd.getNumPartitions() == 1
    monkeypatch.setattr(classify, "TASK_ROWS", 100)
    assert classify._dealt(rows, 400).rdd.getNumPartitions() == 4
    assert classify._dealt(rows, 1_000_000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    active, most = [], []

    def work(i):
        active.append(i)
        spark.range(3).count()
        most.append(len(set(active)))
        return i * i

    assert classify.side_by_side(spark, work, range(5)) == [0, 1, 4, 9, 16]
    assert max(most) > 1
