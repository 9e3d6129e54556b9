"""Classification of customers: stratified split, MLlib pipelines, cross-validation, importances."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.lookup import left_lookup
from shelfwise.functions.ordered import row_numbers
from shelfwise.functions.storage import cut, scratch_path
from shelfwise.operators import forest, metrics

MODELS = ("LogisticRegression", "DecisionTree", "RandomForest")
FOREST_DEPTH, FOREST_BINS = 15, 128
LEAST_IN_LEAF = 2  # rows of a tree's leaf
LEAST_TO_SPLIT = 5  # rows of a tree's node that may still be split
TASK_ROWS = 50_000  # training rows of a task: every task holds counts for all nodes of a pass, so more tasks are more work
PARALLEL_FITS = 6  # models fitted at the same time
GROWN_ROWS = 20_000, 10_000_000  # training rows beyond the first, up to the second: a forest's trees are grown by ``forest``, in tasks that hold all rows


def _shuffled(df: DataFrame, key: str, target: str, seed: int) -> DataFrame:
    """Adds ``_place`` and ``_size``: position of each row in its class in a seeded hash order, and class size."""
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string"))))
    sizes = df.groupBy(target).agg(F.count("*").alias("_size"))
    return left_lookup(row_numbers(hashed, [target], ["_hash", key], "_place").drop("_hash"), sizes, target)


def stratified_split(df: DataFrame, key: str, target: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``part``: the rounded share of every class is 'test', chosen by hash of the key."""
    held = F.floor(F.col("_size") * test_size + 0.5)
    placed = _shuffled(df.where(F.col(target).isNotNull()), key, target, seed)
    return placed.withColumn("part", F.when(F.col("_place") <= held, "test").otherwise("train")).select(*df.columns, "part")


def stratified_folds(df: DataFrame, key: str, target: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..folds-1, each holding an equal share of every class."""
    placed = _shuffled(df, key, target, seed)
    return placed.withColumn("fold", F.pmod(F.col("_place") - 1, F.lit(folds)).cast("int")).select(*df.columns, "fold")


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    """The rows in even partitions: a written table of narrow rows is one small file, whose passes one core would make alone."""
    return df.repartition(max(1, min(df.sparkSession.sparkContext.defaultParallelism, ceil(rows / TASK_ROWS))))


def side_by_side(spark: SparkSession, work: Callable, items: Sequence) -> list:
    """``work`` of every item, several at the same time: the passes of one fit are too short to fill the cores."""
    with ThreadPool(min(len(items), PARALLEL_FITS)) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def _classifier(name: str, rows: int, seed: int, max_depth: int | None, n_estimators: int):
    common = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    if name == "LogisticRegression":
        # The summed loss with C = 1 corresponds to a mean loss with penalty 1 / rows.
        return LogisticRegression(
            family="multinomial", maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, **common)
    if name == "DecisionTree":
        return DecisionTreeClassifier(maxDepth=max_depth or 10, minInstancesPerNode=LEAST_IN_LEAF, maxBins=256, seed=seed, **common)
    if name == "RandomForest":
        return RandomForestClassifier(
            numTrees=n_estimators, maxDepth=max_depth or FOREST_DEPTH, minInstancesPerNode=LEAST_IN_LEAF, maxBins=FOREST_BINS,
            featureSubsetStrategy="sqrt", seed=seed, **common)
    raise ValueError(f"model must be one of {MODELS}")


@dataclass(frozen=True)
class Fitted:
    """A trained pipeline (label index, assembler, scaler, classifier, label names)."""

    name: str
    features: list[str]
    pipeline: PipelineModel

    def predict(self, df: DataFrame, key: str, target: str) -> DataFrame:
        """(key, y_true, y_pred, proba): proba maps each class to its probability."""
        labels = self.pipeline.stages[0].labels
        shares = vector_to_array("probability")
        proba = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), shares)
        scored = self.pipeline.transform(df)
        return scored.select(F.col(key).alias("key"), F.col(target).alias("y_true"), F.col("y_pred"), proba.alias("proba"))

    def save(self, path: str) -> None:
        """Writes the whole pipeline, so scaling and labels travel with the classifier."""
        self.pipeline.write().overwrite().save(path)

    @staticmethod
    def load(path: str, name: str = "loaded") -> Fitted | forest.Forest:
        """Reads a saved pipeline, whose assembler has the feature names, or a saved ``Forest``."""
        spark = SparkSession.active()
        if forest.Forest.saved_in(spark, path):
            return forest.Forest.load(spark, path, name)
        pipeline = PipelineModel.load(path)
        return Fitted(name, list(pipeline.stages[1].getInputCols()), pipeline)


def _pruned_nodes(nodes: list[dict], least: int) -> list[dict]:
    """The nodes of one tree, numbered from 0 with parents before children, where no node below ``least`` rows is split."""
    by_id, kept, waiting = {n["id"]: n for n in nodes}, [], [(0, None, None)]
    while waiting:
        id, parent, side = waiting.pop()
        node = dict(by_id[id], id=len(kept))
        kept.append(node)
        if parent is not None:
            parent[side] = node["id"]
        if node["leftChild"] >= 0 and node["rawCount"] >= least:
            waiting += [(node["rightChild"], node, "rightChild"), (node["leftChild"], node, "leftChild")]
        else:
            none = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
            node |= {"leftChild": -1, "rightChild": -1, "gain": -1.0, "split": none}
    return kept


def pruned(model, spark: SparkSession, least: int = LEAST_TO_SPLIT):
    """A fitted tree or forest in which nodes of fewer than ``least`` rows predict what they held instead of being split.

    Trees are built by depth and rows per leaf only, so this turns small inner nodes of the written model into leaves;
    a task works on one tree at a time, whose nodes are bounded by its depth.
    """
    grown, cutback = scratch_path(spark, "tree"), scratch_path(spark, "tree")
    model.write().save(grown)
    nodes = spark.read.parquet(f"{grown}/data")
    forest = "nodeData" in nodes.columns

    def prune(tree: pa.Table) -> pa.Table:
        table = pa.Table.from_struct_array(tree["nodeData"].combine_chunks()) if forest else tree
        shape = table.select(["id", "rawCount", "leftChild", "rightChild"]).to_pylist()
        kept = _pruned_nodes([dict(n, row=i) for i, n in enumerate(shape)], least)
        rows, leaf = [n["row"] for n in kept], next(i for i, n in enumerate(shape) if n["leftChild"] < 0)
        unsplit = [leaf if n["leftChild"] < 0 else n["row"] for n in kept]  # leaves have the gain and split of any leaf
        columns = {c: table[c].take(pa.array(unsplit if c in ("gain", "split") else rows)) for c in table.column_names}
        columns |= {c: pa.array([n[c] for n in kept], table.schema.field(c).type) for c in ("id", "leftChild", "rightChild")}
        nodes = pa.table(columns, table.schema)
        return pa.table({"treeID": tree["treeID"].take(pa.array(rows)), "nodeData": nodes.to_struct_array()}, tree.schema) if forest else nodes

    by = ["treeID"] if forest else []
    if forest:  # a number of partitions that is given is not merged again
        nodes = nodes.repartition(min(model.getNumTrees, spark.sparkContext.defaultParallelism), "treeID")
    nodes.groupBy(*by).applyInArrow(prune, nodes.schema).write.parquet(f"{cutback}/data")
    spark.read.text(f"{grown}/metadata").coalesce(1).write.text(f"{cutback}/metadata")
    if forest:
        spark.read.parquet(f"{grown}/treesMetadata").write.parquet(f"{cutback}/treesMetadata")
    return type(model).load(cutback)


def train(
    train_rows: DataFrame, features: Sequence[str], target: str, model: str = "RandomForest", *,
    scale: bool = True, seed: int = 42, max_depth: int | None = None, n_estimators: int = 100,
) -> Fitted | forest.Forest:
    """Fits labels in alphabetical order, scaling by the population deviation, and the classifier; trees are ``pruned``.

    Forests on many rows (``GROWN_ROWS``) are grown tree by tree in tasks, by the same rules and without the scaling, which moves no split.
    """
    features = list(features)
    rows = train_rows.count()
    if model == "RandomForest" and GROWN_ROWS[0] < rows <= GROWN_ROWS[1]:
        narrow = train_rows.select(*features, target)
        indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(narrow)
        if len(indexer.labels) <= forest.MOST_CODES:
            return forest.fit(
                indexer.transform(narrow), features, "label", indexer.labels, model, trees=n_estimators, depth=max_depth or FOREST_DEPTH,
                bins=FOREST_BINS, least_leaf=LEAST_IN_LEAF, least_split=LEAST_TO_SPLIT, seed=seed)
    train_rows = _dealt(train_rows.select(*features, target), rows).persist(StorageLevel.MEMORY_AND_DISK)
    stages = [
        StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=features, outputCol="assembled" if scale else "features"),
    ]
    if scale:
        # The scaler divides by the sample deviation; the factor turns that into the population deviation.
        factor = sqrt(rows / (rows - 1)) if rows > 1 else 1.0
        stages += [
            StandardScaler(inputCol="assembled", outputCol="standardised", withMean=True, withStd=True),
            ElementwiseProduct(inputCol="standardised", outputCol="features", scalingVec=Vectors.dense([factor] * len(features))),
        ]
    indexer = stages[0].fit(train_rows)
    stages = [
        indexer, *stages[1:], _classifier(model, rows, seed, max_depth, n_estimators),
        IndexToString(inputCol="prediction", outputCol="y_pred", labels=indexer.labels),
    ]
    fitted = Pipeline(stages=stages).fit(train_rows)
    train_rows.unpersist()
    if model != "LogisticRegression":
        fitted = PipelineModel([*fitted.stages[:-2], pruned(fitted.stages[-2], train_rows.sparkSession), fitted.stages[-1]])
    return Fitted(model, features, fitted)


def evaluate(predictions: DataFrame, model: str) -> DataFrame:
    """(model, metric, value): accuracy, macro scores, weighted F1 and one-vs-rest ROC-AUC."""
    scores = metrics.classification_metrics(predictions)
    auc = metrics.roc_auc(predictions).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    return scores.unionByName(auc).select(F.lit(model).alias("model"), "metric", "value")


def cross_validate(
    train_rows: DataFrame, key: str, features: Sequence[str], target: str, model: str = "RandomForest", folds: int = 5, **options
) -> DataFrame:
    """(model, fold, f1_macro) for every stratified fold; see ``cv_summary``."""
    folded = cut(stratified_folds(train_rows.select(key, *features, target), key, target, folds))

    def scored(fold: int) -> DataFrame:
        fitted = train(folded.where(F.col("fold") != fold), features, target, model, **options)
        return fitted.predict(folded.where(F.col("fold") == fold), key, target).drop("proba").withColumn("fold", F.lit(fold))

    parts = side_by_side(train_rows.sparkSession, scored, range(folds))
    f1 = metrics.classification_metrics(reduce(DataFrame.unionByName, parts), by=["fold"]).where("metric = 'f1_macro'")
    return f1.select(F.lit(model).alias("model"), "fold", F.col("value").alias("f1_macro"))


def cv_summary(folds: DataFrame) -> DataFrame:
    """(model, metric, value): mean and population deviation of the folds' F1."""
    table = folds.groupBy("model").agg(F.avg("f1_macro").alias("cv_f1_mean"), F.stddev_pop("f1_macro").alias("cv_f1_std"))
    return metrics.long_metrics(table)


def feature_importance(fitted: Fitted | forest.Forest, spark, top_n: int | None = None) -> DataFrame:
    """(feature, importance), largest first: impurity importances, or mean absolute coefficients over the classes."""
    stage = None if isinstance(fitted, forest.Forest) else fitted.pipeline.stages[-2]
    if stage is None:
        values = fitted.importances()
    elif hasattr(stage, "featureImportances"):
        values = stage.featureImportances.toArray()
    else:
        values = abs(stage.coefficientMatrix.toArray()).mean(axis=0)
    rows = [(f, float(v)) for f, v in zip(fitted.features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table if top_n is None else table.limit(top_n)


def compare_models(results: DataFrame) -> DataFrame:
    """One row per model from (model, metric, value), highest macro F1 first."""
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted", "roc_auc", "cv_f1_mean", "cv_f1_std"]
    return metrics.compare_models(results, names, "f1_macro")
