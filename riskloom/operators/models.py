"""Model family, pipeline assembly and cross-validation (M1-M5, M8, M9).

Estimators are Spark ML's own.  ``reference_family`` carries the executed settings of
the reference job; ``reference_grids`` its documented (but unexecuted) tuning grids.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.evaluate import evaluate_scores
from riskloom.operators.features import FEATURES, SCALED, fit_weighted_scaler
from riskloom.operators.partitioning import deal_weighted, repeated, train_partitions


@dataclass(frozen=True)
class ModelSpec:
    """A named estimator factory; ``ordinal`` breaks ties when selecting a winner."""

    name: str
    ordinal: int
    build: Callable[[str, str], object]  # (features_col, label_col) -> Estimator

    def estimator(self, features_col: str = SCALED, label_col: str = "label"):
        return self.build(features_col, label_col)


# --- Fixed values: executed settings of the reference job (LR maxIter 100; forest 30
# --- trees, depth 4, seed 42; boosting 25 rounds, depth 5, seed 42), in its order.
def reference_family() -> list[ModelSpec]:
    return [
        ModelSpec("Logistic Regression", 1, lambda f, y: LogisticRegression(
            featuresCol=f, labelCol=y, maxIter=100)),
        ModelSpec("Random Forest", 2, lambda f, y: RandomForestClassifier(
            featuresCol=f, labelCol=y, numTrees=30, maxDepth=4, seed=42)),
        ModelSpec("Gradient Boosted Trees", 3, lambda f, y: GBTClassifier(
            featuresCol=f, labelCol=y, maxIter=25, maxDepth=5, seed=42)),
    ]


def reference_grids(estimator) -> list[dict]:
    """Documented tuning grids (4 points each) for the estimator's family."""
    b = ParamGridBuilder()
    # --- Fixed values: documented grids (regParam, elasticNetParam / numTrees, maxDepth,
    # --- minInstancesPerNode / maxIter, maxDepth, stepSize).
    if isinstance(estimator, LogisticRegression):
        b = b.addGrid(estimator.regParam, [0.01, 0.1]).addGrid(estimator.elasticNetParam, [0.0, 0.5])
    elif isinstance(estimator, RandomForestClassifier):
        b = (b.baseOn({estimator.numTrees: 100})
             .addGrid(estimator.maxDepth, [5, 10]).addGrid(estimator.minInstancesPerNode, [1, 5]))
    elif isinstance(estimator, GBTClassifier):
        b = (b.baseOn({estimator.maxIter: 50})
             .addGrid(estimator.maxDepth, [5, 8]).addGrid(estimator.stepSize, [0.1, 0.2]))
    return b.build()


def takes_weights(estimator) -> bool:
    """Whether a fit on rows with weights is the fit on the rows written out.

    It isn't where rows are drawn (bagging, subsampling), nor where a node needs several rows.
    """
    if not estimator.hasParam("weightCol"):
        return False
    value = lambda name, other: estimator.getOrDefault(name) if estimator.hasParam(name) else other
    drawn = isinstance(estimator, RandomForestClassifier) and value("bootstrap", False) and value("numTrees", 1) > 1
    return not drawn and value("subsamplingRate", 1.0) == 1.0 and value("minInstancesPerNode", 1) == 1


def _bagged(estimator) -> bool:
    """Whether it is a forest each of whose trees draws its rows with replacement."""
    return isinstance(estimator, RandomForestClassifier) and estimator.getBootstrap() and estimator.getNumTrees() > 1


def draw_bags(weights: np.ndarray, trees: int, rate: float, seed: Sequence[int]) -> np.ndarray:
    """How often the bag of each tree (column) holds each row.

    Spark's bagging draws every row by Poisson(rate) for every tree; equal rows, of which there are ``weights``,
    are so drawn by Poisson(rate * weight) together, and that is one draw.
    """
    return np.random.default_rng([x & (2 ** 64 - 1) for x in seed]).poisson(rate * weights[:, None], (len(weights), trees))


def fit_on_bags(estimator: RandomForestClassifier, rows: DataFrame, weight: str, salt: int = 0) -> RandomForestClassificationModel:
    """The forest of a table of two classes whose rows stand for ``weight`` equal rows each, a whole number.

    Spark's own learner grows all trees, as in a fit on the rows written out: candidates for splits come from the weighted
    rows, a row counts in a node as often as its tree drew it.  Only the bags are drawn here, for equal rows at
    once (``draw_bags``), so different rows and their bags must fit the driver.  Spark's public interface takes no bags; what is
    called instead is what its ``fit`` consists of.
    """
    sc, trees = rows.sparkSession.sparkContext, estimator.getNumTrees()
    jvm, own = sc._jvm, estimator._to_java()
    learner, points = jvm.org.apache.spark.ml.tree.impl, jvm.java.util.ArrayList()
    kind = jvm.org.apache.spark.ml.classification
    algo = jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
    no_codes = getattr(getattr(jvm.scala.collection.immutable, "Map$"), "MODULE$").empty()
    strategy = own.getOldStrategy(no_codes, 2, algo, own.getOldImpurity())
    for row in rows.select(estimator.getLabelCol(), weight, estimator.getFeaturesCol()).collect():  # few different ones
        points.add(jvm.org.apache.spark.ml.feature.Instance(row[0], float(row[1]), _py2java(sc, row[2])))
    parts = max(1, -(-points.size() // FEW_ROWS))
    instances, points = sc._jsc.parallelize(points, parts).rdd(), jvm.java.util.ArrayList()
    about = learner.DecisionTreeMetadata.buildMetadata(instances, strategy, trees, estimator.getFeatureSubsetStrategy())
    splits = getattr(getattr(learner, "RandomForest$"), "MODULE$").findSplits(instances, about, estimator.getSeed())
    binned = list(learner.TreePoint.convertToTreeRDD(instances, splits, about).collect())
    # a count is an int: a row of more is several
    held = [(point, w) for point in binned for w in _pieces(point.weight())]
    bags = draw_bags(np.array([w for _, w in held]), trees, estimator.getSubsamplingRate(), (estimator.getSeed(), salt))
    for (point, _), bag in zip(held, bags.astype(">i4")):
        counts = sc._gateway.new_array(jvm.int, trees)
        jvm.java.nio.ByteBuffer.wrap(bag.tobytes()).asIntBuffer().get(counts)
        points.add(learner.BaggedPoint(point, counts, 1.0))
    cached = sc._jsc.parallelize(points, parts).rdd().cache()
    shared = sc._jsc.broadcast(splits)
    try:
        grown = learner.RandomForest.runBagged(cached, about, shared, strategy, trees, estimator.getFeatureSubsetStrategy(),
                                               estimator.getSeed(), jvm.scala.Option.empty(), True, jvm.scala.Option.empty(), 0)
    finally:
        cached.unpersist(False)
        shared.unpersist()
    typed = sc._gateway.new_array(kind.DecisionTreeClassificationModel, trees)
    for i in range(trees):
        typed[i] = grown[i]
    return estimator._copyValues(RandomForestClassificationModel(kind.RandomForestClassificationModel(
        estimator.uid, typed, about.numFeatures(), 2)))


def _pieces(weight: float, most: int = 1 << 30) -> list[float]:
    whole = int(weight // most)
    return [float(most)] * whole + [weight - whole * most] * (weight > whole * most)


def pipeline_model(stages: Sequence[Transformer]) -> PipelineModel:
    """Deliverable pipeline from already *fitted* stages — nothing is refitted."""
    return PipelineModel(stages=list(stages))


#: Column of the number of equal rows that a row stands for.
WEIGHT = "row_weight"
#: Weighted rows of one partition while there are few of them.
FEW_ROWS = 20_000
#: Rows from which a forest's bags are drawn for equal rows at once, if these are FEW_ROWS at most: drawing row by row costs rows times trees.
MANY_ROWS = 1_000_000
#: Fits that are in flight at a time unless ``spark.riskloom.parallelFits`` says otherwise.  A fit on a table
#: that fills the cluster gains nothing from company; on smaller ones most of its time is the scheduling of short jobs.
PARALLEL_FITS = 8
FITS_SETTING = "spark.riskloom.parallelFits"
#: Scheduler pool of the fits: under ``spark.scheduler.mode=FAIR`` they share the cluster evenly, under FIFO in order of arrival.
POOL = "riskloom-validation"


def _in_parallel(spark: SparkSession, tasks: Sequence[Callable[[], object]], most: int) -> list:
    """Results of the tasks in their order, ``most`` of them in flight, each in a thread with the session's properties."""
    def pooled(task):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", POOL)
        return task()

    with ThreadPoolExecutor(max(1, most)) as threads:
        waiting = [threads.submit(inheritable_thread_target(spark)(pooled), t) for t in tasks]
        try:
            return [w.result() for w in waiting]
        finally:
            for w in waiting:  # after a failure nothing further starts
                w.cancel()


def cross_validate(estimators: Sequence[tuple[object, list[dict]]], data: DataFrame, label_col: str,
                   features_col: str = FEATURES, fold_col: str = "fold", num_folds: int = 5, row_cols: Sequence[str] = (),
                   partitions: int | None = None, parallel: int | None = None) -> list[dict]:
    """Mean and per-fold exact AUC of every grid point of every estimator; nothing is refitted at the end.

    ``data`` holds label, unscaled vector and a key-hash fold (see ``split.fold_assignment``); rows
    of other folds are not used.  Rows equal in all three are counted (one pass over ``data``) and cached
    once as rows with a weight; learners for which weights are the rows written out (``takes_weights``)
    read them as they are, the others (forests, which draw rows) read each as often as it occurs, or, where many rows
    (``MANY_ROWS``) are few different ones, draw all equal rows at once (``fit_on_bags``).
    Each fold is a plain filter, and the scaler is fitted on the fold's training rows only.  All folds'
    grid points are one queue, of which ``parallel`` are fitted at a time.  Partitions grow with the rows, so
    that a task's share doesn't.  An estimator's features column must be ``SCALED``; ``row_cols`` (the key)
    play no part, as equal rows are spread by their counts.
    """
    spark = data.sparkSession
    most = parallel or int(spark.conf.get(FITS_SETTING, str(PARALLEL_FITS)))
    slim = data.select(F.col(label_col).cast("double").alias(label_col), vector_to_array(features_col).alias("_values"),
                       F.col(fold_col).cast("int").alias(fold_col)).filter(F.col(fold_col).between(0, num_folds - 1))
    counted = slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias(WEIGHT)).persist(StorageLevel.MEMORY_AND_DISK)
    points = [(e, estimator, point) for e, (estimator, grid) in enumerate(estimators) for point in grid]
    cached = [counted]

    def filled(laid):
        laid = laid.withColumn(features_col, array_to_vector("_values")).drop("_values").persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(laid)
        laid.count()  # filled once, before the fits ask for it all at a time
        return laid

    def cut(laid):
        """(training rows, rows to check by) of every fold, scaled."""
        return [[scale.transform(part).select(label_col, SCALED, WEIGHT) for part in (
            laid.filter(F.col(fold_col) != fold), laid.filter(F.col(fold_col) == fold))] for fold, scale in enumerate(scales)]

    try:
        size = counted.agg(F.coalesce(F.sum(WEIGHT), F.lit(0)), F.count(F.lit(1))).first()
        by = [fold_col, "_values", label_col]
        # few different rows make few partitions, however often they occur
        few = partitions or max(1, min(train_partitions(counted, size[1]), -(-size[1] // FEW_ROWS)))
        laid = filled(counted.withColumn(WEIGHT, F.col(WEIGHT).cast("double")).repartition(few, F.xxhash64(*by)).sortWithinPartitions(*by))
        scales = [fit_weighted_scaler(laid.filter(F.col(fold_col) != fold), WEIGHT, features_col, SCALED) for fold in range(num_folds)]
        weighted = cut(laid)
        written = None
        # a draw for equal rows at once saves most where there are many of them, and takes place on the driver
        at_once = size[0] >= MANY_ROWS and size[1] <= FEW_ROWS
        drawing = [e for e in (estimator.copy(point) for _, estimator, point in points) if not takes_weights(e)]
        if not all(at_once and _bagged(e) for e in drawing):
            written = cut(filled(deal_weighted(counted, by, partitions or train_partitions(counted, size[0]), WEIGHT)))
        counted.unpersist()

        def auc(estimator, point, fold):
            estimator = estimator.copy(point)
            if takes_weights(estimator):
                model = estimator.copy({estimator.weightCol: WEIGHT}).fit(weighted[fold][0])
            elif at_once and _bagged(estimator):
                model = fit_on_bags(estimator, weighted[fold][0], WEIGHT, fold)
            else:
                model = estimator.fit(repeated(written[fold][0], WEIGHT))
            scored = model.transform(weighted[fold][1]).select(
                label_col, F.col("prediction").cast("int").alias("prediction"),
                vector_to_array("rawPrediction")[1].alias("score"), WEIGHT)
            return evaluate_scores(scored, label_col, "score", "prediction", WEIGHT)["auc"]

        tasks = [partial(auc, estimator, point, fold) for fold in range(num_folds) for _, estimator, point in points]
        found = _in_parallel(spark, tasks, most)
        per_fold = [found[at:at + len(points)] for at in range(0, len(found), len(points))]
    finally:
        for df in cached:
            df.unpersist()
    out, within = [], [0] * len(estimators)
    for i, (e, estimator, point) in enumerate(points):
        aucs = [found[i] for found in per_fold]
        out.append({"estimator": type(estimator).__name__, "point": within[e], "params": {p.name: v for p, v in point.items()},
                    "fold_auc": aucs, "mean_auc": sum(aucs) / len(aucs) if aucs and None not in aucs else None})
        within[e] += 1
    return out
