"""Saved ensembles as data: the same scores as the loaded pipelines; the node table; wrong or missing models."""

import random

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from riskloom.errors import CatalogMismatch, ModelUnavailable
from riskloom.operators.features import SCALED, assembler, scaler
from riskloom.operators.models import pipeline_model
from riskloom.operators.score import score_table
from riskloom.operators.tree_score import read_trees, score_trees
from riskloom.sources.registry import load_pipeline, save_pipeline

NAMES = ["a", "b", "odd name", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(i, rng.gauss(0, 3), float(rng.randint(0, 4)), rng.random(), 7.0) for i in range(600)]
    df = spark.createDataFrame(data, "key long, a double, b double, `odd name` double, flat double")
    return df.withColumn("label", ((F.col("a") + F.col("b") * F.col("odd name") > 1.5) | (F.col("b") == 3)).cast("double")).cache()


@pytest.mark.parametrize("kind, settings", [(RandomForestClassifier, {"numTrees": 12, "maxDepth": 6}),
                                            (GBTClassifier, {"maxIter": 8, "maxDepth": 4})], ids=["forest", "boosting"])
def test_same_scores_as_the_loaded_model(spark, rows, tmp_dir, kind, settings):
    estimator = kind(featuresCol=SCALED, labelCol="label", seed=3, **settings)
    asm = assembler(NAMES)
    train = asm.transform(rows)
    scale = scaler().fit(train)
    path = save_pipeline(pipeline_model([asm, scale, estimator.fit(scale.transform(train))]), f"{tmp_dir}/m")
    new = rows.union(rows.limit(3).withColumn("a", F.lit(None).cast("double"))).union(rows.limit(2).withColumn("b", F.lit(float("nan"))))
    trees = read_trees(spark, path)
    got = {r.key: r for r in score_trees(new, trees, ["key"], ["label"]).collect()}
    want = {r.key: r for r in score_table(new, load_pipeline(path), ["key"], ["label"]).collect()}
    assert got.keys() == want.keys() and len(got) == 600
    for key, w in want.items():
        assert got[key].prediction == w.prediction
        assert (got[key].probability, got[key].raw_score) == pytest.approx((w.probability, w.raw_score), abs=1e-12)
    model = load_pipeline(path).stages[2]
    assert trees.nodes.count() == sum(t.numNodes for t in model.trees)
    assert trees.nodes.filter("left is null").count() == sum((t.numNodes + 1) // 2 for t in model.trees)
    plan = score_trees(new, trees, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "UDF" not in plan


def test_missing_and_other_models(spark, rows, tmp_dir):
    with pytest.raises(ModelUnavailable):
        read_trees(spark, f"{tmp_dir}/none")
    asm = assembler(["a", "b"])
    train = asm.transform(rows)
    scale = scaler().fit(train)
    linear = LogisticRegression(featuresCol=SCALED, labelCol="label").fit(scale.transform(train))
    with pytest.raises(CatalogMismatch):
        read_trees(spark, save_pipeline(pipeline_model([asm, scale, linear]), f"{tmp_dir}/linear"))
    stump = RandomForestClassifier(featuresCol=SCALED, labelCol="label", numTrees=1, maxDepth=0, bootstrap=False).fit(scale.transform(train))
    trees = read_trees(spark, save_pipeline(pipeline_model([asm, scale, stump]), f"{tmp_dir}/stump"))
    share = rows.agg(F.avg("label")).first()[0]
    assert {round(r.probability, 9) for r in score_trees(rows, trees, ["key"]).collect()} == {round(share, 9)}
    with pytest.raises(CatalogMismatch, match="b"):
        score_trees(rows.drop("b"), trees, ["key"])
