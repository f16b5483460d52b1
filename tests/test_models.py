"""Trained models against closed forms (the same checks the oracle SQL encodes)."""

import math

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators.models import reference_family, reference_grids


def _data(spark, rows):
    df = spark.createDataFrame(rows, "x double, label double")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


ROWS = [(0.0, 0.0)] * 70 + [(0.0, 1.0)] * 10 + [(1.0, 1.0)] * 15 + [(1.0, 0.0)] * 5   # r0 = 1/8, r1 = 3/4


def logit(r):
    return math.log(r / (1 - r))


def test_logistic_closed_form(spark):
    m = LogisticRegression(maxIter=200, tol=1e-12).fit(_data(spark, ROWS))
    assert m.intercept == pytest.approx(logit(1 / 8), abs=1e-6)
    assert m.coefficients[0] == pytest.approx(logit(3 / 4) - logit(1 / 8), abs=1e-6)


def test_single_tree_leaf_is_group_rate(spark):
    rf = RandomForestClassifier(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=1)
    out = rf.fit(_data(spark, ROWS)).transform(_data(spark, [(0.0, 0.0), (1.0, 0.0)]))
    probs = sorted(r["probability"][1] for r in out.collect())
    assert probs == pytest.approx([1 / 8, 3 / 4])


def test_one_boosting_round(spark):
    out = GBTClassifier(maxIter=1, maxDepth=1, seed=1).fit(_data(spark, ROWS)).transform(_data(spark, [(0.0, 0.0), (1.0, 0.0)]))
    probs = sorted(r["probability"][1] for r in out.collect())
    expect = sorted(1 / (1 + math.exp(-2 * (2 * r - 1))) for r in (1 / 8, 3 / 4))
    assert probs == pytest.approx(expect, abs=1e-12)


def test_reference_family_settings():
    lr, rf, gbt = (s.estimator() for s in reference_family())
    assert lr.getMaxIter() == 100 and lr.getRegParam() == 0.0
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed()) == (30, 4, 42)
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getSeed(), gbt.getStepSize(), gbt.getMaxBins()) == (25, 5, 42, 0.1, 32)
    assert [s.ordinal for s in reference_family()] == [1, 2, 3]


def test_documented_grids_have_four_points():
    for spec in reference_family():
        assert len(reference_grids(spec.estimator())) == 4


def test_cross_validation_closed_form(spark):
    """On one 0/1 feature every fold's AUC is (1 + tpr - fpr) / 2, whatever the grid point."""
    from riskloom.operators.features import SCALED
    from riskloom.operators.models import cross_validate

    rows = [(float(i % 3 == 0), float(i % 3 == 0) if i % 7 else 1.0 - float(i % 3 == 0), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, label double, fold int")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    lr = LogisticRegression(featuresCol=SCALED, labelCol="label")
    got = cross_validate([(lr, reference_grids(lr))], data, "label", num_folds=2, partitions=2)
    want = []
    for fold in range(2):
        own = [(x, y) for x, y, f in rows if f == fold]
        rate = lambda c: sum(x for x, y in own if y == c) / sum(1 for _, y in own if y == c)
        want.append((1 + rate(1.0) - rate(0.0)) / 2)
    assert len(got) == 4 and all(r["fold_auc"] == pytest.approx(want) for r in got)
    assert got[0]["mean_auc"] == pytest.approx(sum(want) / 2)
