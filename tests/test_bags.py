"""Forests of many equal rows: bags drawn for all equal rows at once, trees by Spark's own learner."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from riskloom.operators import models as M
from riskloom.operators.features import SCALED, assembler


def test_bags_are_poisson():
    bags = M.draw_bags(np.array([1.0, 40.0, 1e6]), 4000, 0.5, (7, 1))
    assert bags.mean(axis=1) == pytest.approx([0.5, 20, 5e5], rel=0.05) and bags.var(axis=1) == pytest.approx([0.5, 20, 5e5], rel=0.1)
    assert (bags == M.draw_bags(np.array([1.0, 40.0, 1e6]), 4000, 0.5, (7, 1))).all()
    assert M._pieces(5.0) == [5.0] and M._pieces(7.0, 3) == [3.0, 3.0, 1.0] and M._pieces(6.0, 3) == [3.0, 3.0]


@pytest.mark.parametrize("least", [1, 5, 40])
def test_forest_on_bags_is_the_forest_of_all_rows(spark, least):
    rows = [(0.0, 0.0, 0.0, 900), (0.0, 0.0, 1.0, 100), (1.0, 0.0, 0.0, 500), (1.0, 0.0, 1.0, 500), (0.0, 1.0, 0.0, 300),
            (0.0, 1.0, 1.0, 700), (1.0, 1.0, 0.0, 20), (1.0, 1.0, 1.0, 980), (2.0, 3.0, 0.0, 12)]  # the last: a node of its own, or too few
    few = assembler(["x", "y"], SCALED).transform(spark.createDataFrame(rows, "x double, y double, label double, row_weight long"))
    few = few.select("label", SCALED, "row_weight").coalesce(1)
    every = few.withColumn("row_weight", F.explode(F.sequence(F.lit(1), F.col("row_weight").cast("int")))).drop("row_weight")
    forest = RandomForestClassifier(featuresCol=SCALED, labelCol="label", seed=3, numTrees=40, maxDepth=4, featureSubsetStrategy="all",
                                    minInstancesPerNode=least)
    bagged, plain = M.fit_on_bags(forest, few, "row_weight"), forest.fit(every)
    assert len(bagged.trees) == 40 and bagged.numClasses == plain.numClasses and bagged.uid == forest.uid
    got, want = ([r[0][1] for r in m.transform(few).orderBy(F.col(SCALED).cast("string"), "label").select("probability").collect()]
                 for m in (bagged, plain))
    assert got == pytest.approx(want, abs=0.02)
    assert (got[-1] > 0.5) == (want[-1] > 0.5) == (least > 12)  # twelve rows are no node of forty
    splits = lambda m: {t.toDebugString.count("<=") for t in m.trees}
    assert max(splits(bagged)) == max(splits(plain))


def test_validation_of_many_equal_rows_writes_none_out(spark, monkeypatch):
    n = M.MANY_ROWS + 1000
    x, u = (F.col("id") % 2).cast("double"), F.pmod(F.xxhash64("id"), F.lit(100))
    rows = spark.range(n).select(x.alias("x"), (u < 30 + 40 * x).cast("double").alias("label"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).alias("fold"))
    forest = RandomForestClassifier(featuresCol=SCALED, labelCol="label", seed=42, numTrees=10)
    grid = [{forest.maxDepth: 3, forest.minInstancesPerNode: m} for m in (1, 5)]

    def no_rows(*_, **__):
        raise AssertionError("rows were written out")

    monkeypatch.setattr(M, "deal_weighted", no_rows)
    found = M.cross_validate([(forest, grid)], assembler(["x"]).transform(rows), "label", num_folds=5)
    at = {(r.fold, r.label): r.share for r in rows.groupBy("fold", "label").agg(F.avg("x").alias("share")).collect()}
    want = [0.5 * (1 + at[f, 1.0] - at[f, 0.0]) for f in range(5)]
    assert [f["fold_auc"] for f in found] == [pytest.approx(want, abs=1e-12)] * 2
