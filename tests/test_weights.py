"""Equal rows as weights: the same models as rows written out, spread evenly."""

import random

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from riskloom.catalog import FeatureCatalog, FeatureSpec, binary
from riskloom.operators.features import assembler, fit_weighted_scaler, scaler
from riskloom.operators.models import ModelSpec, takes_weights
from riskloom.operators.partitioning import repeated, weighted_layout
from riskloom.plans.train_job import TrainConfig, train_job

CATALOG = FeatureCatalog((FeatureSpec("x"), FeatureSpec("y")), label="label", key_cols=())


def keyless(spark, hot=400, other=800):
    rng = random.Random(2)
    rows = [(1.0, 2.0, 1.0, 3)] * hot
    rows += [(float(rng.randint(0, 9)), float(rng.randint(0, 3)), 0.0, rng.randint(0, 99)) for _ in range(other)]
    rows = [(x, y, float((x + y + rng.random() * 4 > 8)) if (x, y) != (1.0, 2.0) else label, b) for x, y, label, b in rows]
    return spark.createDataFrame(rows, "x double, y double, label double, bucket int").repartition(3)


def test_layout_keeps_every_row_and_spreads_the_hot_one(spark):
    table = keyless(spark).drop("bucket")
    laid = weighted_layout(table, ["x", "y", "label"], 8)
    per_part = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("weight").alias("w"), F.max("weight").alias("most")).collect()
    assert len(per_part) == 8 and sum(r.w for r in per_part) == 1200
    assert max(r.most for r in per_part) <= 400 / 8 + 1 and max(r.w for r in per_part) <= 2.5 * 1200 / 8
    assert repeated(laid).exceptAll(table).count() == 0 and table.exceptAll(repeated(laid)).count() == 0
    again = weighted_layout(table.repartition(5), ["x", "y", "label"], 8)
    key = lambda df: sorted(map(tuple, df.withColumn("p", F.spark_partition_id()).collect()))
    assert key(laid) == key(again)


def test_scaler_of_weighted_rows(spark):
    table = assembler(["x", "y"]).transform(keyless(spark))
    want = scaler().fit(table)
    weighted = assembler(["x", "y"]).transform(weighted_layout(keyless(spark).drop("bucket"), ["x", "y", "label"], 4))
    got = fit_weighted_scaler(weighted, "weight")
    assert list(got.mean) == pytest.approx(list(want.mean), rel=1e-12)
    assert list(got.std) == pytest.approx(list(want.std), rel=1e-12)
    assert got.getInputCol() == want.getInputCol() and got.transform(weighted).columns[-1] == want.getOutputCol()
    one = weighted.limit(1).withColumn("weight", F.lit(5.0))
    assert list(fit_weighted_scaler(one, "weight").std) == [0.0, 0.0]


def test_which_learners_take_weights():
    assert takes_weights(LogisticRegression()) and takes_weights(GBTClassifier())
    assert takes_weights(RandomForestClassifier(numTrees=1, bootstrap=False))
    assert not takes_weights(RandomForestClassifier(numTrees=5)) and not takes_weights(GBTClassifier(subsamplingRate=0.5))
    assert not takes_weights(GBTClassifier(minInstancesPerNode=5))


def test_training_without_a_key_equals_training_with_one(spark):
    """The same rows with a unique key (each row trained on its own) and without (weights)."""
    family = [ModelSpec("lr", 1, lambda f, y: LogisticRegression(featuresCol=f, labelCol=y, maxIter=200, tol=1e-12)),
              ModelSpec("gbt", 2, lambda f, y: GBTClassifier(featuresCol=f, labelCol=y, maxIter=4, maxDepth=3, seed=1)),
              ModelSpec("forest", 3, lambda f, y: RandomForestClassifier(featuresCol=f, labelCol=y, numTrees=5, maxDepth=3, seed=1))]
    table = keyless(spark)
    keyed = table.withColumn("id", F.monotonically_increasing_id().cast("string"))
    runs = [train_job(spark, t, TrainConfig(c, family, bucket_col="bucket")) for t, c in (
        (table, CATALOG), (keyed, FeatureCatalog(CATALOG.features, label="label", key_cols=("id",))))]
    plain = [{r["model"]: r for r in run.board_rows} for run in runs]
    for model in ("lr", "gbt"):
        for metric in ("accuracy", "auc_roc", "f1_score", "test_rows", "predicted_positive"):
            assert plain[0][model][metric] == plain[1][model][metric], (model, metric)
    assert plain[0]["forest"]["test_rows"] == plain[1]["forest"]["test_rows"]
    assert runs[0].dataset_info == runs[1].dataset_info
    a, b = (run.fitted["lr"] for run in runs)
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), rel=1e-6)


class _Seen(LogisticRegression):
    """Notes how many rows it is fitted on."""

    rows: list[int] = []

    def _fit(self, dataset):
        self.rows.append(dataset.count())
        return super()._fit(dataset)


def test_keyed_rows_of_few_codes_are_fitted_as_weights(spark):
    """What a fit caches follows the codes that the catalog allows, not the table; the models are those of all rows."""
    rng = random.Random(5)
    rows = [(str(i), *(float(rng.random() < 0.4) for _ in range(3)), rng.randint(0, 99)) for i in range(4000)]
    rows = [(i, a, b, c, float(rng.random() < 0.1 + 0.3 * a + 0.2 * b), bucket) for i, a, b, c, bucket in rows]
    table = spark.createDataFrame(rows, "id string, a double, b double, c double, label double, bucket int").repartition(4)
    family = [ModelSpec("lr", 1, lambda f, y: _Seen(featuresCol=f, labelCol=y, maxIter=200, tol=1e-12)),
              ModelSpec("gbt", 2, lambda f, y: GBTClassifier(featuresCol=f, labelCol=y, maxIter=3, maxDepth=2, seed=1))]
    codes = tuple(binary(c, 0.0) for c in "abc")
    config = lambda features: TrainConfig(FeatureCatalog(features, label="label", key_cols=("id",)), family, bucket_col="bucket")
    few, every = (train_job(spark, table, config(f)) for f in (codes, tuple(FeatureSpec(c) for c in "abc")))
    assert _Seen.rows[0] <= 2 ** 4 < _Seen.rows[1] == few.dataset_info["train_rows"] == every.dataset_info["train_rows"]
    names = ("model", "accuracy", "auc_roc", "f1_score", "recall", "test_rows", "predicted_positive")
    assert [[r[x] for x in names] for r in few.board_rows] == [[r[x] for x in names] for r in every.board_rows]
    assert list(few.fitted["lr"].coefficients) == pytest.approx(list(every.fitted["lr"].coefficients), rel=1e-6)
    assert list(few.fitted["gbt"].featureImportances.toArray()) == pytest.approx(list(every.fitted["gbt"].featureImportances.toArray()))
    assert list(few.pipeline.stages[1].std) == pytest.approx(list(every.pipeline.stages[1].std), rel=1e-9)
    drawn = [*family, ModelSpec("forest", 3, lambda f, y: RandomForestClassifier(featuresCol=f, labelCol=y, numTrees=3, seed=1))]
    train_job(spark, table, TrainConfig(FeatureCatalog(codes, label="label", key_cols=("id",)), drawn, bucket_col="bucket"))
    assert _Seen.rows[2] == _Seen.rows[1]  # a learner that draws rows keeps them all
