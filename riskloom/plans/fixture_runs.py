"""Memoised runs of the training job over the ``risk_rows`` stand-in, shared by the registered
queries, the bench and the tests: each family is fitted once per input state and session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import SparkSession

from riskloom.catalog import RISK_ROWS_CATALOG, YES_NO, FeatureCatalog, binary
from riskloom.operators.models import ModelSpec, reference_family
from riskloom.operators.quality import rejected_rows
from riskloom.plans.train_job import RunResult, TrainConfig, train_job
from riskloom.session import drop_scratch, scratch_path
from riskloom.sources.fixtures import TRAIN_PERCENT, flag_rows_table, input_token, risk_rows, risk_rows_path, risk_rows_table

_RUNS: dict[tuple, RunResult] = {}


def risk_config(family: str = "reference", model_dir: str | None = None) -> TrainConfig:
    specs = reference_family()
    if family != "reference":
        specs = [s for s in specs if s.name == family]
    return TrainConfig(catalog=RISK_ROWS_CATALOG, family=specs, train_percent=TRAIN_PERCENT,
                       bucket_col="split_bucket", model_dir=model_dir)


def model_dir(spark: SparkSession, sf_dir: str, name: str) -> str:
    return scratch_path(spark, "models", f"{spark.sparkContext.applicationId}-{input_token(spark, sf_dir)}-{name}")


def fixture_run(spark: SparkSession, sf_dir: str, family: str = "reference") -> RunResult:
    """Train ``family`` ("reference" = all three, or one model name) on all 21 features of risk_rows."""
    key = (spark.sparkContext.applicationId, input_token(spark, sf_dir), family)
    if key not in _RUNS:
        where = model_dir(spark, sf_dir, family.replace(" ", "-"))
        run = train_job(spark, risk_rows_table(spark, sf_dir), risk_config(family, where))
        # the copy served the fits; rejects are read from the given tables
        run.rejects = rejected_rows(risk_rows(spark, sf_dir), list(RISK_ROWS_CATALOG.key_cols), RISK_ROWS_CATALOG.names)
        drop_scratch(spark, risk_rows_path(spark, sf_dir))
        _RUNS[key] = run
    return _RUNS[key]


def closed_catalog(flags: Sequence[str]) -> FeatureCatalog:
    return FeatureCatalog(tuple(binary(f, 0.0, YES_NO) for f in flags), label="label", key_cols=("row_key",))


def closed_family() -> list[ModelSpec]:
    """The three families at settings whose fit on 0/1 features has a closed form: logistic regression at
    its optimum, one unbootstrapped split, one boosting round of one split."""
    return [
        ModelSpec("Logistic Regression", 1, lambda f, y: LogisticRegression(featuresCol=f, labelCol=y, maxIter=200, tol=1e-12)),
        ModelSpec("Random Forest", 2, lambda f, y: RandomForestClassifier(
            featuresCol=f, labelCol=y, numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=42)),
        ModelSpec("Gradient Boosted Trees", 3, lambda f, y: GBTClassifier(featuresCol=f, labelCol=y, maxIter=1, maxDepth=1, seed=42)),
    ]


def closed_run(spark: SparkSession, sf_dir: str, flags: Sequence[str]) -> RunResult:
    """The training job itself, with ``closed_family``, on the listed flags."""
    key = (spark.sparkContext.applicationId, input_token(spark, sf_dir), *flags)
    if key not in _RUNS:
        config = TrainConfig(closed_catalog(flags), family=closed_family(), train_percent=TRAIN_PERCENT, bucket_col="split_bucket",
                             model_dir=model_dir(spark, sf_dir, f"{len(flags)}-{flags[0]}"))
        _RUNS[key] = train_job(spark, flag_rows_table(spark, sf_dir, flags), config)
    return _RUNS[key]


def keyless_run(spark: SparkSession, sf_dir: str, flags: Sequence[str]) -> RunResult:
    """``closed_run`` on the same rows without their key."""
    key = (spark.sparkContext.applicationId, input_token(spark, sf_dir), "keyless", *flags)
    if key not in _RUNS:
        catalog = FeatureCatalog(closed_catalog(flags).features, label="label", key_cols=())
        config = TrainConfig(catalog, family=closed_family(), train_percent=TRAIN_PERCENT, bucket_col="split_bucket")
        _RUNS[key] = train_job(spark, flag_rows_table(spark, sf_dir, flags).drop("row_key"), config)
    return _RUNS[key]
