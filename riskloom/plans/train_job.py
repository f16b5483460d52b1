"""The training job: validate → split → assemble/scale → fit family → evaluate → select
→ persist → explain.

Differences from a naive translation, each deliberate:
* the split is a key hash (reproducible on any cluster shape), not ``randomSplit``;
* the scaler is fitted on the training part only (``scaler_scope="all"`` reproduces
  fitting it on every row);
* the deliverable pipeline is assembled from the *fitted* stages — nothing is refitted
  after selection, so the saved scaler is the one the classifier was trained behind;
* rows with null/NaN features are returned as rejects instead of vanishing;
* every count comes from one conditional aggregate; each model's predictions are
  reduced in one pass to (score, prediction) cells that feed both the confusion
  metrics and the exact AUC;
* the learners read one slim cached table (label, vector, part) whose layout depends on the
  rows and on configuration only, so the same rows give the same trees on any cluster;
* in a table without a key equal rows become few rows with a weight, so that one row that
  fills a third of the table is spread, and counts as often as it occurs; with a key, too, where
  the catalog's codes allow few different rows and every learner takes weights: then what is
  cached and read by each iteration doesn't grow with the table.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import FeatureCatalog
from riskloom.functions.local import local_frame
from riskloom.errors import CatalogMismatch, EmptyInput, SingleClassLabel
from riskloom.operators import evaluate as ev
from riskloom.operators.explain import coefficients, feature_importances, tree_stats
from riskloom.operators.features import FEATURES, SCALED, assembler, fit_weighted_scaler, scaler
from riskloom.operators.models import FEW_ROWS, ModelSpec, pipeline_model, reference_family, takes_weights
from riskloom.operators.partitioning import repeated, train_partitions, training_layout, tree_depth, weighted_layout
from riskloom.operators.quality import any_invalid, rejected_rows, valid_rows
from riskloom.operators.score import positive_probability
from riskloom.operators.select import leaderboard, round_metrics, select_winner
from riskloom.operators.split import hash_split, random_split
from riskloom.sources import registry

#: Column of the number of equal rows that a row of a table without a key stands for.
WEIGHT = "row_weight"
#: Rows that the codes of a catalog's features may tell apart for a table with a key to be counted like one without.
FEW_DIFFERENT = 1 << 16


@dataclass
class TrainConfig:
    catalog: FeatureCatalog
    family: Sequence[ModelSpec] = field(default_factory=reference_family)
    train_percent: int = 80
    bucket_col: str | None = None       # reuse a split bucket the table already carries
    scaler_scope: str = "train"         # "train" (no leakage) or "all" (reference behaviour)
    split: str = "hash"                 # "hash" (reproducible) or "random" (parity with randomSplit)
    seed: int = 42                      # of the random split
    auc_bins: int | None = None         # None = exact AUC; n = Spark's evaluator with n bins
                                        # (the reference's setting is 1000: an approximation)
    model_dir: str | None = None        # save pipeline + reports here when given


@dataclass
class RunResult:
    leaderboard: DataFrame
    board_rows: list[dict]
    winner: str
    pipeline: PipelineModel
    fitted: dict[str, object]
    importances: DataFrame | None
    coefficients: DataFrame | None      # set when logistic regression wins (not importances)
    dataset_info: dict
    rejects: DataFrame
    report: dict


def _split_counts(df: DataFrame, catalog: FeatureCatalog, label: str) -> dict:
    """Input, invalid, train, test, train-positive and non-binary-label counts in one aggregate."""
    bad = any_invalid(df, catalog.names)
    train = (~bad) & (F.col("part") == "train")
    row = df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count(F.when(bad, 1)).alias("rejected_rows"),
        F.count(F.when(train, 1)).alias("train_rows"),
        F.count(F.when((~bad) & (F.col("part") == "test"), 1)).alias("test_rows"),
        F.count(F.when(train & (F.col(label) == 1), 1)).alias("train_pos"),
        F.count(F.when(F.col(label).isNull() | ~F.col(label).isin(0, 1), 1)).alias("bad_labels"),
    ).first()
    return row.asDict()


def _few_rows(config: TrainConfig) -> int | None:
    """Different rows (features, label, part) of which the catalog allows few; None if it doesn't, or a learner needs rows written out."""
    codes = config.catalog.different_rows()
    if codes is None or 4 * codes > FEW_DIFFERENT:
        return None
    return 4 * codes if all(takes_weights(s.estimator(SCALED, config.catalog.label)) for s in config.family) else None


def train_job(spark: SparkSession, table: DataFrame, config: TrainConfig) -> RunResult:
    cat = config.catalog
    label = cat.label
    cat.check(table, require_label=True)
    keys = cat.identity_in(table)

    if config.split == "random":
        split = random_split(table, config.train_percent, config.seed)
    else:
        split = hash_split(table, cat.keys_in(table), config.train_percent, bucket_col=config.bucket_col, value_cols=cat.names)
    counts = _split_counts(split, cat, label)
    if counts["bad_labels"]:
        raise CatalogMismatch(f"label {label!r} must be 0 or 1; {counts['bad_labels']} rows are not (null, or no number, included)")
    if counts["train_rows"] == 0:
        raise EmptyInput("no training rows after validation and split")
    if counts["test_rows"] == 0:
        raise EmptyInput("no held-out rows after validation and split: nothing to evaluate or select by")
    if counts["train_pos"] in (0, counts["train_rows"]):
        raise SingleClassLabel(f"label {label!r} has a single class in the training part")
    info = {"total_rows": counts["input_rows"] - counts["rejected_rows"], "total_features": len(cat.names),
            "train_rows": counts["train_rows"], "test_rows": counts["test_rows"]}

    # one exchange; what tells rows apart goes no further than the hash that deals them
    asm = assembler(cat.names)
    few = _few_rows(config)
    weighted = few is not None or not cat.keys_in(table)
    rows = cat.names if weighted else list(dict.fromkeys([*keys, *cat.names]))
    good = valid_rows(split, cat.names).select(*rows, F.col(label).cast("double").alias(label), "part")
    extra = [WEIGHT] if weighted else []
    by = [*rows, label]
    n = train_partitions(good, info["total_rows"])
    if few is not None and cat.keys_in(table):
        n = min(n, -(-few // FEW_ROWS))
    laid = (weighted_layout(good, [*by, "part"], n, WEIGHT) if weighted
            else training_layout(good, by, n, [*cat.names, label, "part"]))
    laid = asm.transform(laid).select(label, "part", FEATURES, *extra).persist(StorageLevel.MEMORY_AND_DISK)
    fit_on = laid if config.scaler_scope == "all" else laid.filter(F.col("part") == "train")
    scaler_model = fit_weighted_scaler(fit_on, WEIGHT) if weighted else scaler().fit(fit_on)
    scaled = scaler_model.transform(laid).select(label, "part", SCALED, *extra).persist(StorageLevel.MEMORY_AND_DISK)
    train = scaled.filter(F.col("part") == "train").select(label, SCALED, *extra)
    test = scaled.filter(F.col("part") == "test").select(label, SCALED, *extra)
    fitted, rows = {}, []
    try:
        scaled.count()  # filled up front so the per-model clocks time the models
        laid.unpersist()
        depth = tree_depth(n)
        for spec in config.family:
            t0 = time.time()
            est = spec.estimator(SCALED, label)
            if est.hasParam("aggregationDepth"):  # same sums, shallower/deeper reduction tree
                est = est.copy({est.getParam("aggregationDepth"): depth})
            if weighted and takes_weights(est):
                model = est.copy({est.weightCol: WEIGHT}).fit(train)
            else:
                model = est.fit(repeated(train, WEIGHT) if weighted else train)
            t1 = time.time()
            scored = model.transform(test)
            preds = scored.select(label, F.col("prediction").cast("int").alias("prediction"),
                                  positive_probability("rawPrediction").alias("raw_score"), *extra)
            m = ev.evaluate_scores(preds, label, "raw_score", "prediction", WEIGHT if weighted else None)
            if config.auc_bins:
                m["auc"] = BinaryClassificationEvaluator(
                    labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC",
                    numBins=config.auc_bins, **({"weightCol": WEIGHT} if weighted else {})).evaluate(scored)
            t2 = time.time()
            fitted[spec.name] = model
            rows.append({
                "model": spec.name, "ordinal": spec.ordinal, "accuracy": m.get("accuracy"),
                "auc_roc": m.get("auc"), "f1_score": m.get("weighted_f1"),
                "positive_f1": m.get("positive_f1"), "recall": m.get("recall"),
                "predicted_positive": m.get("predicted_positive"), "test_rows": m.get("n"),
                "fit_sec": t1 - t0, "score_eval_sec": t2 - t1, "training_time_sec": t2 - t0,
                **tree_stats(model),
            })
    finally:
        laid.unpersist()
        scaled.unpersist()

    board = round_metrics(leaderboard(spark, rows))
    board_rows = [r.asDict() for r in board.collect()]  # one row per model
    winner = select_winner(board).first()["model"]
    board = board.withColumn("is_winner", F.col("model") == F.lit(winner))

    best = pipeline_model([asm, scaler_model, fitted[winner]])
    imps = feature_importances(spark, fitted[winner], cat.names)
    imp_pairs = None if imps is None else [(r["feature"], r["importance"]) for r in imps.collect()]
    report = registry.report_document(board_rows, winner, imp_pairs, cat.names, info)
    rejects = rejected_rows(table, keys, cat.names)

    if config.model_dir:
        registry.save_pipeline(best, f"{config.model_dir}/best_model")
        registry.write_tables({"leaderboard": board, "importances": imps,
                               "run_info": local_frame(spark, [tuple(info.values())], ", ".join(f"{k} bigint" for k in info))}, f"{config.model_dir}/tables")
        registry.write_report_json(spark, report, f"{config.model_dir}/metrics")

    coefs = coefficients(spark, fitted[winner], cat.names)
    return RunResult(board, board_rows, winner, best, fitted, imps, coefs, info, rejects, report)
