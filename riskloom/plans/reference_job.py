"""The reference's own job on its own table shape: 21 health indicators + ``Diabetes_binary``.

    python -m riskloom.plans.reference_job --input /shared/cdc/ --format csv --model-dir /shared/model

Reads the table under the catalog schema (on the executors), trains the reference's
model family, selects the winner by rounded AUC, saves ``best_model`` and the report
next to it, and prints the report.  Rows need an ``ID`` key (the split is a key hash).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog import CDC_CATALOG
from riskloom.operators.profile import describe_features, label_distribution
from riskloom.plans.train_job import RunResult, TrainConfig, train_job
from riskloom.sources.tables import scan_training


def reference_job(spark: SparkSession, path: str, model_dir: str, fmt: str = "csv",
                  scaler_scope: str = "train", auc_bins: int | None = None) -> RunResult:
    table = scan_training(spark, path, CDC_CATALOG, fmt)
    return train_job(spark, table, TrainConfig(CDC_CATALOG, model_dir=model_dir, scaler_scope=scaler_scope,
                                               auc_bins=auc_bins))


def reference_profile(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reference's printed profile as tables: descriptive statistics and label counts."""
    return (describe_features(table, CDC_CATALOG.names, decimals=6),
            label_distribution(table, CDC_CATALOG.label))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    ap.add_argument("--model-dir", required=True)
    ap.add_argument("--scaler-scope", default="train", choices=["train", "all"])
    ap.add_argument("--auc-bins", type=int, default=None)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("riskloom-reference-job").getOrCreate()
    from riskloom.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    run = reference_job(spark, args.input, args.model_dir, args.format, args.scaler_scope, args.auc_bins)
    print(json.dumps(run.report, indent=2, ensure_ascii=False))


if __name__ == "__main__":
    main()
