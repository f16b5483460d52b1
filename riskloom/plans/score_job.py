"""Batch scoring job: table (or records folder) + saved pipeline → scored rows + rejects (``status``), in one pass.

    python -m riskloom.plans.score_job --input /shared/new/ --format json \
        --model /shared/model/best_model --output /shared/scored --catalog cdc
"""

from __future__ import annotations

import argparse

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog import CDC_CATALOG, DOC_QUALITY_CATALOG, RISK_ROWS_CATALOG, FeatureCatalog
from riskloom.operators.score import REJECTED, SCORED, score_once, score_with_rejects
from riskloom.sources.registry import load_pipeline
from riskloom.sources.tables import read_records

CATALOGS = {"cdc": CDC_CATALOG, "risk_rows": RISK_ROWS_CATALOG, "doc_quality": DOC_QUALITY_CATALOG}


def score_job(spark: SparkSession, table: DataFrame, model: PipelineModel | str,
              catalog: FeatureCatalog) -> tuple[DataFrame, DataFrame]:
    """Score every valid row; rows with a null/NaN feature come back as rejects.

    The catalog check runs first so a missing feature is named before any job starts.
    """
    catalog.check(table)
    pipeline = load_pipeline(model, catalog) if isinstance(model, str) else model
    return score_with_rejects(table, pipeline, catalog)


@dataclass
class ScoreCounts:
    scored: int
    rejected: int


def score_to(spark: SparkSession, table: DataFrame, model: PipelineModel | str, catalog: FeatureCatalog, path: str) -> ScoreCounts:
    """Score a table into ``path``, split by ``status`` (scored / rejected), and count both: the input is read once.

    The counts come from the footers of the files just written.  (An Observation would take them on the way, but
    a session that has made one can no longer score with a model fitted in it: the model's training
    summary drags the session into every task.)
    """
    catalog.check(table)
    pipeline = load_pipeline(model, catalog) if isinstance(model, str) else model
    rows = score_once(table, pipeline, catalog)
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    written = spark.read.schema(rows.schema).parquet(path).groupBy("status").count()
    found = {r["status"]: r["count"] for r in written.collect()}  # two rows
    return ScoreCounts(found.get(SCORED, 0), found.get(REJECTED, 0))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Score a folder of records with a saved pipeline.")
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="json", choices=["json", "csv", "parquet"])
    ap.add_argument("--model", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--catalog", default="cdc", choices=sorted(CATALOGS))
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("riskloom-score-job").getOrCreate()
    catalog = CATALOGS[args.catalog]
    records = read_records(spark, args.input, catalog, args.format)
    counts = score_to(spark, records, args.model, catalog, args.output)
    print(f"scored {counts.scored}, rejected {counts.rejected}")


if __name__ == "__main__":
    main()
