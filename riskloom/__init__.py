"""riskloom — supervised tabular risk modelling as Spark DataFrame / Spark ML jobs.

Layout:
  catalog        ordered feature specifications (schema, domains, defaults)
  session        session construction and the shared scratch folder
  sources/       scans, fixtures, record parsing, model/report registry
  functions/     reusable Column expressions (key hashing, formatting)
  operators/     profile, quality, features, split, models, score, evaluate, select, explain
  plans/         end-to-end jobs (train_job, score_job) composed from operators
  streaming/     Structured Streaming scorer
"""

from riskloom.catalog import FeatureCatalog, FeatureSpec
from riskloom.errors import (
    CatalogMismatch,
    EmptyInput,
    ModelUnavailable,
    RiskloomError,
    ScratchUnavailable,
    SingleClassLabel,
)

__all__ = [
    "CatalogMismatch",
    "EmptyInput",
    "FeatureCatalog",
    "FeatureSpec",
    "ModelUnavailable",
    "RiskloomError",
    "ScratchUnavailable",
    "SingleClassLabel",
]
