"""Scoring tables with a fitted pipeline, decisions and the SQL form of a linear model
(C1, M6, M7, N8, J3-J5).

Scoring is a narrow transformation (assembler → scaler → model projections): no
shuffle, fused into the scan's stage.  Rows the assembler would silently skip are
returned separately by ``quality.rejected_rows`` so nothing vanishes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.catalog import FeatureCatalog
from riskloom.operators.quality import invalid_names, is_invalid, rejected_rows, valid_rows

AT_RISK = "at_risk"
NO_RISK = "no_significant_risk"


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def score_table(df: DataFrame, model: PipelineModel, key_cols: Sequence[str],
                extra_cols: Sequence[str] = ()) -> DataFrame:
    """keys (+ extra columns), ``prediction`` int, ``probability`` of class 1, ``raw_score``."""
    scored = model.transform(df)
    return scored.select(
        *key_cols, *extra_cols,
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability("probability").cast("double").alias("probability"),
        vector_to_array(F.col("rawPrediction"))[1].cast("double").alias("raw_score"),
    )


def score_with_rejects(df: DataFrame, model: PipelineModel, catalog: FeatureCatalog,
                       extra_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(scored valid rows, rejected rows with the offending columns).

    Rows are told apart by their key, or by their features where the table has no key.
    """
    keys = catalog.identity_in(df)
    good = valid_rows(df, catalog.names)
    return (score_table(good, model, keys, extra_cols),
            rejected_rows(df, keys, catalog.names))


#: Values of ``status`` in a table of all records.
SCORED, REJECTED = "scored", "rejected"


def score_once(df: DataFrame, model: PipelineModel, catalog: FeatureCatalog, extra_cols: Sequence[str] = ()) -> DataFrame:
    """Every row, scored or not, in one pass: identity (+ extra columns), status, prediction, probability,
    raw_score, bad_columns.

    A row with a null/NaN feature is 'rejected': its scores are null and ``bad_columns`` names
    the features; for the others that list is empty.  Such features pass through the model as 0,
    which keeps the assembler from dropping the row.
    """
    identity = [*catalog.identity_in(df), *extra_cols]
    kept = [f"kept {i}" for i in range(len(identity))]
    bad = invalid_names(df, catalog.names)
    whole = [F.when(is_invalid(df, c), F.lit(0.0)).otherwise(F.col(c).cast("double")).alias(c) for c in catalog.names]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(identity, kept)], bad.alias("bad_columns"), *whole)
    out = score_table(rows, model, kept, ["bad_columns"])
    fine = F.size("bad_columns") == 0
    return out.select(*[F.col(f"`{k}`").alias(c) for c, k in zip(identity, kept)],
                      F.when(fine, SCORED).otherwise(REJECTED).alias("status"),
                      *[F.when(fine, F.col(c)).alias(c) for c in ("prediction", "probability", "raw_score")], "bad_columns")


def decision(score: Column, threshold: float = 0.5) -> Column:
    """1 when the score is strictly above the threshold (Spark ML's rule), else 0."""
    return (score > F.lit(threshold)).cast("int")


def verdict(prediction: Column) -> Column:
    return F.when(prediction == 1, F.lit(AT_RISK)).otherwise(F.lit(NO_RISK))


def verdicts(df: DataFrame, score_col: str, threshold: float = 0.5) -> DataFrame:
    """Adds ``prediction`` and ``verdict`` for a probability column."""
    pred = decision(F.col(score_col), threshold)
    return df.withColumn("prediction", pred).withColumn("verdict", verdict(F.col("prediction")))


def linear_margin(coefficients: Mapping[str, float], intercept: float) -> Column:
    """intercept + Σ w_j·x_j as a Column (a logistic model exported as an expression)."""
    z = F.lit(float(intercept))
    for name, w in coefficients.items():
        z = z + F.lit(float(w)) * F.col(name).cast("double")
    return z


def linear_probability(coefficients: Mapping[str, float], intercept: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_margin(coefficients, intercept)))
