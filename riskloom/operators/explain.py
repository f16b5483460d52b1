"""Explanation: importances, top-k, normalised risk factors, risk bands.

Importance tables have one row per feature (bounded by the catalog); risk factors
and bands are per-row projections plus one small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.local import local_frame

IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("feature", T.StringType(), False),
    T.StructField("importance", T.DoubleType(), False),
])


def feature_importances(spark: SparkSession, model, names: Sequence[str], decimals: int = 6) -> DataFrame | None:
    """Tree-ensemble importances by feature name (they sum to 1); None for other models.

    Extraction problems do not fail a run: they yield None, as a missing importance
    report is not an error of the training itself.
    """
    vec = getattr(model, "featureImportances", None)
    if vec is None:
        return None
    try:
        values = vec.toArray().tolist()
    except Exception:  # noqa: BLE001
        return None
    if len(values) != len(names):
        return None
    rows = [(i, n, round(float(values[i]), decimals)) for i, n in enumerate(names)]
    return local_frame(spark, rows, IMPORTANCE_SCHEMA)


def tree_stats(model) -> dict:
    """Trees, root-only trees and total nodes of a tree ensemble (empty dict otherwise).

    A forest on an imbalanced label can merge sibling leaves with the same predicted
    class until whole trees are a single root node; counting them makes that visible.
    """
    trees = getattr(model, "trees", None)
    if not trees:
        return {}
    return {"trees": len(trees), "root_only_trees": sum(1 for t in trees if t.depth == 0),
            "tree_nodes": sum(t.numNodes for t in trees)}


def coefficients(spark: SparkSession, model, names: Sequence[str]) -> DataFrame | None:
    """Logistic-regression coefficients (on the scaled features) — not importances."""
    coef = getattr(model, "coefficients", None)
    if coef is None:
        return None
    values = coef.toArray().tolist()
    rows = [(i, n, float(values[i])) for i, n in enumerate(names)]
    rows.append((-1, "(intercept)", float(model.intercept)))
    schema = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("feature", T.StringType()),
                           T.StructField("coefficient", T.DoubleType())])
    return local_frame(spark, rows, schema)


def top_k(df: DataFrame, value_col: str, k: int, tie_cols: Sequence[str] = ("feature",),
          ascending_output: bool = False) -> DataFrame:
    """k largest values with rank 1..k; ties broken by ``tie_cols``.

    ``orderBy(...).limit(k)`` plans as a distributed top-k (each task keeps k rows);
    the rank window then runs over those k rows only.
    """
    order = [F.col(value_col).desc()] + [F.col(c).asc() for c in tie_cols]
    best = df.orderBy(*order).limit(k)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    if ascending_output:
        return ranked.orderBy(F.col("rank").desc())
    return ranked.orderBy("rank")


@dataclass(frozen=True)
class RiskFactor:
    """A named per-row factor scaled into [0, 1]."""

    name: str
    expr: Column


# --- Fixed values: the reference's normalised risk-factor profile (BMI/50 capped at 1,
# --- general health (x-1)/4, age (x-1)/12, 1 - physical activity, the rest as is).
def reference_risk_factors() -> list[RiskFactor]:
    c = F.col
    return [
        RiskFactor("BMI", F.least(c("BMI") / 50.0, F.lit(1.0))),
        RiskFactor("HighBP", c("HighBP").cast("double")),
        RiskFactor("HighChol", c("HighChol").cast("double")),
        RiskFactor("Smoker", c("Smoker").cast("double")),
        RiskFactor("GenHlth", (c("GenHlth") - 1) / 4.0),
        RiskFactor("Age", (c("Age") - 1) / 12.0),
        RiskFactor("Sedentary", 1.0 - c("PhysActivity").cast("double")),
        RiskFactor("HeartDisease", c("HeartDiseaseorAttack").cast("double")),
    ]


def fixture_risk_factors() -> list[RiskFactor]:
    """Same construction over the ``risk_rows`` stand-in features."""
    c = F.col
    return [
        RiskFactor("qty", F.least(c("qty") / 50.0, F.lit(1.0))),
        RiskFactor("discount", c("discount_pct") / 10.0),
        RiskFactor("returned", c("is_returned").cast("double")),
        RiskFactor("priority", (c("priority") - 1) / 4.0),
        RiskFactor("ship_month", (c("ship_month") - 1) / 11.0),
        RiskFactor("open_order", c("order_open").cast("double")),
        RiskFactor("unfinished", 1.0 - c("is_finished").cast("double")),
        RiskFactor("same_nation", c("same_nation").cast("double")),
    ]


def risk_profile(df: DataFrame, key_cols: Sequence[str], factors: Sequence[RiskFactor],
                 decimals: int = 6) -> DataFrame:
    """Long form (keys, factor, value): one output row per key and factor."""
    items = [F.struct(F.lit(f.name).alias("factor"), F.round(f.expr.cast("double"), decimals).alias("value"))
             for f in factors]
    return (df.select(*key_cols, F.explode(F.array(*items)).alias("f"))
            .select(*key_cols, "f.factor", "f.value"))


# --- Fixed values: risk gauge steps on probability × 100: [0, 33) low, [33, 66) medium,
# --- [66, 100] high.
BAND_EDGES = (33.0, 66.0)


def risk_band(probability: Column) -> Column:
    pct = probability * 100.0
    return (F.when(pct < BAND_EDGES[0], F.lit("low"))
            .when(pct < BAND_EDGES[1], F.lit("medium"))
            .otherwise(F.lit("high")))


def band_counts(df: DataFrame, probability_col: str) -> DataFrame:
    return (df.filter(F.col(probability_col).isNotNull())
            .groupBy(risk_band(F.col(probability_col)).alias("band"))
            .agg(F.count(F.lit(1)).alias("rows")))
