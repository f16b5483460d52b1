"""Feature assembly and standardisation.

Spark ML stages do the work (JVM-side vector projections); helpers expose their fitted
state as plain DataFrames and convert vectors to arrays at the public edge.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.errors import EmptyInput
from riskloom.functions.local import local_frame

FEATURES = "features"
SCALED = "scaled_features"


def assembler(cols: Sequence[str], output_col: str = FEATURES, handle_invalid: str = "skip") -> VectorAssembler:
    """Vector of the listed columns in order; ``skip`` drops rows with null/NaN inputs."""
    return VectorAssembler(inputCols=list(cols), outputCol=output_col, handleInvalid=handle_invalid)


def scaler(input_col: str = FEATURES, output_col: str = SCALED) -> StandardScaler:
    """Standardise with the training mean and the *sample* standard deviation."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True)


def fit_scaler(df: DataFrame, input_col: str = FEATURES, output_col: str = SCALED) -> StandardScalerModel:
    """Fit the scaler; an empty input raises ``EmptyInput`` instead of aborting a job."""
    try:
        model = scaler(input_col, output_col).fit(df)
    except Exception:
        if df.isEmpty():  # asked only after a failure: the input plan runs once
            raise EmptyInput("cannot fit the scaler on an empty table") from None
        raise
    if model.mean.size == 0:
        raise EmptyInput("cannot fit the scaler on an empty table")
    return model


def fit_weighted_scaler(df: DataFrame, weight_col: str, input_col: str = FEATURES, output_col: str = SCALED) -> StandardScalerModel:
    """The scaler of a table whose rows stand for ``weight_col`` equal rows each: one pass over the weighted rows.

    The summariser divides squared deviations by W - Σw²/W (W: sum of weights); times that and over
    W - 1 it is the sample variance of the table with every row written out.
    """
    w = F.col(weight_col)
    row = df.select(Summarizer.metrics("mean", "variance").summary(F.col(input_col), w).alias("m"),
                    F.sum(w).alias("all"), F.sum(w * w).alias("squares")).first()
    if not row["all"]:
        raise EmptyInput("cannot fit the scaler on an empty table")
    among = row["all"] - row["squares"] / row["all"]
    variance = row["m"]["variance"].toArray()
    # one weighted row, or one row at all: no deviation
    variance = variance * among / (row["all"] - 1) if among > 0 and row["all"] > 1 else np.zeros(len(variance))
    sc = df.sparkSession.sparkContext
    fitted = scaler(input_col, output_col)
    java = sc._jvm.org.apache.spark.ml.feature.StandardScalerModel(
        fitted.uid, _py2java(sc, DenseVector(variance ** 0.5)), _py2java(sc, row["m"]["mean"]))
    return fitted._copyValues(StandardScalerModel(java))


def scaler_stats(spark: SparkSession, model: StandardScalerModel, names: Sequence[str]) -> DataFrame:
    """(ordinal, feature, mean, std) of a fitted scaler; one row per feature."""
    mean = model.mean.toArray().tolist()
    std = model.std.toArray().tolist()
    rows = [(i, n, float(mean[i]), float(std[i])) for i, n in enumerate(names)]
    schema = T.StructType([
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("feature", T.StringType(), False),
        T.StructField("mean", T.DoubleType(), False),
        T.StructField("std", T.DoubleType(), False),
    ])
    return local_frame(spark, rows, schema)


def vector_columns(df: DataFrame, vector_col: str, names: Sequence[str], keep: Sequence[str] = (),
                   decimals: int | None = None) -> DataFrame:
    """Spread a vector column into one double column per name (public edge, no VectorUDT)."""
    arr = vector_to_array(F.col(vector_col))
    out = df.select(*keep, arr.alias("_v"))
    cols = []
    for i, n in enumerate(names):
        c = F.col("_v")[i]
        cols.append((F.round(c, decimals) if decimals is not None else c).alias(n))
    return out.select(*keep, *cols)
