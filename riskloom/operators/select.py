"""Leaderboard and winner selection.

The winner rule mirrors the reference: highest AUC *rounded to 4 decimals*, ties to
the model listed first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.formatting import percent_text
from riskloom.functions.local import local_frame

LEADERBOARD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("auc_roc", T.DoubleType(), True),
    T.StructField("f1_score", T.DoubleType(), True),
    T.StructField("positive_f1", T.DoubleType(), True),
    T.StructField("recall", T.DoubleType(), True),
    T.StructField("predicted_positive", T.LongType(), True),
    T.StructField("test_rows", T.LongType(), True),
    T.StructField("trees", T.IntegerType(), True),
    T.StructField("root_only_trees", T.IntegerType(), True),
    T.StructField("tree_nodes", T.IntegerType(), True),
    T.StructField("fit_sec", T.DoubleType(), True),
    T.StructField("score_eval_sec", T.DoubleType(), True),
    T.StructField("training_time_sec", T.DoubleType(), True),
])


def leaderboard(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """One row per trained model (bounded by the family size)."""
    data = [tuple(r.get(f.name) for f in LEADERBOARD_SCHEMA.fields) for r in rows]
    return local_frame(spark, data, LEADERBOARD_SCHEMA)


def round_metrics(board: DataFrame) -> DataFrame:
    """Report rounding: metrics to 4 decimals, times to 1."""
    out = board
    for c in ("accuracy", "auc_roc", "f1_score", "positive_f1", "recall"):
        out = out.withColumn(c, F.round(c, 4))
    for c in ("fit_sec", "score_eval_sec", "training_time_sec"):
        out = out.withColumn(c, F.round(c, 1))
    return out


def select_winner(board: DataFrame, auc_col: str = "auc_roc", order_col: str = "ordinal") -> DataFrame:
    """Best by rounded AUC; ties to the lower ordinal."""
    return board.orderBy(F.round(F.col(auc_col), 4).desc_nulls_last(), F.col(order_col).asc()).limit(1)


def auc_percent(board: DataFrame, auc_col: str = "auc_roc") -> DataFrame:
    """Per-model AUC in percent (comparison chart data), joined by model name."""
    return board.select("model", F.round(F.col(auc_col) * 100, 1).alias("auc_pct"),
                        percent_text(auc_col).alias("auc_text"))
