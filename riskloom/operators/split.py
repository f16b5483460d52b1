"""Reproducible train/test split and fold assignment by key hash.

``randomSplit`` depends on partitioning (the same seed gives different rows on a
different cluster shape).  A key hash does not, costs one projection, and lets the
split be recomputed by SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.hashing import hash_bucket


def value_parts(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Columns as text that reads the same in every engine: whole numbers as integers, null as '~'.

    Values with a fraction count by their integer part only: the text of a double differs
    between engines, the integer part does not.
    """
    return [F.coalesce(F.col(c).cast("double").cast("bigint").cast("string") if isinstance(df.schema[c].dataType, T.NumericType)
                       else F.col(c).cast("string"), F.lit("~")) for c in cols]


def hash_split(
    df: DataFrame,
    key_cols: Sequence[str] | None = None,
    train_percent: int = 80,
    salt: str = "split",
    bucket_col: str | None = None,
    value_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``split_bucket`` (0-99) and ``part`` ('train' if bucket < train_percent).

    ``bucket_col`` reuses a bucket already carried by the table.  A table without a key is
    split on a hash of ``value_cols``: rows with the same values fall into the same part, which
    also keeps copies of a training row out of the test part.
    """
    if bucket_col is None:
        if not key_cols and not value_cols:
            raise ValueError("hash_split needs key_cols, value_cols or bucket_col")
        parts = list(key_cols) if key_cols else value_parts(df, value_cols)
        df = df.withColumn("split_bucket", hash_bucket(salt, parts, 100))
        bucket_col = "split_bucket"
    part = F.when(F.col(bucket_col) < train_percent, F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn("part", part)


def random_split(df: DataFrame, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Add ``part`` by a seeded draw per row (parity with ``randomSplit``).

    As there, the draw follows partitions and row order: the same rows only from the same layout.
    """
    return df.withColumn("part", F.when(F.rand(seed) * 100 < train_percent, F.lit("train")).otherwise(F.lit("test")))


def fold_assignment(df: DataFrame, key_cols: Sequence[str], num_folds: int = 5, salt: str = "fold",
                    fold_col: str = "fold") -> DataFrame:
    """Add an integer fold in [0, num_folds) for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(fold_col, hash_bucket(salt, list(key_cols), num_folds))
