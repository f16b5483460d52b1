"""Profiling: row counts, schema, descriptive statistics, label distribution.

Every profile is one aggregation pass (partial aggregation map-side, a tiny final
merge), never a driver-side loop over columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.local import local_frame


def split_counts(df: DataFrame, part_col: str = "part", label_col: str | None = None) -> DataFrame:
    """Rows (and positives) per split part plus an ``all`` row: one ``rollup`` aggregation."""
    cols = [F.col(part_col).alias("part")]
    aggs = [F.count(F.lit(1)).alias("rows")]
    if label_col:
        cols.append(F.col(label_col).cast("long").alias("_label"))
        aggs.append(F.sum("_label").alias("positives"))
    rolled = df.select(*cols).rollup("part").agg(*aggs, F.grouping("part").alias("_total"))
    return rolled.select(F.when(F.col("_total") == 1, F.lit("all")).otherwise(F.col("part")).alias("part"),
                         *[a for a in ("rows", "positives") if a in rolled.columns])


def schema_report(spark: SparkSession, df: DataFrame, with_counts: bool = False) -> DataFrame:
    """(ordinal, column_name, data_type, nullable) for every column.

    ``with_counts`` adds ``non_null_rows`` per column from one aggregate over the table
    (unpivoted with ``stack``), so the report also shows which columns carry gaps.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ])
    report = local_frame(spark, rows, schema)
    if not with_counts:
        return report
    wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    args = ", ".join(f"{i}, c{i}" for i in range(len(df.schema.fields)))
    counts = wide.selectExpr(f"stack({len(df.schema.fields)}, {args}) AS (ordinal, non_null_rows)")
    return report.join(counts, "ordinal")


def describe_features(df: DataFrame, cols: Sequence[str], decimals: int | None = None) -> DataFrame:
    """count / mean / sample stddev / min / max per column, in long form.

    Unlike ``DataFrame.describe`` (strings), values stay numeric.  The columns are
    unpivoted in the scan (one struct per feature, exploded) and aggregated by feature:
    five aggregates over a 21-key grouping stay inside whole-stage codegen, where one
    105-aggregate row would exceed its field limit and fall back to interpretation.
    Partial aggregation runs map-side, so the shuffle carries one row per feature and task.
    """
    items = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
             for i, c in enumerate(cols)]
    long = df.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    out = long.groupBy("ordinal", "feature").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("stddev"),
        F.min("x").alias("min_value"), F.max("x").alias("max_value"))
    if decimals is not None:
        for c in ("mean", "stddev", "min_value", "max_value"):
            out = out.withColumn(c, F.round(c, decimals))
    return out


def label_distribution(df: DataFrame, label_col: str, decimals: int = 6) -> DataFrame:
    """Rows per label value and their share of all rows.

    Rows are counted once by label; the total is the sum of these counts, joined on a key that
    is 0 in every row - computed from the row, so that it stays a join key, and from one row a
    label, so that a label with many values (a regression target by mistake) never meets in one task.
    """
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.withColumn("_all", F.pmod(F.xxhash64("label"), F.lit(1)))
    total = counts.groupBy("_all").agg(F.sum("rows").alias("_n"))
    return counts.join(total, "_all").select("label", "rows", F.round(F.col("rows") / F.col("_n"), decimals).alias("share"))


def dataset_info(df: DataFrame, part_col: str, n_features: int) -> DataFrame:
    """total_rows, total_features, train_rows, test_rows in one conditional aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(n_features).cast("long").alias("total_features"),
        F.count(F.when(F.col(part_col) == "train", 1)).alias("train_rows"),
        F.count(F.when(F.col(part_col) == "test", 1)).alias("test_rows"),
    )
