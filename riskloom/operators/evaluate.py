"""Evaluation: confusion counts, accuracy, weighted F1, exact AUC.

Scored rows are reduced once to cells - positives and negatives per (score, prediction),
partially aggregated map-side, so a hot score collapses to one row - and every metric is
read from the cells.  AUC is exact (tie-aware Mann-Whitney), without an unpartitioned sort:

1. Spark's range partitioner on (group, score) deals the distinct scores into
   ``spark.sql.shuffle.partitions`` ranges, balanced within each group; any ranges that
   follow the score order give the same exact answer;
2. running negative count inside each range (window partitioned by range), reduced to
   per-range totals; the negatives of all lower ranges are a prefix over those totals;
3. AUC = Σ pos·(neg_below + neg_tied/2) / (P·N).

The binned curve (``roc_binned``) ranks the distinct scores the same way - rank inside the range
plus the ranks of the ranges above - and joins runs of equal length into one point each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import drop_scratch, scratch_path


def confusion_counts(df: DataFrame, label_col: str, prediction_col: str,
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction) — the input of every threshold metric."""
    return (df.filter(F.col(label_col).isNotNull())
            .groupBy(*group_cols, F.col(label_col).cast("int").alias("label"),
                     F.col(prediction_col).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("rows")))


def _metrics(totals: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Metrics from n, correct, tp1, tp0, sup1, sup0, pp1, pp0; without rows every ratio is null."""
    def f1(tp, sup, pp):
        return F.when(F.col(sup) + F.col(pp) > 0, F.lit(2.0) * F.col(tp) / (F.col(sup) + F.col(pp))).otherwise(0.0)

    some = F.col("n") > 0
    return totals.select(
        *group_cols,
        F.col("n").cast("long").alias("n"),
        F.when(some, F.col("correct") / F.col("n")).alias("accuracy"),
        F.when(some, (F.col("sup0") * f1("tp0", "sup0", "pp0") + F.col("sup1") * f1("tp1", "sup1", "pp1"))
               / F.col("n")).alias("weighted_f1"),
        F.when(some, f1("tp1", "sup1", "pp1")).alias("positive_f1"),
        F.when(F.col("sup1") > 0, F.col("tp1") / F.col("sup1")).alias("recall"),
        F.col("pp1").cast("long").alias("predicted_positive"),
    )


def _total(rows, cond=None):
    return F.coalesce(F.sum(F.when(cond, rows) if cond is not None else rows), F.lit(0)).cast("double")


def metrics_from_confusion(conf: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """accuracy, support-weighted F1 (both classes), positive F1, recall, predicted positives."""
    lab, pred, rows = F.col("label"), F.col("prediction"), F.col("rows")
    totals = conf.groupBy(*group_cols).agg(
        _total(rows).alias("n"), _total(rows, lab == pred).alias("correct"),
        _total(rows, (lab == 1) & (pred == 1)).alias("tp1"), _total(rows, (lab == 0) & (pred == 0)).alias("tp0"),
        _total(rows, lab == 1).alias("sup1"), _total(rows, lab == 0).alias("sup0"),
        _total(rows, pred == 1).alias("pp1"), _total(rows, pred == 0).alias("pp0"))
    return _metrics(totals, group_cols)


def score_cells(df: DataFrame, label_col: str, score_col: str, prediction_col: str,
                group_cols: Sequence[str] = (), weight_col: str | None = None) -> DataFrame:
    """Positives and negatives per (group, score, prediction): the one pass over scored rows.

    With ``weight_col`` a row counts as that many equal rows.
    """
    lab = F.col(label_col)
    if weight_col:
        rows = lambda mine: F.coalesce(F.sum(F.when(mine, F.col(weight_col))), F.lit(0)).cast("bigint")
    else:
        rows = lambda mine: F.count(F.when(mine, 1))
    return (df.filter(lab.isNotNull() & F.col(score_col).isNotNull())
            .groupBy(*group_cols, F.col(score_col).cast("double").alias("score"),
                     F.col(prediction_col).cast("int").alias("prediction"))
            .agg(rows(lab == 1).alias("pos"), rows(lab != 1).alias("neg")))


def metrics_from_cells(cells: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The same metrics from (score, prediction, pos, neg) cells."""
    pos, neg, hit = F.col("pos"), F.col("neg"), F.col("prediction") == 1
    totals = cells.groupBy(*group_cols).agg(
        _total(pos + neg).alias("n"), _total(F.when(hit, pos).otherwise(neg)).alias("correct"),
        _total(pos, hit).alias("tp1"), _total(neg, ~hit).alias("tp0"), _total(pos).alias("sup1"), _total(neg).alias("sup0"),
        _total(pos + neg, hit).alias("pp1"), _total(pos + neg, ~hit).alias("pp0"))
    return _metrics(totals, group_cols)


def score_label_counts(df: DataFrame, score_col: str, label_col: str,
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    lab = F.col(label_col)
    return (df.filter(lab.isNotNull() & F.col(score_col).isNotNull())
            .groupBy(*group_cols, F.col(score_col).cast("double").alias("score"))
            .agg(F.count(F.when(lab == 1, 1)).alias("pos"), F.count(F.when(lab != 1, 1)).alias("neg")))


def auc_from_counts(counts: DataFrame, group_cols: Sequence[str] = (), num_ranges: int | None = None) -> DataFrame:
    """Exact AUC per group from (score, pos, neg) rows.

    Ranges come from Spark's range partitioner on (group, score), ``spark.sql.shuffle.partitions``
    of them unless told otherwise, so every group gets ranges in proportion to its distinct scores;
    partition ids follow (group, score) order, also where AQE merges neighbours, which is all the
    prefix step needs.
    """
    n = num_ranges or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(n, *group_cols, "score").withColumn("range_id", F.spark_partition_id())
    return _auc_over_ranges(ranged, group_cols)


def _auc_over_ranges(ranged: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Exact AUC from (group, score, pos, neg, range_id) rows.

    ``range_id`` must increase with the score inside each group.  Per range r:
    P_r = Σ pos, N_r = Σ neg, L_r = Σ pos·(neg below within r + neg tied / 2).  Then
    U = Σ_r (L_r + P_r · Σ_{r' < r} N_r'): the cross-range term is a prefix over the
    per-range totals (a few rows per group), so no row-level join or second pass over
    the scores is needed.
    """
    within = (Window.partitionBy(*group_cols, "range_id").orderBy("score")
              .rowsBetween(Window.unboundedPreceding, -1))
    pos = F.col("pos").cast("double")
    local = ranged.withColumn("neg_before", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    ranges = local.groupBy(*group_cols, "range_id").agg(
        F.sum("pos").alias("p_r"),
        F.sum("neg").alias("n_r"),
        F.sum(pos * (F.col("neg_before") + F.col("neg") / 2.0)).alias("l_r"),
    )
    lower = (Window.partitionBy(*group_cols).orderBy("range_id")
             .rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("n_lower", F.coalesce(F.sum("n_r").over(lower), F.lit(0)))
    agg = ranges.groupBy(*group_cols).agg(
        F.sum(F.col("l_r") + F.col("p_r").cast("double") * F.col("n_lower")).alias("u"),
        F.sum("p_r").alias("n_pos"),
        F.sum("n_r").alias("n_neg"),
    )
    single = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    return agg.select(
        *group_cols,
        F.when(~single, F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"),
        F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"),
        single.alias("single_class"),
    )


def auc_exact(df: DataFrame, score_col: str, label_col: str, group_cols: Sequence[str] = (),
              num_ranges: int | None = None) -> DataFrame:
    """Exact area under ROC per group; null (and ``single_class``) when a class is absent."""
    return auc_from_counts(score_label_counts(df, score_col, label_col, group_cols), group_cols, num_ranges)


def roc_binned(df: DataFrame, score_col: str, label_col: str, bins: int = 1000,
               group_cols: Sequence[str] = ()) -> DataFrame:
    """The ROC curve with about ``bins`` points per group: group, point, threshold, tp, fp, tpr, fpr.

    Of D distinct scores, runs of max(1, D div bins) neighbours, from the highest down, make one
    point each, so a curve has fewer than 2 x ``bins`` points, and point 0 is the origin (no
    threshold).  A point counts the rows with a score of at least its threshold.  The runs follow the
    global rank of the scores, so the curve doesn't depend on partitioning.  Without rows
    of a class its rate is null; rows without score or label are left out; without rows there is no point.

    The distinct scores are written once, ranged by (group, score), so that ranks inside a range
    and the ranges' totals come from the same ranges; only the points are kept.
    """
    spark = df.sparkSession
    by = list(group_cols)
    root = scratch_path(spark, "roc", uuid.uuid4().hex[:12])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = score_label_counts(df, score_col, label_col, by)
    ranged = counts.repartitionByRange(n, *by, F.desc("score")).withColumn("range_id", F.spark_partition_id())
    ranged.write.parquet(f"{root}/scores")
    cells = spark.read.schema(ranged.schema).parquet(f"{root}/scores")

    # from here on one row per range and group, then one per point
    group, higher = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cells.groupBy(*by, "range_id").agg(F.count(F.lit(1)).alias("n_scores"))
    ranges = ranges.select(*[F.col(c).alias(f"of_{i}") for i, c in enumerate(by)], F.col("range_id").alias("range_of"),
                           F.coalesce(F.sum("n_scores").over(higher), F.lit(0)).alias("n_higher"),
                           F.greatest(F.floor(F.sum("n_scores").over(group) / bins), F.lit(1)).alias("run"))
    same = F.col("range_id") == F.col("range_of")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"of_{i}"))
    rank = F.col("n_higher") + F.row_number().over(Window.partitionBy(*by, "range_id").orderBy(F.desc("score")))
    ranked = cells.join(ranges, same).withColumn("point", F.floor((rank - 1) / F.col("run")) + 1)
    points = ranked.groupBy(*by, "point").agg(F.min("score").alias("threshold"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    first = cells.select(*by).distinct() if by else cells.limit(1).select()
    points = points.unionByName(first.select(*by, F.lit(0).cast("bigint").alias("point"), F.lit(None).cast("double").alias("threshold"),
                                             F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg")))
    upto = group.orderBy("point").rowsBetween(Window.unboundedPreceding, 0)
    points = points.select(*by, "point", "threshold", F.sum("pos").over(upto).alias("tp"), F.sum("neg").over(upto).alias("fp"),
                           F.sum("pos").over(group).alias("n_pos"), F.sum("neg").over(group).alias("n_neg"))
    points = points.select(*by, "point", "threshold", "tp", "fp",
                           F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).alias("tpr"),
                           F.when(F.col("n_neg") > 0, F.col("fp") / F.col("n_neg")).alias("fpr"))
    points.write.parquet(f"{root}/points")
    drop_scratch(spark, f"{root}/scores")
    return spark.read.schema(points.schema).parquet(f"{root}/points")


def auc_binned(points: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Area under the points of ``roc_binned`` per group (trapezoids); null where a class is absent.

    It differs from the exact area by at most half of what falls into single points: the pairs of
    a positive and a negative row whose scores share one.
    """
    order = Window.partitionBy(*group_cols).orderBy("point")
    strips = points.withColumn("strip", (F.col("fpr") - F.lag("fpr").over(order)) * (F.col("tpr") + F.lag("tpr").over(order)) / 2)
    return strips.groupBy(*group_cols).agg(F.sum("strip").alias("auc"), F.max("point").alias("n_points"))


def evaluate_groups(df: DataFrame, label_col: str, score_col: str, prediction_col: str,
                    group_cols: Sequence[str]) -> DataFrame:
    """All metrics per group from one aggregation of the scored rows (its exchange is reused)."""
    cells = score_cells(df, label_col, score_col, prediction_col, group_cols)
    counts = cells.groupBy(*group_cols, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return metrics_from_cells(cells, group_cols).join(auc_from_counts(counts, group_cols), list(group_cols))


def evaluate_scores(df: DataFrame, label_col: str, score_col: str, prediction_col: str, weight_col: str | None = None) -> dict:
    """All metrics of one scored table as a dict (two one-row results reach the driver).

    Without scored rows n is 0 and every ratio None.
    """
    cells = score_cells(df, label_col, score_col, prediction_col, weight_col=weight_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics = metrics_from_cells(cells).first().asDict()
        counts = cells.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        auc = auc_from_counts(counts).first()
    finally:
        cells.unpersist()
    return metrics | {"auc": auc["auc"] if auc["n_pos"] is not None else None,
                      "single_class": True if auc["n_pos"] is None else bool(auc["single_class"])}
