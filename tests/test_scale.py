"""Behaviour under skew: one key / value / group of copies holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.operators.partitioning import training_layout, tree_depth
from riskloom.sources.tables import zip_features_target


def _skewed(spark, n=30000):
    # a third of the rows share key 0 and score 0.5; the rest are distinct
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col("id") / n).alias("score"),
        (F.col("id") % 7 < 2).cast("int").alias("label"))


def test_layout_spreads_a_hot_key(spark):
    df = _skewed(spark).withColumn("id", F.monotonically_increasing_id())
    sizes = [len(p) for p in training_layout(df, ["k", "score", "label", "id"], 8).rdd.glom().collect()]
    assert sum(sizes) == 30000 and max(sizes) <= 1.15 * 30000 / 8


def test_layout_does_not_depend_on_input_partitions(spark):
    df = _skewed(spark, 3000).withColumn("id", F.col("score") * 7)
    by = ["k", "score", "label", "id"]
    laid = [training_layout(df.repartition(n), by, 4).rdd.glom().collect() for n in (1, 4, 16)]
    assert laid[0] == laid[1] == laid[2]


def test_auc_exact_with_hot_score(spark):
    df = _skewed(spark)
    rows = [(r["score"], r["label"]) for r in df.collect()]
    pos = sorted(s for s, y in rows if y == 1)
    neg = sorted(s for s, y in rows if y == 0)
    import bisect
    wins = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p))
               for p in pos)
    expect = wins / (len(pos) * len(neg))
    counts = ev.score_label_counts(df, "score", "label")
    assert counts.filter(F.col("score") == 0.5).count() == 1      # the hot score is one row after grouping
    got = ev.auc_exact(df, "score", "label", num_ranges=8).first()["auc"]
    assert got == pytest.approx(expect, abs=1e-12)


def test_zip_refuses_duplicate_keys(spark):
    feats = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 0.3)], "k int, x double")
    targets = spark.createDataFrame([(1, 1), (2, 0)], "k int, y int")
    zipped = zip_features_target(feats, targets, ["k"])          # no job yet: the check is part of the plan
    with pytest.raises(Exception, match="not unique"):
        zipped.count()
    with pytest.raises(Exception, match="targets key"):
        zip_features_target(targets, feats, ["k"]).collect()
    ok = zip_features_target(feats.dropDuplicates(["k"]), targets, ["k"])
    assert ok.count() == 2


def test_tree_depth_follows_partitions():
    assert [tree_depth(n) for n in (1, 1024, 1025, 32_768, 32_769)] == [2, 2, 3, 3, 4]
