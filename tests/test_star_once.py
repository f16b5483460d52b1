"""The star join runs once for a job that reads its rows several times, and what a task holds doesn't grow."""

from collections import Counter

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from riskloom.operators import models as M
from riskloom.operators.features import SCALED, assembler
from riskloom.operators.partitioning import train_partitions, training_layout
from riskloom.plans import registered as R
from riskloom.sources import fixtures as fx


def _copy(spark, folder):
    """Small star tables of their own, so that no other test has trained on them."""
    for t in fx.RISK_INPUTS:
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return folder


def test_star_join_runs_once(spark, tmp_dir, monkeypatch):
    calls, rows = Counter(), fx.risk_rows
    sf = _copy(spark, tmp_dir)

    def counted(*args):
        calls["star join"] += 1
        return rows(*args)

    monkeypatch.setattr(fx, "risk_rows", counted)
    R.score_batch_rejects(spark, sf).count()
    R.score_trees_q(spark, sf).count()
    R.score_stream_rejects(spark, sf).count()
    assert calls["star join"] == 1
    monkeypatch.setattr(R.fx, "risk_rows", counted)
    R.profile_incremental(spark, sf).count()
    assert calls["star join"] == 2


def test_layout_ships_the_hash_instead_of_the_key(spark):
    df = spark.range(3000).select(F.concat(F.lit("key "), F.col("id")).alias("k"), (F.col("id") % 3).alias("x"), (F.col("id") % 2).alias("y"))
    whole = training_layout(df, ["k", "x", "y"], 4).select("x", "y").rdd.glom().collect()
    assert training_layout(df, ["k", "x", "y"], 4, ["x", "y"]).rdd.glom().collect() == whole
    assert "key " not in str(training_layout(df, ["k", "x", "y"], 4, ["x", "y"]).columns)


def test_partitions_grow_with_rows(spark):
    df = spark.range(1)
    assert train_partitions(df) == train_partitions(df, 16_000_000) == 16
    assert train_partitions(df, 216_000_000) == 216


def test_validation_counts_equal_rows(spark, monkeypatch):
    """Boosting reads a handful of weighted rows, forests read each row as often as it occurs."""
    rows = spark.range(2000).select((F.col("id") % 2).alias("x"), ((F.col("id") % 2 == 1) & (F.col("id") % 7 > 0)).cast("int").alias("label"),
                                    (F.col("id") % 3).cast("int").alias("fold"))
    sizes = []

    class Boosting(GBTClassifier):
        def _fit(self, df):
            sizes.append(("weighted", df.count(), df.agg(F.sum("row_weight")).first()[0]))
            return super()._fit(df)

    class Forest(RandomForestClassifier):
        def _fit(self, df):
            sizes.append(("written", df.count(), None))
            return super()._fit(df)

    found = M.cross_validate([(Boosting(featuresCol=SCALED, labelCol="label", maxIter=2), [{}]),
                              (Forest(featuresCol=SCALED, labelCol="label", numTrees=3, seed=1), [{}])],
                             assembler(["x"]).transform(rows), "label", num_folds=3, parallel=1)
    assert all(r["mean_auc"] > 0.8 for r in found)
    weighted = [s for s in sizes if s[0] == "weighted"]
    assert all(n <= 8 for _, n, _ in weighted) and sum(w for _, _, w in weighted) == 4000
    assert sum(n for kind, n, _ in sizes if kind == "written") == 4000
