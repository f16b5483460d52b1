"""The trees of personal data and their thresholds take every labelled candidate."""

from pyspark.sql import functions as F

from riskloom.llm import pii


def test_no_candidate_is_left_out(spark, monkeypatch):
    """60,000 candidates, of which one feature settles the label: all are in the fit, and each calibrates once."""
    rows = spark.range(60_000).select(
        "id", F.lit(0).alias("start"), F.lit(9).alias("end"), F.lit(1).alias("kind"), F.lit(True).alias("base"),
        (F.col("id") % 2 == 0).alias("well"), F.array((F.col("id") % 2).cast("double"), (F.col("id") % 40).cast("double")).alias("x"))
    fitted, boosted = [], pii._boosted
    monkeypatch.setattr(pii, "_boosted", lambda train: (fitted.append(train.agg(F.sum("n")).first()[0]), boosted(train))[1])
    trees = pii.fit_trees(rows)
    assert fitted[0] == 60_000
    assert sum(60_000 - n for n in fitted[1:]) == 60_000  # each fold is held out once
    assert 0.5 <= trees.thresholds[1] <= 1


def test_one_candidate(spark):
    rows = spark.range(1).select("id", F.lit(0).alias("start"), F.lit(9).alias("end"), F.lit(1).alias("kind"), F.lit(True).alias("base"),
                                 F.lit(True).alias("well"), F.array(F.lit(1.0)).alias("x"))
    assert pii.fit_trees(rows) is not None
    assert pii.fit_trees(rows.limit(0)) is None
