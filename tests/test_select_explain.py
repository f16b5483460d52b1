"""Winner rule, top-k, risk bands and risk profile."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain as ex
from riskloom.operators.select import leaderboard, select_winner


def test_winner_rounds_auc_and_prefers_first(spark):
    board = leaderboard(spark, [
        {"model": "B", "ordinal": 2, "auc_roc": 0.81234},
        {"model": "A", "ordinal": 1, "auc_roc": 0.81226},   # equal at 4 dp → lower ordinal wins
        {"model": "C", "ordinal": 3, "auc_roc": 0.8122},
    ])
    assert select_winner(board).first()["model"] == "A"


def test_winner_by_auc(spark):
    board = leaderboard(spark, [{"model": "A", "ordinal": 1, "auc_roc": 0.80},
                                {"model": "B", "ordinal": 2, "auc_roc": 0.83}])
    assert select_winner(board).first()["model"] == "B"


def test_top_k_orders_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", 0.2), ("b", 0.5), ("c", 0.2), ("d", 0.1)], "feature string, importance double")
    top = [(r["rank"], r["feature"]) for r in ex.top_k(df, "importance", 3).collect()]
    assert top == [(1, "b"), (2, "a"), (3, "c")]
    asc = [r["feature"] for r in ex.top_k(df, "importance", 3, ascending_output=True).collect()]
    assert asc == ["c", "a", "b"]


@pytest.mark.parametrize("p,band", [(0.0, "low"), (0.3299, "low"), (0.33, "medium"), (0.6599, "medium"),
                                    (0.66, "high"), (1.0, "high")])
def test_risk_band_edges(spark, p, band):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(ex.risk_band(F.col("p")).alias("b")).first()["b"] == band


def test_reference_risk_profile(spark):
    rec = spark.createDataFrame(
        [("x", 60.0, 1.0, 0.0, 1.0, 5.0, 13.0, 0.0, 1.0)],
        "ID string, BMI double, HighBP double, HighChol double, Smoker double, GenHlth double, Age double, "
        "PhysActivity double, HeartDiseaseorAttack double")
    got = {r["factor"]: r["value"] for r in ex.risk_profile(rec, ["ID"], ex.reference_risk_factors()).collect()}
    assert got == {"BMI": 1.0, "HighBP": 1.0, "HighChol": 0.0, "Smoker": 1.0, "GenHlth": 1.0, "Age": 1.0,
                   "Sedentary": 1.0, "HeartDisease": 1.0}
