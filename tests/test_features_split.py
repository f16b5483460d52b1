"""Assembly, standardisation and the key-hash split."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.errors import EmptyInput
from riskloom.operators.features import assembler, fit_scaler, scaler_stats, vector_columns
from riskloom.operators.split import fold_assignment, hash_split
from riskloom.sources import fixtures as fx


def test_constant_column_scales_to_zero(spark):
    df = assembler(["u", "v"]).transform(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "u double, v double"))
    model = fit_scaler(df)
    out = [tuple(round(x, 4) for x in r) for r in vector_columns(model.transform(df), "scaled_features", ["u", "v"]).collect()]
    assert sorted(out) == [(-0.7071, 0.0), (0.7071, 0.0)]


def test_scaler_uses_mean_and_sample_std(spark):
    base = fx.risk_rows_table(spark, SF_SMALL)
    cols = ["qty", "price", "discount_pct"]
    model = fit_scaler(assembler(cols).transform(base))
    stats = {r["feature"]: (r["mean"], r["std"]) for r in scaler_stats(spark, model, cols).collect()}
    expect = base.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    for c in cols:
        assert stats[c][0] == pytest.approx(expect[f"m_{c}"], rel=1e-12)
        assert stats[c][1] == pytest.approx(expect[f"s_{c}"], rel=1e-12)


def test_scaler_on_empty_table_raises(spark):
    df = assembler(["u"]).transform(spark.createDataFrame([], "u double"))
    with pytest.raises(EmptyInput):
        fit_scaler(df)


def test_split_does_not_depend_on_partitioning(spark):
    orders = fx.table(spark, SF_SMALL, "orders").select("o_orderkey")
    one = hash_split(orders.repartition(1), ["o_orderkey"]).select("o_orderkey", "part")
    many = hash_split(orders.repartition(7, "o_orderkey"), ["o_orderkey"]).select("o_orderkey", "part")
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    share = one.filter(F.col("part") == "train").count() / one.count()
    assert 0.75 < share < 0.85


def test_folds_cover_range(spark):
    orders = fx.table(spark, SF_SMALL, "orders").select("o_orderkey")
    folds = {r["fold"] for r in fold_assignment(orders, ["o_orderkey"], 5).select("fold").distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_fixture_bucket_is_the_hash_of_its_key_parts(spark):
    """risk_rows.split_bucket equals hash_bucket('split', key parts) recomputed from row_key."""
    df = fx.risk_rows(spark, SF_SMALL)
    parts = F.split(F.col("row_key"), r"\|")
    from riskloom.functions.hashing import hash_bucket
    again = hash_bucket("split", [parts[i] for i in range(1, 6)], 100)
    assert df.filter(again != F.col("split_bucket")).count() == 0
