"""Invalid rows, rejects, domain checks, defaults and decoding (FIXTURES B5)."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from riskloom.catalog import CDC_CATALOG, FeatureCatalog, binary, ranged
from riskloom.operators import quality as q
from riskloom.operators.features import assembler

NAN = float("nan")


@pytest.fixture
def uv(spark):
    return spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 1.0), ("c", NAN, 1.0)], "k string, u double, v double")


def test_skip_keep_error(spark, uv):
    assert assembler(["u", "v"]).transform(uv).count() == 1
    kept = assembler(["u", "v"], handle_invalid="keep").transform(uv).collect()
    assert len(kept) == 3
    with pytest.raises(Exception):
        assembler(["u", "v"], handle_invalid="error").transform(uv).collect()


def test_valid_rows_matches_skip_and_dropna(uv):
    assert q.valid_rows(uv, ["u", "v"]).count() == 1
    assert uv.dropna(subset=["u", "v"]).count() == 1


def test_rejected_rows_name_columns(uv):
    rej = {r["k"]: r["bad_columns"] for r in q.rejected_rows(uv, ["k"], ["u", "v"]).collect()}
    assert rej == {"b": ["u"], "c": ["u"]}


def test_valid_plus_rejected_is_input(uv):
    assert q.valid_rows(uv, ["u", "v"]).count() + q.rejected_rows(uv, ["k"], ["u", "v"]).count() == uv.count()


def test_domain_violations_cdc(spark):
    rows = [("p1", 25.0, 1.0, 3.0, 5.0), ("p2", 120.0, 2.0, 0.0, 14.0), ("p3", None, 0.0, 6.0, 13.0)]
    df = spark.createDataFrame(rows, "ID string, BMI double, HighBP double, GenHlth double, Age double")
    cat = FeatureCatalog(tuple(CDC_CATALOG.spec(n) for n in ["BMI", "HighBP", "GenHlth", "Age"]),
                         "Diabetes_binary", ("ID",))
    got = sorted((r["ID"], r["feature"], r["value"]) for r in q.domain_violations(df, cat).collect())
    assert got == [("p2", "Age", 14.0), ("p2", "BMI", 120.0), ("p2", "GenHlth", 0.0),
                   ("p2", "HighBP", 2.0), ("p3", "GenHlth", 6.0)]
    summary = {r["feature"]: (r["n_checked"], r["n_violations"]) for r in q.domain_summary(df, cat).collect()}
    assert summary == {"BMI": (2, 1), "HighBP": (3, 1), "GenHlth": (3, 2), "Age": (3, 1)}


def test_fill_defaults_cdc(spark):
    df = spark.createDataFrame([(None, None, 1.0), (30.0, NAN, None)], "BMI double, CholCheck double, Sex double")
    out = q.fill_defaults(df, CDC_CATALOG).collect()
    assert [tuple(r) for r in out] == [(25.0, 1.0, 1.0), (30.0, 1.0, 0.0)]


def test_decode_categories(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (13.0, 1.0, 7.0)], "Age double, Sex double, PhysActivity double")
    out = q.decode_categories(df, CDC_CATALOG).collect()
    assert out[0]["Age_label"] == "18-24" and out[0]["Sex_label"] == "female"
    assert out[0]["PhysActivity_label"] == "active"
    assert out[1]["Age_label"] == "80+" and out[1]["Sex_label"] == "male"
    assert out[1]["PhysActivity_label"] is None  # unknown code decodes to null
    bands = dict(CDC_CATALOG.spec("Age").labels)
    assert bands[2.0] == "25-29" and bands[12.0] == "75-79" and len(bands) == 13


def test_catalog_check_names_missing_column(spark):
    from riskloom.errors import CatalogMismatch

    cat = FeatureCatalog((ranged("qty", 1, 50), binary("flag", 0.0)), "label", ("k",))
    df = spark.createDataFrame([("a", 1.0)], "k string, flag double")
    with pytest.raises(CatalogMismatch, match="qty"):
        cat.check(df)
