"""The reference's table shape end to end (21 health indicators, Diabetes_binary, ID).

The table is derived from risk_rows (the driver's tables): each indicator takes a
column with the same kind of domain, so the CDC catalog's domains, codes and risk
factors all apply.
"""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.catalog import CDC_CATALOG
from riskloom.operators import explain as ex
from riskloom.operators import quality as q
from riskloom.plans.reference_job import reference_job, reference_profile
from riskloom.sources import fixtures as fx
from riskloom.sources.registry import load_pipeline


@pytest.fixture(scope="module")
def cdc_path(spark):
    import tempfile

    r = fx.risk_rows_table(spark, SF_SMALL)
    flag = lambda c: F.col(c).cast("double")
    cdc = r.select(
        F.col("row_key").alias("ID"),
        flag("is_returned").alias("HighBP"), flag("order_open").alias("HighChol"),
        flag("is_finished").alias("CholCheck"), (F.col("qty") + 10).cast("double").alias("BMI"),
        flag("seg_building").alias("Smoker"), flag("order_partial").alias("Stroke"),
        flag("same_nation").alias("HeartDiseaseorAttack"), flag("is_accepted").alias("PhysActivity"),
        flag("seg_household").alias("Fruits"), (1 - F.col("is_returned")).cast("double").alias("Veggies"),
        (F.col("line_no") == 7).cast("double").alias("HvyAlcoholConsump"),
        (F.col("line_no") > 1).cast("double").alias("AnyHealthcare"),
        (F.col("tax_pct") == 0).cast("double").alias("NoDocbcCost"),
        flag("priority").alias("GenHlth"), (F.col("discount_pct") * 3).cast("double").alias("MentHlth"),
        (F.col("tax_pct") * 3).cast("double").alias("PhysHlth"),
        (F.col("discount_pct") > 8).cast("double").alias("DiffWalk"),
        (F.col("part_size") % 2).cast("double").alias("Sex"),
        (F.col("ship_month") + 1).cast("double").alias("Age"),
        (F.col("line_no") % 6 + 1).cast("double").alias("Education"),
        (F.col("part_size") % 8 + 1).cast("double").alias("Income"),
        flag("label").alias("Diabetes_binary"))
    path = tempfile.mkdtemp(prefix="riskloom-cdc-") + "/cdc"
    cdc.write.option("header", "true").csv(path)
    return path


def test_reference_job_end_to_end(spark, cdc_path, tmp_dir):
    run = reference_job(spark, cdc_path, f"{tmp_dir}/model")
    assert run.report["feature_columns"] == CDC_CATALOG.names
    assert set(run.report["all_models"]) == {"Logistic Regression", "Random Forest", "Gradient Boosted Trees"}
    assert run.dataset_info["total_rows"] == 6000
    model = load_pipeline(f"{tmp_dir}/model/best_model", CDC_CATALOG)
    assert [type(s).__name__ for s in model.stages][:2] == ["VectorAssembler", "StandardScalerModel"]
    text = "".join(r["value"] for r in spark.read.text(f"{tmp_dir}/model/metrics").collect())
    assert json.loads(text)["best_model"] == run.winner


def test_reference_catalog_rules_apply(spark, cdc_path):
    from riskloom.sources.tables import scan_training

    table = scan_training(spark, cdc_path, CDC_CATALOG, "csv")
    summary = {r["feature"]: r["n_violations"] for r in q.domain_summary(table, CDC_CATALOG).collect()}
    assert sum(summary.values()) == 0
    decoded = q.decode_categories(table, CDC_CATALOG).select("Age", "Age_label").distinct().collect()
    assert all(r["Age_label"] is not None for r in decoded)
    prof = {r["factor"] for r in ex.risk_profile(table.limit(5), ["ID"], ex.reference_risk_factors()).collect()}
    assert prof == {"BMI", "HighBP", "HighChol", "Smoker", "GenHlth", "Age", "Sedentary", "HeartDisease"}
    stats, labels = reference_profile(table)
    assert stats.count() == 21 and labels.agg(F.sum("rows")).first()[0] == 6000


def test_reference_job_command_with_parity_flags(spark, cdc_path, tmp_dir, capsys):
    from riskloom.plans.reference_job import main

    main(["--input", cdc_path, "--model-dir", f"{tmp_dir}/m", "--scaler-scope", "all", "--auc-bins", "1000"])
    report = json.loads(capsys.readouterr().out)
    assert report["feature_columns"] == CDC_CATALOG.names
    assert report["dataset_info"]["total_rows"] == 6000
    assert load_pipeline(f"{tmp_dir}/m/best_model", CDC_CATALOG) is not None


def test_table_without_a_key(spark, cdc_path, tmp_dir):
    """The 21 indicators and the label alone: split by values, rejects and scores carry the features."""
    spark.read.option("header", "true").csv(cdc_path).drop("ID").write.option("header", "true").csv(f"{tmp_dir}/t")
    run = reference_job(spark, f"{tmp_dir}/t", f"{tmp_dir}/model")
    assert run.dataset_info["total_rows"] == 6000 and 0 < run.dataset_info["test_rows"] < 3000
    assert run.rejects.columns == [*CDC_CATALOG.names, "bad_columns"]
