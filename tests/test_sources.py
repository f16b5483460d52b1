"""Scans under the catalog schema, typed load errors, record files, other catalogs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from riskloom.catalog import DOC_QUALITY_CATALOG, RISK_ROWS_CATALOG as CAT
from riskloom.errors import CatalogMismatch
from riskloom.operators.models import reference_family
from riskloom.plans.train_job import TrainConfig, train_job
from riskloom.sources import fixtures as fx
from riskloom.sources.tables import read_records, scan_training


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_scan_training_formats(spark, tmp_dir, fmt):
    src = fx.risk_rows_table(spark, SF_SMALL).select("row_key", *CAT.names, "label")
    src.write.format(fmt).option("header", "true").save(f"{tmp_dir}/t")
    df = scan_training(spark, f"{tmp_dir}/t", CAT, fmt)
    assert df.columns == ["row_key", *CAT.names, "label"]
    assert dict(df.dtypes)["qty"] == "double" and dict(df.dtypes)["label"] == "double"
    assert df.count() == 6000
    assert df.agg(F.sum("qty")).first()[0] == src.agg(F.sum("qty")).first()[0]


def test_scan_training_missing_path_is_typed(spark, tmp_dir):
    with pytest.raises(CatalogMismatch):
        scan_training(spark, f"{tmp_dir}/does-not-exist", CAT)


def test_scan_training_missing_column_is_named(spark, tmp_dir):
    fx.risk_rows_table(spark, SF_SMALL).drop("ship_month").write.parquet(f"{tmp_dir}/t")
    with pytest.raises(CatalogMismatch, match="ship_month"):
        scan_training(spark, f"{tmp_dir}/t", CAT)


def test_read_records_json_lines(spark, tmp_dir):
    recs = fx.risk_rows_table(spark, SF_SMALL).select("row_key", *CAT.names).limit(20)
    recs.write.json(f"{tmp_dir}/recs")
    df = read_records(spark, f"{tmp_dir}/recs", CAT)
    assert df.schema == CAT.record_schema()
    assert df.count() == 20


def test_reference_scaling_scope_reproducible(spark):
    """scaler_scope='all' fits the scaler on every valid row, as the reference does."""
    table = fx.risk_rows_table(spark, SF_SMALL)
    lr_only = [s for s in reference_family() if s.ordinal == 1]
    run = train_job(spark, table, TrainConfig(CAT, lr_only, bucket_col="split_bucket", scaler_scope="all"))
    scaler = run.pipeline.stages[1]
    assert scaler.mean[0] == pytest.approx(table.agg(F.avg("qty")).first()[0], rel=1e-12)


def test_train_job_on_document_table(spark):
    """The same job over another catalog: document statistics → quality label."""
    labelled = fx.doc_quality(spark, SF_MID).filter(F.col("quality").isNotNull())
    lr_only = [s for s in reference_family() if s.ordinal == 1]
    run = train_job(spark, labelled, TrainConfig(DOC_QUALITY_CATALOG, lr_only))
    info = run.dataset_info
    assert info["total_rows"] == labelled.count() == info["train_rows"] + info["test_rows"]
    assert run.winner == "Logistic Regression"
    assert 0.0 <= run.board_rows[0]["auc_roc"] <= 1.0


def test_binned_auc_option_close_to_exact(spark):
    """auc_bins=1000 reproduces the reference's (approximate) evaluator setting."""
    table = fx.risk_rows_table(spark, SF_SMALL)
    lr_only = [s for s in reference_family() if s.ordinal == 1]
    exact = train_job(spark, table, TrainConfig(CAT, lr_only, bucket_col="split_bucket")).board_rows[0]
    binned = train_job(spark, table, TrainConfig(CAT, lr_only, bucket_col="split_bucket", auc_bins=1000)).board_rows[0]
    assert abs(exact["auc_roc"] - binned["auc_roc"]) <= 0.002
    assert exact["accuracy"] == binned["accuracy"]


def test_csv_binds_columns_by_name_not_position(spark, tmp_dir):
    src = fx.risk_rows_table(spark, SF_SMALL).select("row_key", *CAT.names, "label")
    shuffled = ["label", *reversed(CAT.names), "row_key"]
    src.select(*shuffled).write.option("header", "true").csv(f"{tmp_dir}/t")
    df = scan_training(spark, f"{tmp_dir}/t", CAT, "csv")
    assert df.columns == ["row_key", *CAT.names, "label"]
    for c in ("qty", "price", "label"):
        assert df.agg(F.sum(c)).first()[0] == pytest.approx(src.agg(F.sum(c)).first()[0])
    recs = read_records(spark, f"{tmp_dir}/t", CAT, "csv")
    assert recs.agg(F.sum("discount_pct")).first()[0] == src.agg(F.sum("discount_pct")).first()[0]


def test_csv_unparseable_number_becomes_null(spark, tmp_dir):
    src = fx.risk_rows_table(spark, SF_SMALL).select("row_key", *CAT.names, "label").limit(10)
    bad = src.withColumn("qty", F.when(F.col("line_no") == 1, F.lit("n/a")).otherwise(F.col("qty").cast("string")))
    bad.write.option("header", "true").csv(f"{tmp_dir}/b")
    df = scan_training(spark, f"{tmp_dir}/b", CAT, "csv")
    assert df.count() == 10
    assert df.filter(F.col("qty").isNull()).count() == bad.filter(F.col("qty") == "n/a").count()
