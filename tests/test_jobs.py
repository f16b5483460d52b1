"""Training, persistence, batch and stream scoring end to end (sf0.001)."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from riskloom.catalog import RISK_ROWS_CATALOG as CAT
from riskloom.errors import CatalogMismatch, EmptyInput, ModelUnavailable, SingleClassLabel
from riskloom.plans.fixture_runs import fixture_run, risk_config
from riskloom.plans.score_job import score_job
from riskloom.plans.train_job import train_job
from riskloom.sources import registry
from riskloom.sources.fixtures import risk_rows_table
from riskloom.sources.tables import read_records
from riskloom.streaming.score_stream import run_to_completion


@pytest.fixture(scope="module")
def run(spark):
    return fixture_run(spark, SF_SMALL)


def test_leaderboard_and_winner(run):
    assert [r["model"] for r in run.board_rows] == ["Logistic Regression", "Random Forest", "Gradient Boosted Trees"]
    best = max(run.board_rows, key=lambda r: (round(r["auc_roc"], 4), -r["ordinal"]))
    assert run.winner == best["model"]
    for r in run.board_rows:
        assert 0.5 < r["auc_roc"] <= 1.0 and 0.0 <= r["accuracy"] <= 1.0
        assert r["test_rows"] == run.dataset_info["test_rows"]
    assert run.dataset_info["train_rows"] + run.dataset_info["test_rows"] == run.dataset_info["total_rows"] == 6000


def test_report_layout(run):
    rep = run.report
    assert set(rep) == {"best_model", "best_metrics", "all_models", "feature_importances", "feature_columns",
                        "dataset_info"}
    assert rep["feature_columns"] == CAT.names
    assert rep["best_metrics"] == rep["all_models"][rep["best_model"]]
    if rep["best_model"] == "Logistic Regression":
        assert rep["feature_importances"] is None


def test_gbt_importances_sum_to_one(spark, run):
    from riskloom.operators.explain import feature_importances

    found = feature_importances(spark, run.fitted["Gradient Boosted Trees"], CAT.names)
    imps = [r["importance"] for r in found.collect()]
    assert len(imps) == len(CAT.names)
    assert sum(imps) == pytest.approx(1.0, abs=1e-5)


def test_scores_are_probabilities_and_nothing_vanishes(spark, run):
    table = risk_rows_table(spark, SF_SMALL)
    gaps = table.withColumn("qty", F.when(F.col("qty") != 50, F.col("qty")))
    scored, rejects = score_job(spark, gaps, run.pipeline, CAT)
    assert scored.count() + rejects.count() == gaps.count()
    bad = scored.filter((F.col("probability") < 0) | (F.col("probability") > 1)).count()
    assert bad == 0
    assert rejects.filter(F.array_contains("bad_columns", "qty")).count() == rejects.count() > 0


def test_saved_pipeline_reloads_identically(spark, run, tmp_dir):
    path = registry.save_pipeline(run.pipeline, f"{tmp_dir}/model")
    again = registry.load_pipeline(path, CAT)
    test = risk_rows_table(spark, SF_SMALL).filter("split_bucket >= 80")
    a, _ = score_job(spark, test, run.pipeline, CAT)
    b, _ = score_job(spark, test, again, CAT)
    diff = a.alias("a").join(b.alias("b"), "row_key").filter(
        (F.col("a.prediction") != F.col("b.prediction")) | (F.abs(F.col("a.probability") - F.col("b.probability")) > 1e-12))
    assert diff.count() == 0 and a.count() == b.count()


def test_missing_model_is_unavailable(tmp_dir):
    with pytest.raises(ModelUnavailable):
        registry.load_pipeline(f"{tmp_dir}/nothing-here")


def test_report_round_trip(spark, run, tmp_dir):
    registry.write_report_json(spark, run.report, f"{tmp_dir}/metrics")
    doc = registry.read_report(spark, f"{tmp_dir}/metrics").first()
    assert doc["best_model"] == run.winner
    assert doc["dataset_info"]["total_rows"] == 6000
    assert registry.read_report(spark, f"{tmp_dir}/absent") is None
    board = [{"model": m, "ordinal": k, "accuracy": .5, "auc_roc": .5, "f1_score": .5, "training_time_sec": 1.0}
             for k, m in enumerate(("A", "B"), 1)]
    info = {"total_rows": 2, "total_features": 1, "train_rows": 1, "test_rows": 1}
    for winner, importances in (("A", None), ("B", [("x", 1.0)])):   # the same types whichever model wins
        registry.write_report_json(spark, registry.report_document(board, winner, importances, ["x"], info), f"{tmp_dir}/{winner}")
        found = registry.read_report(spark, f"{tmp_dir}/{winner}")
        assert found.schema == registry.REPORT_SCHEMA and found.first()["feature_importances"] == (importances and dict(importances))
    spark.createDataFrame([("no report",)], "value string").write.text(f"{tmp_dir}/broken")
    with pytest.raises(CatalogMismatch):
        registry.read_report(spark, f"{tmp_dir}/broken")
    text = "".join(r["value"] for r in spark.read.text(f"{tmp_dir}/metrics").collect())
    assert json.loads(text)["feature_columns"] == CAT.names


def _with_gaps(spark):
    rows = risk_rows_table(spark, SF_SMALL).filter("split_bucket >= 80").select(
        "row_key", *[F.col(c).cast("double").alias(c) for c in CAT.names])
    return rows.withColumn("qty", F.when(F.col("qty") != 50, F.col("qty")))


def test_stream_equals_batch_and_loses_nothing(spark, run, tmp_dir):
    records = _with_gaps(spark)
    records.repartition(3).write.parquet(f"{tmp_dir}/src")
    streamed, rejected = run_to_completion(spark, f"{tmp_dir}/src", run.pipeline, CAT, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    batch, rejects = score_job(spark, records, run.pipeline, CAT)
    cols = ["row_key", "prediction", "probability"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert streamed.count() == batch.count()
    assert rejected.exceptAll(rejects).count() == 0
    assert streamed.count() + rejected.count() == records.count() and rejected.count() > 0


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("kind", ["bigint", "int", "double", "string"])
def test_records_of_any_stored_type(spark, run, tmp_dir, fmt, kind):
    """Features and keys keep the type they are stored in: batch and stream read them all."""
    rows = _with_gaps(spark).limit(60)
    whole = [c for c in CAT.names if c not in ("price", "order_total", "cust_balance", "part_price", "supp_balance")]
    stored = rows.select(F.monotonically_increasing_id().alias("row_key"), *[
        F.col(c).cast(kind).alias(c) if c in whole and c != "is_returned" else (
            (F.col(c) == 1).alias(c) if c == "is_returned" else F.col(c)) for c in CAT.names])
    stored.write.format(fmt).option("header", "true").save(f"{tmp_dir}/r")
    records = read_records(spark, f"{tmp_dir}/r", CAT, fmt)
    scored, rejects = score_job(spark, records, run.pipeline, CAT)
    assert scored.count() + rejects.count() == 60
    if fmt == "parquet":
        assert dict(records.dtypes)["row_key"] == "bigint"
    want, _ = score_job(spark, rows, run.pipeline, CAT)
    assert sorted(r.probability for r in scored.collect()) == pytest.approx(sorted(r.probability for r in want.collect()))
    streamed, rejected = run_to_completion(spark, f"{tmp_dir}/r", run.pipeline, CAT, f"{tmp_dir}/s", f"{tmp_dir}/c", fmt)
    assert (streamed.count(), rejected.count()) == (scored.count(), rejects.count())


def test_records_without_a_key(spark, run, tmp_dir):
    _with_gaps(spark).drop("row_key").limit(40).write.json(f"{tmp_dir}/r")
    scored, rejects = score_job(spark, read_records(spark, f"{tmp_dir}/r", CAT), run.pipeline, CAT)
    assert scored.columns[:len(CAT.names)] == CAT.names and scored.count() + rejects.count() == 40


def test_empty_test_part_is_refused_before_fitting(spark):
    config = risk_config("Logistic Regression")
    config.train_percent = 100
    with pytest.raises(EmptyInput, match="held-out"):
        train_job(spark, risk_rows_table(spark, SF_SMALL), config)


def test_null_label_is_refused_by_name(spark):
    table = risk_rows_table(spark, SF_SMALL).withColumn("label", F.when(F.col("line_no") != 7, F.col("label")))
    with pytest.raises(CatalogMismatch, match="0 or 1"):
        train_job(spark, table, risk_config("Logistic Regression"))


def test_random_split_option(spark):
    config = risk_config("Logistic Regression")
    config.split, config.bucket_col = "random", None
    info = train_job(spark, risk_rows_table(spark, SF_SMALL), config).dataset_info
    assert info["train_rows"] + info["test_rows"] == 6000 and 4600 < info["train_rows"] < 5000


def test_same_trees_from_any_input_layout(spark):
    table = risk_rows_table(spark, SF_SMALL)
    dumps = []
    for n in (1, 4, 16):
        dumps.append([train_job(spark, table.repartition(n), risk_config(m)).fitted[m].toDebugString.split("\n", 1)[1]
                      for m in ("Random Forest", "Gradient Boosted Trees")])
    assert dumps[0] == dumps[1] == dumps[2]


def test_single_class_refused(spark):
    table = risk_rows_table(spark, SF_SMALL).withColumn("label", F.lit(0))
    with pytest.raises(SingleClassLabel):
        train_job(spark, table, risk_config("Logistic Regression"))


def test_missing_feature_named(spark, run):
    table = risk_rows_table(spark, SF_SMALL).drop("qty")
    with pytest.raises(CatalogMismatch, match="qty"):
        score_job(spark, table, run.pipeline, CAT)


def test_empty_table_scores_to_nothing(spark, run):
    empty = risk_rows_table(spark, SF_SMALL).limit(0)
    scored, rejects = score_job(spark, empty, run.pipeline, CAT)
    assert scored.count() == 0 and rejects.count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "label", "prediction", "probability", "raw_score"]
    assert df.count() > 0


def test_scaler_fitted_on_train_only(spark, run):
    scaler = run.pipeline.stages[1]
    train = risk_rows_table(spark, SF_SMALL).filter("split_bucket < 80")
    assert scaler.mean[0] == pytest.approx(train.agg(F.avg("qty")).first()[0], rel=1e-12)


def test_tree_diagnostics_and_coefficients(spark, run):
    by_name = {r["model"]: r for r in run.board_rows}
    assert by_name["Random Forest"]["trees"] == 30 and by_name["Gradient Boosted Trees"]["trees"] == 25
    assert 0 <= by_name["Random Forest"]["root_only_trees"] <= 30
    assert by_name["Logistic Regression"]["trees"] is None
    if run.winner == "Logistic Regression":
        coefs = {r["feature"]: r["coefficient"] for r in run.coefficients.collect()}
        assert set(coefs) == set(CAT.names) | {"(intercept)"}
        assert run.importances is None


def test_stream_query_repeatable(spark):
    """A second run in the same session resumes from its checkpoint: no duplicate output."""
    first = E.queries()["score_stream"](spark, SF_SMALL).count()
    again = E.queries()["score_stream"](spark, SF_SMALL)
    rejected = E.queries()["score_stream_rejects"](spark, SF_SMALL)
    assert first + rejected.count() == 6000 and rejected.count() > 0
    assert again.count() == first == again.select("row_key").distinct().count()


def test_non_binary_label_refused(spark):
    table = risk_rows_table(spark, SF_SMALL).withColumn("label", F.when(F.col("qty") == 50, 2).otherwise(F.col("label")))
    with pytest.raises(CatalogMismatch, match="0 or 1"):
        train_job(spark, table, risk_config("Logistic Regression"))


def test_probabilities_sum_to_one_and_repartition_invariant(spark, run):
    from pyspark.ml.functions import vector_to_array

    test = risk_rows_table(spark, SF_SMALL).filter("split_bucket >= 80")
    probs = run.pipeline.transform(test).select(vector_to_array("probability").alias("p"))
    off = probs.filter(F.abs(F.col("p")[0] + F.col("p")[1] - 1.0) > 1e-12).count()
    assert off == 0
    a, _ = score_job(spark, test.repartition(1), run.pipeline, CAT)
    b, _ = score_job(spark, test.repartition(5, "row_key"), run.pipeline, CAT)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_score_job_command(spark, run, tmp_dir):
    from riskloom.plans.score_job import main

    registry.save_pipeline(run.pipeline, f"{tmp_dir}/model")
    recs = risk_rows_table(spark, SF_SMALL).filter("split_bucket >= 80").select(
        "row_key", *[F.col(c).cast("double").alias(c) for c in CAT.names])
    recs = recs.withColumn("qty", F.when(F.col("qty") != 50, F.col("qty")))
    recs.write.json(f"{tmp_dir}/recs")
    main(["--input", f"{tmp_dir}/recs", "--model", f"{tmp_dir}/model", "--output", f"{tmp_dir}/out",
          "--catalog", "risk_rows"])
    written = spark.read.parquet(f"{tmp_dir}/out")
    scored, rejected = (written.filter(F.col("status") == s).count() for s in ("scored", "rejected"))
    assert scored + rejected == recs.count() and rejected > 0
