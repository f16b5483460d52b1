"""The modelling tables: shape, keys and cross-engine parity."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.sources import fixtures as fx


def test_risk_rows_shape(spark):
    df = fx.risk_rows(spark, SF_SMALL)
    assert df.columns[0] == "row_key"
    assert df.columns[1:22] == fx.RISK_FEATURES
    row = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_key").alias("k"),
                 F.sum("label").alias("pos"), F.count(F.when(F.col("split_bucket") < 80, 1)).alias("tr")).first()
    lineitems = fx.table(spark, SF_SMALL, "lineitem").count()
    assert row["n"] == lineitems == row["k"]          # star join keeps every lineitem, keys unique
    assert (row["n"], row["pos"], row["tr"]) == (6000, 811, 4805)


def test_risk_rows_equals_duckdb(spark, duck):
    ours = sorted(tuple(r) for r in fx.risk_rows(spark, SF_SMALL).collect())
    theirs = sorted(duck.sql("WITH " + fx.RISK_ROWS_SQL + " SELECT * FROM risk_rows").fetchall())
    assert ours == theirs


def test_doc_quality_keeps_unlabelled_documents(spark):
    df = fx.doc_quality(spark, SF_SMALL)
    docs = fx.table(spark, SF_SMALL, "documents").count()
    labelled = fx.table(spark, SF_SMALL, "labels").count()
    assert df.count() == docs
    assert df.filter(F.col("quality").isNotNull()).count() == labelled


def test_copy_is_written_once_per_input_state(spark, tmp_dir):
    import shutil

    import pyarrow.parquet as pq

    shutil.copytree(SF_SMALL, f"{tmp_dir}/t", copy_function=shutil.copyfile)
    first = fx.risk_rows_path(spark, f"{tmp_dir}/t")
    assert fx.risk_rows_table(spark, f"{tmp_dir}/t").count() == 6000
    assert fx.risk_rows_path(spark, f"{tmp_dir}/t") == first
    kept = pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 100)
    pq.write_table(kept, f"{tmp_dir}/t/lineitem.parquet")      # the input changes within the session
    assert fx.risk_rows_path(spark, f"{tmp_dir}/t") != first
    assert fx.risk_rows_table(spark, f"{tmp_dir}/t").count() == 100


def test_scratch_is_deleted_only_below_the_scratch_folder(spark):
    import pytest

    from riskloom.session import drop_scratch, scratch_path

    path = scratch_path(spark, "tables", "short-lived")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")
