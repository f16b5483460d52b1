"""What the streaming scorer writes is compressed as the training tables are, the rows in it unchanged."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from riskloom.catalog import FeatureCatalog, FeatureSpec
from riskloom.streaming.score_stream import run_to_completion, write_batch


def codecs(folder):
    files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    found = [pq.ParquetFile(f).metadata for f in files]
    return {m.row_group(0).column(0).compression for m in found if m.num_row_groups}


@pytest.fixture
def scored(spark):
    rows = [(f"k{i}", float(i) if i % 5 else None, i % 2) for i in range(50)]
    table = spark.createDataFrame(rows, "row_key string, x double, label int")
    catalog = FeatureCatalog((FeatureSpec("x"),), label="label", key_cols=("row_key",))
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=2)]
    return table, Pipeline(stages=stages).fit(table.na.drop()), catalog


def test_files_are_zstd(spark, scored, tmp_dir):
    table, model, catalog = scored
    table.drop("label").write.parquet(f"{tmp_dir}/source")
    good, bad = run_to_completion(spark, f"{tmp_dir}/source", model, catalog, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")
    assert (good.count(), bad.count()) == (40, 10) and codecs(f"{tmp_dir}/sink") == {"ZSTD"}
    assert write_batch(table.drop("label"), 0, model, catalog, f"{tmp_dir}/once") and codecs(f"{tmp_dir}/once") == {"ZSTD"}
