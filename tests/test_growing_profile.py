"""Profiles by file states; loading a local frame."""

import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.catalog import FeatureCatalog, FeatureSpec
from riskloom.errors import CatalogMismatch
from riskloom.operators.profile import describe_features, label_distribution
from riskloom.operators.profile_states import current_states, merged_description, merged_labels, update_profile
from riskloom.sources.tables import local_table


def delivery(spark, seed, n=300, shift=0.0):
    rng = random.Random(seed)
    rows = [(1e6 + shift + rng.gauss(0, 1), rng.choice([None, float("nan") if seed == 99 else 2.0, rng.random()]), rng.choice([0, 1, None])) for _ in range(n)]
    return spark.createDataFrame(rows, "a double, b double, label int")


def profile(spark, root):
    states = current_states(spark, f"{root}/rows", f"{root}/states")
    return ({r.feature: r for r in merged_description(states).collect()}, {r.label: (r.rows, r.share) for r in merged_labels(states).collect()})


def whole(spark, root):
    rows = spark.read.parquet(f"{root}/rows")
    return ({r.feature: r for r in describe_features(rows, ["a", "b"]).collect()},
            {None if r.label is None else str(r.label): (r.rows, r.share) for r in label_distribution(rows, "label").collect()})


def check(spark, root):
    (got, labels), (want, want_labels) = profile(spark, root), whole(spark, root)
    assert labels == want_labels and got.keys() == want.keys()
    for f, w in want.items():
        assert (got[f].ordinal, got[f].n, got[f].min_value, got[f].max_value) == (w.ordinal, w.n, w.min_value, w.max_value)
        assert got[f].mean == pytest.approx(w.mean, rel=1e-14) and got[f].stddev == pytest.approx(w.stddev, rel=1e-9)


def test_only_new_files_are_read(spark, tmp_dir):
    root = tmp_dir
    update = lambda: update_profile(spark, f"{root}/rows", ["a", "b"], "label", f"{root}/states")
    assert update() == [] and profile(spark, root) == ({}, {})
    delivery(spark, 1).repartition(2).write.mode("append").parquet(f"{root}/rows")
    assert len(update()) == 2
    check(spark, root)
    before = set(os.listdir(f"{root}/rows"))
    delivery(spark, 2, 50, shift=40.0).coalesce(1).write.mode("append").parquet(f"{root}/rows")
    read = update()
    assert {os.path.basename(f) for f in read} == {n for n in set(os.listdir(f"{root}/rows")) - before if n.endswith(".parquet")}
    check(spark, root)
    assert update() == []
    delivery(spark, 3).write.mode("overwrite").parquet(f"{root}/rows")  # the old files are gone
    update()
    check(spark, root)


def test_states_of_odd_files(spark, tmp_dir):
    delivery(spark, 4, 0).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/rows")
    delivery(spark, 5, 1).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/rows")
    delivery(spark, 6, 40).withColumn("b", F.lit(None).cast("double")).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/rows")
    update_profile(spark, f"{tmp_dir}/rows", ["a", "b"], "label", f"{tmp_dir}/states")
    (got, labels), (want, want_labels) = profile(spark, tmp_dir), whole(spark, tmp_dir)
    assert labels == want_labels and got["b"].n == want["b"].n and got["a"].n == 41
    assert got["a"].stddev == pytest.approx(want["a"].stddev, rel=1e-9)


CATALOG = FeatureCatalog((FeatureSpec("x"), FeatureSpec("y")), label="label", key_cols=("id",))


@pytest.mark.parametrize("kind", ["pandas", "arrow", "chunks"])
def test_local_frame(spark, tmp_dir, kind):
    frame = pd.DataFrame({"id": [f"k{i}" for i in range(1000)], "x": range(1000), "y": [str(i / 4) for i in range(1000)],
                          "label": [i % 2 == 0 for i in range(1000)], "other": "z"})
    given = {"pandas": frame, "arrow": pa.Table.from_pandas(frame), "chunks": (frame.iloc[i:i + 300] for i in range(0, 1000, 300))}[kind]
    table = local_table(spark, given, CATALOG, f"{tmp_dir}/t", rows=128)
    assert table.dtypes == [("id", "string"), ("x", "double"), ("y", "double"), ("label", "double")]
    row = table.agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum("label").alias("label"), F.countDistinct("id").alias("ids")).first()
    assert tuple(row) == (1000, 499500.0, 124875.0, 500.0, 1000)


def test_local_frame_holds_one_chunk_at_a_time(spark, tmp_dir):
    alive, most = [0], [0]

    def chunks(n):
        for i in range(n):
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            yield pd.DataFrame({"id": [str(i)], "x": [1.0], "y": [2.0], "label": [0]})
            alive[0] -= 1

    assert local_table(spark, chunks(12), CATALOG, f"{tmp_dir}/t").count() == 12 and most[0] == 1


def test_local_frame_errors(spark, tmp_dir):
    with pytest.raises(CatalogMismatch, match="y"):
        local_table(spark, pd.DataFrame({"id": ["a"], "x": [1], "label": [0]}), CATALOG, f"{tmp_dir}/t")
    with pytest.raises(CatalogMismatch):
        local_table(spark, [], CATALOG, f"{tmp_dir}/u")
