"""One read, scored and rejected rows: batch with counts, stream with replay; Spark's event log counts the reads."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.catalog import RISK_ROWS_CATALOG as CAT, FeatureCatalog
from riskloom.operators.score import score_once
from riskloom.plans.fixture_runs import fixture_run
from riskloom.plans.score_job import score_job, score_to
from riskloom.sources import registry
from riskloom.sources.fixtures import risk_rows_table
from riskloom.streaming.score_stream import read_sink, score_stream_once, write_batch


@pytest.fixture(scope="module")
def run(spark):
    return fixture_run(spark, SF_SMALL)


def records(spark):
    rows = risk_rows_table(spark, SF_SMALL).filter("split_bucket >= 80").select("row_key", *[F.col(c).cast("double").alias(c) for c in CAT.names])
    return (rows.withColumn("qty", F.when(F.col("qty") != 50, F.col("qty")))
            .withColumn("price", F.when(F.col("line_no") == 7, F.lit(float("nan"))).otherwise(F.col("price"))))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_row_once_as_in_two_passes(spark, run, tmp_dir):
    table = records(spark)
    counts = score_to(spark, table, run.pipeline, CAT, f"{tmp_dir}/out")
    out = spark.read.parquet(f"{tmp_dir}/out")
    scored, rejects = score_job(spark, table, run.pipeline, CAT)
    assert same(out.filter("status = 'scored'").select(scored.columns), scored)
    assert same(out.filter("status = 'rejected'").select(rejects.columns), rejects)
    assert (counts.scored, counts.rejected) == (scored.count(), rejects.count()) and counts.rejected > 0
    assert counts.scored + counts.rejected == table.count() == out.count()
    assert out.filter("status = 'rejected' and probability is not null").count() == 0


def test_rows_without_a_key_keep_their_features(spark, run):
    catalog = FeatureCatalog(CAT.features, label=CAT.label, key_cols=())
    table = records(spark).drop("row_key").limit(300)
    out = score_once(table, run.pipeline, catalog)
    assert out.columns[:len(CAT.names)] == CAT.names and same(out.select(CAT.names), table.select(CAT.names))


def test_empty_table(spark, run, tmp_dir):
    counts = score_to(spark, records(spark).limit(0), run.pipeline, CAT, f"{tmp_dir}/out")
    assert (counts.scored, counts.rejected) == (0, 0)


def test_stream_reads_once_and_replays_to_nothing(spark, run, tmp_dir):
    table = records(spark)
    table.repartition(4).write.parquet(f"{tmp_dir}/src")

    def drain():
        query = score_stream_once(spark, f"{tmp_dir}/src", run.pipeline, CAT, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", max_files_per_trigger=1)
        query.awaitTermination()
        return query

    first = drain()
    rows = read_sink(spark, f"{tmp_dir}/sink")
    assert sum(p["numInputRows"] for p in first.recentProgress) == table.count() == rows.count()
    scored, rejects = score_job(spark, table, run.pipeline, CAT)
    assert same(rows.filter("status = 'scored'").select(scored.columns), scored)
    assert same(rows.filter("status = 'rejected'").select(rejects.columns), rejects)
    assert rows.select("batch_id").distinct().count() == 4

    drain()  # nothing new: nothing written
    assert read_sink(spark, f"{tmp_dir}/sink").count() == table.count()
    # a batch that comes again after it was committed is left alone; one that was cut off is written anew
    assert write_batch(table.limit(5), 2, run.pipeline, CAT, f"{tmp_dir}/sink") is False
    before = spark.read.parquet(f"{tmp_dir}/sink/batch_id=1").count()
    batch = spark.read.parquet(f"{tmp_dir}/sink/batch_id=1").select("row_key").join(table, "row_key")
    os.remove(f"{tmp_dir}/sink/batch_id=1/_SUCCESS")
    assert write_batch(batch.persist(), 1, run.pipeline, CAT, f"{tmp_dir}/sink") is True
    assert spark.read.parquet(f"{tmp_dir}/sink/batch_id=1").count() == before
    assert read_sink(spark, f"{tmp_dir}/sink").count() == table.count()


def test_event_log_shows_one_read(spark, run, tmp_dir):
    """The job in a session of its own: of all its plans one scans the records, once."""
    records(spark).repartition(3).write.parquet(f"{tmp_dir}/records")
    registry.save_pipeline(run.pipeline, f"{tmp_dir}/model")
    os.makedirs(f"{tmp_dir}/events")
    job = textwrap.dedent(f"""
        from riskloom.session import build_session
        spark = build_session("local[2]", shuffle_partitions=4, driver_memory="2g", extra_conf={{"spark.eventLog.enabled": "true",
            "spark.eventLog.dir": "file://{tmp_dir}/events", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
            "spark.checkpoint.dir": "{tmp_dir}/ckpt"}})
        from riskloom.catalog import RISK_ROWS_CATALOG as CAT
        from riskloom.plans.score_job import score_to
        from riskloom.sources.registry import load_pipeline
        model = load_pipeline("{tmp_dir}/model", CAT)
        table = spark.read.parquet("{tmp_dir}/records")
        counts = score_to(spark, table, model, CAT, "{tmp_dir}/out")
        print("COUNTS", counts.scored, counts.rejected)
        spark.stop()
    """)
    done = subprocess.run([sys.executable, "-c", job], capture_output=True, text=True, timeout=300,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    scored, rejected = map(int, done.stdout.split("COUNTS")[1].split()[:2])
    def scans(node):
        own = [node["simpleString"]] if "/records" in node["metadata"].get("Location", "") else []
        return own + [x for child in node["children"] for x in scans(child)]

    found = []
    for name in os.listdir(f"{tmp_dir}/events"):
        for line in open(f"{tmp_dir}/events/{name}"):
            event = json.loads(line)
            if event["Event"].endswith("SQLExecutionStart"):
                found += scans(event["sparkPlanInfo"])
    assert len(found) == 1 and scored + rejected == records(spark).count()
