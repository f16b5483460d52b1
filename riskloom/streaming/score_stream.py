"""Structured Streaming scorer (C2): records arriving as files are scored by the saved
pipeline and appended to a Parquet sink; records that can't be scored go to a reject sink.

``score_stream_once`` does both in one query: each micro-batch is read once and written, split by
status, to a folder of its own, so that a batch that runs again after a failure replaces what it
left unfinished and leaves alone what it had finished.

The queries are stateless (projection only), so they need no watermark; checkpoints and
sinks live under the shared checkpoint folder, which makes a restarted query resume
exactly where it stopped.  ``available_now`` processes the current backlog and stops.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskloom.catalog import FeatureCatalog
from riskloom.operators.score import score_once, score_with_rejects
from riskloom.sources.tables import as_records, stored_schema


def record_stream(spark: SparkSession, source_dir: str, catalog: FeatureCatalog, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The records of a folder as a stream, under the types they are stored in, cast after reading."""
    reader = spark.readStream.schema(stored_schema(spark, source_dir, catalog, fmt))
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")  # columns by name, or an error
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return as_records(reader.format(fmt).load(source_dir), catalog)


def score_stream(
    spark: SparkSession,
    source_dir: str,
    model: PipelineModel,
    catalog: FeatureCatalog,
    sink_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the scorer; returns the ``StreamingQuery`` of scored and of rejected records.

    Every record goes to one of ``<sink_dir>/scored`` and ``<sink_dir>/rejects`` (with the names of the
    offending columns).
    """
    records = record_stream(spark, source_dir, catalog, fmt, max_files_per_trigger)
    queries = []
    for name, rows in zip(("scored", "rejects"), score_with_rejects(records, model, catalog)):
        writer = (rows.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
                  .option("checkpointLocation", f"{checkpoint_dir}/{name}").option("path", f"{sink_dir}/{name}"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
        queries.append(writer.start())
    return tuple(queries)


def run_to_completion(spark: SparkSession, source_dir: str, model: PipelineModel, catalog: FeatureCatalog,
                      sink_dir: str, checkpoint_dir: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Process the backlog, wait for both queries to stop and return (scored, rejects)."""
    for query in score_stream(spark, source_dir, model, catalog, sink_dir, checkpoint_dir, fmt):
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return spark.read.parquet(f"{sink_dir}/scored"), spark.read.parquet(f"{sink_dir}/rejects")


def write_batch(batch: DataFrame, batch_id: int, model: PipelineModel, catalog: FeatureCatalog, sink_dir: str) -> bool:
    """Score one micro-batch into ``<sink_dir>/batch_id=<n>/status=…``; False if it was there already.

    A folder counts once its job has committed (its ``_SUCCESS`` file); an unfinished one is replaced.
    """
    spark = batch.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{sink_dir}/batch_id={batch_id}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return False
    rows = score_once(batch, model, catalog)
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("status").parquet(f"{sink_dir}/batch_id={batch_id}")
    return True


def score_stream_once(spark: SparkSession, source_dir: str, model: PipelineModel, catalog: FeatureCatalog, sink_dir: str,
                      checkpoint_dir: str, fmt: str = "parquet", available_now: bool = True,
                      max_files_per_trigger: int | None = None):
    """Start the one-pass scorer; its ``StreamingQuery``.  ``read_sink`` gives the rows written so far."""
    records = record_stream(spark, source_dir, catalog, fmt, max_files_per_trigger)
    writer = (records.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, model, catalog, sink_dir))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Rows of the committed batches: identity, scores, bad_columns, batch_id, status."""
    return spark.read.parquet(sink_dir)
