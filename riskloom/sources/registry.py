"""Persisting pipelines and run reports.

A saved pipeline is published: written in full to a folder of its own below ``versions``, then
named by a small pointer file that is renamed into place.  A reader gets the old model or the
new one, never a part of either, and a job that dies on the way leaves the old one.  Reports are tidy tables (Parquet) plus one JSON
document with the reference's report layout.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from riskloom.catalog import FeatureCatalog
from riskloom.errors import CatalogMismatch, ModelUnavailable
from riskloom.functions.local import local_frame


#: The pointer file; versions kept besides the current one, for readers that have just resolved the pointer.
CURRENT, SPARE_VERSIONS = "CURRENT", 2


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the model that is published at ``path``; ``path`` itself where a plain saved model lies."""
    fs, pointer = _file_system(spark, f"{path}/{CURRENT}")
    if not fs.exists(pointer):
        return path
    return f"{path}/versions/{spark.read.text(f'{path}/{CURRENT}').first()[0].strip()}"


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Write the pointer beside its place and rename it over the old one (one step on the file system)."""
    fs, new = _file_system(spark, f"{path}/.{CURRENT}-{version}")
    out = fs.create(new, True)
    out.write(bytearray(version.encode("utf-8")))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, hadoop.Path(f"{path}/{CURRENT}"), overwrite)


def save_pipeline(model: PipelineModel, path: str) -> str:
    """Publish a pipeline at ``path``; the one before stays readable until this one is complete, and a while after."""
    spark = SparkSession.active()
    fs, versions = _file_system(spark, f"{path}/versions")
    before = sorted(fs.listStatus(versions), key=lambda s: s.getModificationTime()) if fs.exists(versions) else []
    current = current_version(spark, path).rpartition("/")[2]
    version = uuid.uuid4().hex
    model.write().save(f"{path}/versions/{version}")
    _point_to(spark, path, version)
    old = [s.getPath() for s in before if s.getPath().getName() != current]
    for folder in old[:max(0, len(old) - SPARE_VERSIONS)]:
        fs.delete(folder, True)
    return path


def load_pipeline(path: str, catalog: FeatureCatalog | None = None) -> PipelineModel:
    """Load the pipeline published (or plainly saved) at a path; a missing/broken one raises ``ModelUnavailable``.

    With a catalog, the assembler's input columns must equal the catalog's features
    (same names, same order), otherwise ``CatalogMismatch``.
    """
    try:
        model = PipelineModel.load(current_version(SparkSession.active(), path))
    except Exception as exc:  # noqa: BLE001 - every load failure means "no model"
        raise ModelUnavailable(f"no loadable pipeline at {path!r}: {exc}") from exc
    if catalog is not None:
        assemblers = [s for s in model.stages if isinstance(s, VectorAssembler)]
        if assemblers and list(assemblers[0].getInputCols()) != catalog.names:
            raise CatalogMismatch(
                f"pipeline features {assemblers[0].getInputCols()} differ from catalog {catalog.names}")
    return model


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Tidy report tables as Parquet (``<root>/<name>``), replaced on rewrite."""
    for name, df in tables.items():
        if df is not None:
            df.write.mode("overwrite").parquet(f"{root}/{name}")


def report_document(board_rows: list[dict], winner: str, importances: list[tuple[str, float]] | None,
                    feature_columns: list[str], dataset_info: dict) -> dict:
    """The run report in the reference's layout.

    Built from already-reduced results only (one row per model, one per feature), so
    it is bounded by the family and catalog sizes, never by the data.
    """
    keys = ("accuracy", "auc_roc", "f1_score", "training_time_sec")
    all_models = {r["model"]: {k: r[k] for k in keys} for r in sorted(board_rows, key=lambda r: r["ordinal"])}
    ranked = None
    if importances is not None:
        ranked = dict(sorted(importances, key=lambda kv: (-kv[1], feature_columns.index(kv[0]))))
    return {
        "best_model": winner,
        "best_metrics": all_models[winner],
        "all_models": all_models,
        "feature_importances": ranked,
        "feature_columns": list(feature_columns),
        "dataset_info": dict(dataset_info),
    }


def write_report_json(spark: SparkSession, report: dict, path: str) -> None:
    """Write the report as one JSON document (Unicode kept, folder created/replaced)."""
    text = json.dumps(report, indent=2, ensure_ascii=False)
    local_frame(spark, [(text,)], "report string").coalesce(1).write.mode("overwrite").text(path)


_METRICS = T.StructType([T.StructField(k, T.DoubleType()) for k in ("accuracy", "auc_roc", "f1_score", "training_time_sec")])
REPORT_SCHEMA = T.StructType([
    T.StructField("best_model", T.StringType()),
    T.StructField("best_metrics", _METRICS),
    T.StructField("all_models", T.MapType(T.StringType(), _METRICS)),
    T.StructField("feature_importances", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("dataset_info", T.StructType([T.StructField(k, T.LongType()) for k in (
        "total_rows", "total_features", "train_rows", "test_rows")])),
])


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """Read the report document under its declared schema, whichever model won.

    A missing report gives None ("no report yet"); a document that is not a report raises
    ``CatalogMismatch``.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return None
    found = text.select(F.from_json("value", REPORT_SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    row = found.select("best_model").first()
    if row is None or row["best_model"] is None:
        raise CatalogMismatch(f"no readable report at {path!r}")
    return found
