"""Scans of labelled tables and of records to score.

Reads happen on the executors under a declared schema (no inference pass, no pandas
frame on the driver); the catalog check runs on the schema alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from riskloom.catalog import FeatureCatalog
from riskloom.errors import CatalogMismatch
from riskloom.session import scratch_path


def _loaded(reader, path: str, fmt: str, catalog: FeatureCatalog, label: bool) -> DataFrame:
    """Rows as they are stored: Parquet under its own types, CSV by header name, JSON by field name.

    CSV columns are read as text (no inference pass; a schema would bind them by position) and
    JSON under text for every field.  A key that no JSON record holds is no column: the look for
    one ends at the first record that has it.
    """
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    if fmt == "json":
        wanted = [*catalog.record_schema().fields, *([T.StructField(catalog.label, T.StringType())] if label else [])]
        # features as text, so that 1, 1.0, "1" and true all arrive
        df = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])).json(path)
        return df.drop(*[k for k in catalog.key_cols if df.filter(F.col(k).isNotNull()).isEmpty()])
    return reader.format(fmt).load(path)


def stored_schema(spark: SparkSession, path: str, catalog: FeatureCatalog, fmt: str) -> T.StructType:
    """The schema under which a folder of records is stored (a stream needs it before it starts)."""
    return _loaded(spark.read, path, fmt, catalog, label=False).schema


def as_number(df: DataFrame, name: str) -> Column:
    """A column of any stored type as double: text that is no number becomes null, true is 1."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        text = F.lower(F.trim(F.col(name)))
        return F.when(text == "true", 1.0).when(text == "false", 0.0).otherwise(text.try_cast("double"))
    return F.col(name).cast("double")


def as_records(df: DataFrame, catalog: FeatureCatalog, label: bool = False) -> DataFrame:
    """Catalog features (and label) as doubles, behind the key columns that ``df`` has, in their own types."""
    wanted = catalog.names + ([catalog.label] if label else [])
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise CatalogMismatch(f"missing columns: {', '.join(missing)}")
    odd = [c for c in wanted if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType, T.StringType))]
    if odd:
        raise CatalogMismatch(f"non-numeric columns: {', '.join(odd)}")
    return df.select(*catalog.keys_in(df), *[as_number(df, c).alias(c) for c in wanted])


def scan_training(spark: SparkSession, path: str, catalog: FeatureCatalog, fmt: str = "parquet",
                  options: dict[str, str] | None = None) -> DataFrame:
    """Read a labelled table and project it onto the catalog (keys if it has them, features, label).

    Stored types are kept on reading and cast after, so whole numbers, booleans and numbers
    as text all do.  A feature that is no number becomes null - a rejected row, not a failed
    job; a label that is none becomes null too, and the training job refuses the table
    by name.  Any read or shape problem becomes ``CatalogMismatch``.
    """
    try:
        df = _loaded(spark.read.options(**(options or {})), path, fmt, catalog, label=True)
        if fmt != "csv" and fmt != "json":
            catalog.check(df, require_label=True)
        out = as_records(df, catalog, label=True)
        return out.select(*[F.col(k).cast("string").alias(k) for k in catalog.keys_in(out)], *catalog.names, catalog.label)
    except CatalogMismatch:
        raise
    except AnalysisException as exc:
        raise CatalogMismatch(f"cannot load training table {path!r}: {exc}") from exc


def duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (count per key is combined map-side, so a hot key
    costs one row per task, not a task holding all its rows)."""
    return df.groupBy(*key_cols).count().filter(F.col("count") > 1)


def zip_features_target(features: DataFrame, targets: DataFrame, key_cols: Sequence[str],
                        validate_unique: bool = True) -> DataFrame:
    """Features and targets side by side on an explicit key (full outer: no row lost).

    The reference aligns two frames by row position; a distributed table has no stable
    row position, so the key is required.  Keys must be unique on both sides: a
    duplicated key would make the join emit every pair of its rows.  The check is part of the
    plan - each side meets a count per key (combined map-side, so a hot key is one row per task)
    and a repeated key stops the job - so no job runs before the result is asked for.
    """
    keys = list(key_cols)
    if not validate_unique:
        return features.join(targets, keys, "full_outer")
    once = []
    for side, df in (("features", features), ("targets", targets)):
        value_cols = [c for c in df.columns if c not in keys]
        found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in value_cols])
        text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        stop = F.raise_error(F.concat(F.lit(f"{side} key {keys} is not unique, e.g. "), text))
        # the guard sits in every key column, so no pruning can skip it
        checked = [F.when(F.col("_n") > 1, stop.cast(df.schema[k].dataType)).otherwise(F.col(k)).alias(k) for k in keys]
        once.append(found.select(*checked, *value_cols))
    return once[0].join(once[1], keys, "full_outer")


def read_records(spark: SparkSession, path: str, catalog: FeatureCatalog, fmt: str = "json") -> DataFrame:
    """Records to score (JSON lines, CSV, Parquet): keys in their own type if there are any, features as doubles."""
    try:
        return as_records(_loaded(spark.read, path, fmt, catalog, label=False), catalog)
    except AnalysisException as exc:
        raise CatalogMismatch(f"cannot load records {path!r}: {exc}") from exc


def records_from_json(df: DataFrame, json_col: str, schema: T.StructType,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON string column into typed columns (``from_json``, JVM-side)."""
    parsed = F.from_json(F.col(json_col), schema)
    return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


#: Rows of a local frame that become one Spark write.
LOCAL_ROWS = 1 << 16


def _slices(frames: pd.DataFrame | pa.Table | Iterable, rows: int) -> Iterator[pa.Table]:
    """The rows of a frame, or of an iterable of frames, in tables of at most ``rows`` rows."""
    for frame in [frames] if isinstance(frames, (pd.DataFrame, pa.Table)) else frames:
        for start in range(0, len(frame), rows):
            part = frame.iloc[start:start + rows] if isinstance(frame, pd.DataFrame) else frame.slice(start, rows)
            yield pa.Table.from_pandas(part, preserve_index=False) if isinstance(part, pd.DataFrame) else part


def local_table(spark: SparkSession, frames: pd.DataFrame | pa.Table | Iterable, catalog: FeatureCatalog, path: str | None = None,
                label: bool = True, rows: int = LOCAL_ROWS) -> DataFrame:
    """A frame of the driver's process as a table of the cluster (S3): keys, features and label of the catalog.

    The rows go out in slices of ``rows``, each cast to the catalog's types and written to the shared
    folder, and are then scanned like any other table; from an iterable of frames (a reader of
    chunks) the driver holds one frame at a time, whatever the length of all of them.  A frame
    without the catalog's columns raises ``CatalogMismatch``; so does one without rows, which
    has no types to go by.
    """
    path = path or scratch_path(spark, "local", uuid.uuid4().hex[:12])
    mode = "overwrite"
    for part in _slices(frames, rows):
        as_records(spark.createDataFrame(part), catalog, label).write.mode(mode).parquet(path)
        mode = "append"
    if mode == "overwrite":
        raise CatalogMismatch("the local frame has no rows")
    return spark.read.parquet(path)
