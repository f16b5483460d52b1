"""Profiles of a growing table: one mergeable state per input file.

A state holds, for every profiled column of a file, the count, mean, sum of squared deviations,
minimum and maximum, and the rows of every label.  States are kept as Parquet; an update
reads the files that have none yet (or have changed) and no others, and the profile of the
table is the merger of the states - pairwise formulas, so no pass over old rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE = T.StructType([T.StructField(name, kind) for name, kind in (
    ("file", T.StringType()), ("stamp", T.StringType()), ("kind", T.StringType()), ("ordinal", T.IntegerType()), ("name", T.StringType()),
    ("n", T.LongType()), ("mean", T.DoubleType()), ("m2", T.DoubleType()), ("min_value", T.DoubleType()), ("max_value", T.DoubleType()))])
FEATURE, LABEL, ROWS = "feature", "label", "rows"


def _files(spark: SparkSession, path: str) -> dict[str, str]:
    """Files of a folder and their stamps (length and time of change)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(target) if fs.exists(target) else []
    return {s.getPath().toUri().getPath(): f"{s.getLen()}-{s.getModificationTime()}" for s in found
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))}


def _listing(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(files.items()), "file string, stamp string")


def _stored(spark: SparkSession, state_dir: str) -> DataFrame:
    target = spark._jvm.org.apache.hadoop.fs.Path(state_dir)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(state_dir)


def file_states(df: DataFrame, cols: Sequence[str], label_col: str | None) -> DataFrame:
    """States of the files of a scan, in one pass: a row per file and column, per file and label, and per file."""
    items = [F.struct(F.lit(FEATURE).alias("kind"), F.lit(i).alias("ordinal"), F.lit(c).alias("name"), F.col(c).cast("double").alias("x"))
             for i, c in enumerate(cols)]
    none = F.lit(None).cast("double").alias("x")
    if label_col:
        items.append(F.struct(F.lit(LABEL).alias("kind"), F.lit(0).alias("ordinal"), F.col(label_col).cast("string").alias("name"), none))
    items.append(F.struct(F.lit(ROWS).alias("kind"), F.lit(0).alias("ordinal"), F.lit("").alias("name"), none))
    long = df.select(F.col("_metadata.file_path").alias("file"), F.explode(F.array(*items)).alias("s")).select("file", "s.*")
    return long.groupBy("file", "kind", "ordinal", "name").agg(
        F.when(F.col("kind") == FEATURE, F.count("x")).otherwise(F.count(F.lit(1))).alias("n"), F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("m2"), F.min("x").alias("min_value"), F.max("x").alias("max_value"))


def update_profile(spark: SparkSession, path: str, cols: Sequence[str], label_col: str | None, state_dir: str) -> list[str]:
    """Read the Parquet files of ``path`` that ``state_dir`` has no state of, and add theirs; the files read.

    A file that has changed is read again; the states of files that are gone or have changed no
    longer count.  The list of files is the driver's, as it is for any scan of the folder.
    """
    now = _files(spark, path)
    known = {(r["file"], r["stamp"]) for r in _stored(spark, state_dir).select("file", "stamp").distinct().toLocalIterator()}
    new = sorted(f for f, stamp in now.items() if (f, stamp) not in known)
    if new:
        scheme = path.partition(":")[0] + ":" if "://" in path or path.startswith("file:") else ""
        states = file_states(spark.read.parquet(*[scheme + f for f in new]), cols, label_col)
        states = states.withColumn("file", F.expr("parse_url(file, 'PATH')"))
        states = states.join(_listing(spark, now), "file")
        states.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE.fields]).write.mode("append").parquet(state_dir)
    return new


def current_states(spark: SparkSession, path: str, state_dir: str) -> DataFrame:
    """The stored states of the files that ``path`` holds as they are now."""
    now = _files(spark, path)
    if not now:
        return spark.createDataFrame([], STATE)
    return _stored(spark, state_dir).join(_listing(spark, now), ["file", "stamp"]).select(*STATE.names)


def merged_description(states: DataFrame, decimals: int | None = None) -> DataFrame:
    """ordinal, feature, n, mean, stddev, min_value, max_value - as ``profile.describe_features`` of all files.

    Σ m2 and the deviations of the files' means from the common mean add up to the table's; the
    common mean comes first, so that no large squares cancel.
    """
    own = states.filter(F.col("kind") == FEATURE)
    means = own.groupBy("ordinal", "name").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("mean")).alias("total"))
    means = means.select(F.col("ordinal").alias("of"), F.when(F.col("all") > 0, F.col("total") / F.col("all")).alias("center"))
    apart = F.col("mean") - F.col("center")
    out = own.join(means, own["ordinal"] == means["of"]).groupBy("ordinal", F.col("name").alias("feature")).agg(
        F.sum("n").alias("n"), F.first("center").alias("mean"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    out = out.select("ordinal", "feature", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
                     "min_value", "max_value")
    if decimals is not None:
        for c in ("mean", "stddev", "min_value", "max_value"):
            out = out.withColumn(c, F.round(c, decimals))
    return out


def merged_labels(states: DataFrame, decimals: int = 6) -> DataFrame:
    """label (as text), rows, share - as ``profile.label_distribution`` of all files."""
    rows = states.groupBy("kind", "name").agg(F.sum("n").alias("rows")).withColumn("_all", F.pmod(F.xxhash64("kind"), F.lit(1)))
    total = rows.filter(F.col("kind") == ROWS).select("_all", F.col("rows").alias("_n"))
    out = rows.filter(F.col("kind") == LABEL).join(total, "_all")
    return out.select(F.col("name").alias("label"), "rows", F.round(F.col("rows") / F.col("_n"), decimals).alias("share"))
