"""Session construction and the shared scratch folder.

Library code never owns the session: every job takes ``spark`` from its caller.
``build_session`` exists for tests, ``bench.py`` and command-line use.

Intermediate tables that must survive executor loss (training inputs of iterative
learners, stream sources/sinks, saved pipelines) are written under the folder the
cluster names in ``spark.checkpoint.dir``.  Only a local-mode session without that
setting gets a private temporary folder (the test situation).
"""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

from riskloom.errors import ScratchUnavailable

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "riskloom",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with AQE on and the UI off."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise ScratchUnavailable(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
            "checkpoints, materialised training tables and stream state"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path (URI) below the shared checkpoint folder; only Spark reads and writes it."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "riskloom", *parts])


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, on whatever filesystem it is."""
    if not path.startswith(scratch_path(spark)):
        raise ValueError(f"not a scratch folder: {path!r}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def input_state(spark: SparkSession, *paths: str) -> str:
    """Token of the files behind the paths (names, lengths, times): it changes when an input does."""
    found = []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        statuses = list(fs.listStatus(target)) if fs.exists(target) else []
        found += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in statuses)
    return stable_token(*found)


def stable_token(*values: object) -> str:
    """Short deterministic token used to name scratch tables per input."""
    text = "\x1f".join(str(v) for v in values)
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:12]
