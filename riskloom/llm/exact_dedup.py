"""Exact dedup: tree-merge of sorted digest runs (DataFrame functions only).

Each input partition makes one run: its distinct digests, sorted, each with the best row
seen and a count.  In every round ``fan_in`` neighbouring runs meet and are merged; the
number of runs falls by that factor until one is left (fan_in 2 would be the binomial
tree).  The decisions then travel down the same tree, so that a group of copies that holds
a third of all rows is one record per run on the way up and never more than one
partition's rows under one join key on the way down.

A digest is believed only together with its evidence - normalised length and a second,
independent hash - so entries merge, at every level, only if all three agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, strip_spaces

#: What makes two texts the same entry: SHA-256, and the evidence that verifies it.
ENTRY = ["digest", "norm_len", "check"]


def tree_merge_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     fan_in: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ASCII white space; null counts as empty.
    Of equal texts the row with the most code points in the original text stays, then the
    smallest id (null ids last).  Repeated rows with the same id and text are one group of
    which exactly one row has ``kept``.  An empty table gives no rows; other columns of
    ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.char_length(text).alias("n_points"), strip_spaces(text).alias("norm"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("rid"))
    rows = scratch.table(rows.select(
        "id", "rid", "run", "n_points", F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.octet_length("norm").alias("norm_len"), F.xxhash64("norm").alias("check")), "rows")

    best = F.struct((-F.col("n_points")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "rid")
    level = rows.groupBy("run", *ENTRY).agg(F.min(best).alias("best"), F.count("*").alias("n"))
    level = scratch.table(level.sortWithinPartitions("run", "digest"), "runs-0")
    levels = [level]
    last_run = level.agg(F.max("run")).first()[0] or 0
    while last_run > 0:
        last_run //= fan_in
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy("run", *ENTRY)
                 .agg(F.min("best").alias("best"), F.sum("n").alias("n")))
        level = scratch.table(level.sortWithinPartitions("run", "digest"), f"runs-{len(levels)}")
        levels.append(level)

    # down the tree: only entries that met a copy need an answer
    answer = levels[-1].filter("n > 1").select("run", *ENTRY, F.col("best").alias("keep"), F.col("n").alias("size"))
    for level in reversed(levels[:-1]):
        down = answer.withColumnRenamed("run", "parent")
        answer = (level.select("run", *ENTRY, F.floor(F.col("run") / fan_in).cast("int").alias("parent"))
                  .join(down, ["parent", *ENTRY]).drop("parent"))
    out = rows.join(answer, ["run", *ENTRY], "left")
    alone = F.col("size").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("rid") == F.col("keep.rid"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
