"""Layout of data that iterative learners read many times.

Spark ML's bagging and split sampling follow partitions and the order of rows within them,
so a fitted forest depends on the layout of its input.  The layout here depends on the rows
and on configuration only - never on cores, executors or file layout: rows are dealt to
partitions, of which there are more for more rows, by a hash of the key (or of their values,
without a key) and sorted within each partition.  The same rows give the same trees on any cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partitions of training data, and rows of one beyond which there are more, so that what a task sorts and caches
#: doesn't grow with the table.  ``spark.riskloom.trainPartitions`` fixes their number; trees change with it.
TRAIN_PARTITIONS, PARTITION_ROWS = 16, 1_000_000
SETTING = "spark.riskloom.trainPartitions"


def train_partitions(df: DataFrame, rows: int = 0) -> int:
    """Partitions for a table of that many rows."""
    fixed = df.sparkSession.conf.get(SETTING, None)
    return int(fixed) if fixed else max(TRAIN_PARTITIONS, -(-rows // PARTITION_ROWS))


def training_layout(df: DataFrame, by: Sequence[str], n: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows dealt by a hash over the columns ``by`` and sorted by it, then by them.

    Give every column that tells rows apart, features included: then a key that holds a large
    share of the rows is spread like any others, and only rows equal in all of them meet.
    With ``keep`` the hash is taken first and only these columns are shuffled: of rows with the same
    hash, those that differ in none of them need no order.
    """
    n = n or train_partitions(df)
    if keep is None:
        order = F.xxhash64(*by)
        return df.repartition(n, order).sortWithinPartitions(order, *by)
    hashed = df.select(*keep, F.xxhash64(*by).alias("hash of row"))
    return hashed.repartition(n, "hash of row").sortWithinPartitions("hash of row", *keep).drop("hash of row")


def weighted_layout(df: DataFrame, by: Sequence[str], n: int | None = None, weight: str = "weight") -> DataFrame:
    """Equal rows as few rows with a weight, dealt evenly; for tables without a key.

    Rows are counted by all columns (map-side, so a hot row is one entry per task), and a row that
    occurs c times becomes min(c, n) rows whose whole-number weights sum to c, on that many
    neighbouring partitions beginning at its hash: no partition gets more than its share of a row
    that fills a third of the table.  The layout depends on rows and configuration only.
    """
    n = n or train_partitions(df)
    return deal_weighted(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(weight)), by, n, weight)


def deal_weighted(counted: DataFrame, by: Sequence[str], n: int, weight: str = "weight") -> DataFrame:
    """The layout of rows that were counted: ``weight`` holds how often each occurs."""
    order, columns = F.xxhash64(*by), [c for c in counted.columns if c != weight]
    copies = F.col(weight).cast("bigint")
    parts = F.least(copies, F.lit(n))
    dealt = counted.withColumn("share of row", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    share = F.floor(copies / parts) + F.when(F.col("share of row") < copies % parts, 1).otherwise(0)
    dealt = dealt.select(*columns, share.cast("double").alias(weight), F.pmod(order + F.col("share of row"), F.lit(n)).cast("int").alias("part of row"))
    return dealt.repartitionById(n, "part of row").drop("part of row").sortWithinPartitions(order, *by)


def repeated(df: DataFrame, weight: str = "weight") -> DataFrame:
    """Each row as often as its weight says, within its partition (for learners that draw rows)."""
    return df.withColumn(weight, F.explode(F.sequence(F.lit(1), F.col(weight).cast("int")))).drop(weight)


def tree_depth(n_partitions: int, fan_in: int = 32) -> int:
    """Depth of tree aggregation so that no task merges more than about ``fan_in`` partial sums."""
    depth, reach = 2, fan_in ** 2
    while reach < n_partitions:
        depth, reach = depth + 1, reach * fan_in
    return depth
