"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket; the bucket in which a source's budget ends is
the only one that is refined, level by level, until its cells are single hash values.  The
mix is then a filter ``hash < threshold`` - no sort of documents, no rank, and nested: a
larger budget keeps all that a smaller one took.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch

#: Nine hex digits of an md5: 36 bits, read as three levels of 12 bits.
HASH_HEX, LEVEL_BITS, LEVELS = 9, 12, 3


def count_words(text: Column) -> Column:
    """Number of runs of other than ASCII white space; null has none."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words)).cast("bigint")


def mix_hash(id_col: Column, text: Column) -> Column:
    """36-bit value in which no source has an order."""
    key = F.concat_ws("|", F.lit("mix"), id_col.cast("string"), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_HEX), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) for one row per source in ``sizes`` (source, source_size).

    Sources in code-point order, null last, take ``weights`` in turn and share ``share`` times
    the whole size; a target stops at ``most`` times its source's size and the excess is
    reshared by weight until none is above.  The table has one row per source - as long as
    the list of sources to which somebody gave weights, whatever the number of documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    table = sizes.withColumn("weight", turn)
    # level of water: capped sources, in the order in which the level reaches their cap
    table = table.withColumn("reach", F.lit(most) * F.col("source_size") / F.col("weight"))
    by_reach = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before, behind = by_reach.rowsBetween(Window.unboundedPreceding, -1), by_reach.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    table = table.withColumn("level", (budget - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
                             / F.sum("weight").over(behind))
    # capping the wrong sources leaves too little for the others, so the true level is the highest of all
    table = table.withColumn("water", F.max("level").over(Window.partitionBy()))
    target = F.least(F.lit(most) * F.col("source_size"), F.col("water") * F.col("weight"))
    return table.select("source", "source_size", target.cast("double").alias("target"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], share: float,
             most: float) -> tuple[DataFrame, DataFrame]:
    """Slim rows (id, source, size, h), and by source: of, source_size, target, full passes, rest, threshold."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = scratch.table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        count_words(F.col(text_col)).alias("size"), mix_hash(F.col(id_col), F.col(text_col)).alias("h")), "rows")

    top = LEVEL_BITS * (LEVELS - 1)
    counts = scratch.table(rows.groupBy("source", F.shiftright("h", top).alias("cell")).agg(F.sum("size").alias("words")),
                           "histogram")
    sizes = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    full = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("full", full.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("full") * F.col("source_size"))
    targets = scratch.table(targets, "targets")

    # found: where the budget ends so far - prefix (all cells below are taken) and what is left for the cell
    found = targets.select("source", "rest", F.lit(0).cast("bigint").alias("prefix"), F.lit(0.0).alias("below"))
    for k in range(LEVELS):
        if k:
            shift = LEVEL_BITS * (LEVELS - 1 - k)
            inside = found.select(F.col("source").alias("s"), "prefix")
            counts = (rows.join(inside, F.col("source").eqNullSafe(F.col("s"))
                                & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")))
                      .groupBy("source", F.shiftright("h", shift).alias("cell")).agg(F.sum("size").alias("words")))
        order = Window.partitionBy("source").orderBy("cell")  # 4,096 cells of a source at most
        left = found.select(F.col("source").alias("s"), "rest", "below")
        cells = (counts.withColumn("upto", F.sum("words").over(order))
                 .join(left, F.col("source").eqNullSafe(F.col("s"))))
        upto = F.col("below") + F.col("upto")
        ends = cells.filter((upto > F.col("rest")) & (upto - F.col("words") <= F.col("rest")))
        found = scratch.table(ends.select("source", "rest", F.col("cell").alias("prefix"),
                                          (upto - F.col("words")).alias("below"), upto.alias("upto")), f"ends-{k}")
    # the last cell is one hash value: in or out, whichever is nearer (a tie takes it)
    within = (F.col("upto") - F.col("rest") <= F.col("rest") - F.col("below")) & (F.col("rest") > 0)
    limits = found.select(F.col("source").alias("s"), (F.col("prefix") + F.when(within, 1).otherwise(0)).alias("threshold"))
    plan = targets.join(limits, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = scratch.table(plan.withColumnRenamed("source", "of"), "plan")
    return rows, plan


def _passes() -> Column:
    """How often the mix takes a row of documents joined to its source's plan."""
    extra = F.when((F.col("rest") > 0) & (F.col("h") < F.col("threshold")), 1).otherwise(0)
    return F.when(F.col("size") > 0, F.col("full") + extra).otherwise(0)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes of the document: whole passes over its
    source, and one more if its hash lies below the source's threshold.  Null texts have size
    0; documents of size 0 are never taken; null is a source of its own; rows with the same
    hash (repeated rows) are taken together; an empty table gives no rows.  The hash depends
    on id and text only, so reruns agree on any cluster.
    """
    rows, plan = _planned(docs, id_col, text_col, source_col, weights, share, most)
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * _passes()).cast("bigint").alias("taken"))


def materialise_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, once for every pass that takes them."""
    _, plan = _planned(docs, id_col, text_col, source_col, weights, share, most)
    names = [f"column {i}" for i in range(len(docs.columns))]
    of, text, source = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col, source_col))
    rows = docs.toDF(*names).withColumns({"size": count_words(text), "h": mix_hash(of, text)})
    rows = rows.join(plan, source.cast("string").eqNullSafe(F.col("of"))).withColumn("passes", _passes().cast("int"))
    rows = rows.filter("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    return rows.select(*names).toDF(*docs.columns)
