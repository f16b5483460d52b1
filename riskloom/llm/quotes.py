"""Quotation linking (DataFrame functions only).

Messages are read line by line: the run of ``>`` at a line's start is its quote level.  Each
quoted line is a passage; its normalised text is hashed and joined to the earliest message
of the conversation that has the passage as text of its own.  A message answers the message
that most of its outermost linked passages come from; conversations are then listed thread
by thread, without quotes, every message behind the one it answers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch, ascii_lower

#: Quote marks at the start of a line, with white space between them.
MARKS = r"^[\x20\t]*>[>\x20\t]*"


def _level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _normal(line: Column) -> Column:
    """Content of a line: without marks, A-Z lower-cased, white space single."""
    return F.trim(F.regexp_replace(ascii_lower(F.regexp_replace(line, MARKS, "")), r"[\x20\x09-\x0D]+", " "))


def _join(left: DataFrame, right: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    """Null-safe equi-join; the right side's key columns have names of their own and are dropped."""
    condition = reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in on.items()])
    out = left.join(right, condition, how)
    return out if how == "left_semi" else out.drop(*[right[b] for b in on.values()])


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, own_text, quote_depth, n_quoted, n_linked, parent_turn, root_turn,
    thread_depth, position.

    ``own_text`` has no quoted lines (and no blank lines at its ends); n_quoted counts quoted
    lines with content, n_linked those found in an earlier turn.  The parent is taken from the
    outermost level with links, by most linked lines, then the latest turn.  ``position`` counts
    from 0 within a conversation, by the thread's first turn, then turn, role and text.  Null and
    empty texts have no lines of content; a null conversation is a conversation of its own;
    rows that repeat a turn are one message with several texts; a null turn neither quotes
    nor is quoted and comes first.  No messages give no rows.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "quotes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(F.regexp_replace(text, "\r", ""), "\n", -1)
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                           text.alias("text"), F.transform(lines, lambda x: F.struct(
                               x.alias("line"), _level(x).alias("level"), _normal(x).alias("normal"))).alias("lines"))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    quoted = F.filter("lines", lambda x: (x["level"] > 0) & (x["normal"] != ""))
    rows = scratch.table(rows.select(
        "conv", "turn", "role", F.xxhash64("text").alias("order"), F.btrim(own, F.lit("\n")).alias("own_text"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).alias("quote_depth"),
        F.transform(quoted, lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["normal"]).alias("h"),
                                               F.md5(x["normal"].cast("binary")).alias("m"))).alias("quoted"),
        F.transform(F.filter("lines", lambda x: (x["level"] == 0) & (x["normal"] != "")),
                    lambda x: F.struct(F.xxhash64(x["normal"]).alias("h"), F.md5(x["normal"].cast("binary")).alias("m"))).alias("own")), "lines")

    passages = rows.select("conv", "turn", F.explode("quoted").alias("q")).select("conv", "turn", "q.*")
    # only hashes that are quoted anywhere matter; the earliest owner of a passage is one row, however common it is
    asked = passages.select("conv", "h", "m").distinct().toDF("c", "qh", "qm")
    owners = rows.filter("turn is not null").select("conv", "turn", F.explode("own").alias("o")).select("conv", "turn", "o.*")
    owners = _join(owners, asked, {"conv": "c", "h": "qh", "m": "qm"}, "left_semi")
    owners = owners.groupBy("conv", "h", "m").agg(F.min("turn").alias("origin")).toDF("c", "oh", "om", "origin")
    linked = _join(passages, owners, {"conv": "c", "h": "oh", "m": "om"}, "inner").filter("origin < turn")
    counts = linked.groupBy("conv", "turn", "level", "origin").agg(F.count("*").alias("n"))
    best = F.min(F.struct("level", (-F.col("n")).alias("n"), (-F.col("origin")).alias("o")))
    parents = counts.groupBy("conv", "turn").agg((-best["o"]).alias("parent"), F.sum("n").alias("n_linked"))
    parents = scratch.table(parents, "parents")

    # pointer doubling: after k rounds 'up' is 2^k steps above, or the thread's first turn
    ups = parents.select("conv", "turn", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"))
    if not parents.isEmpty():
        ups, k, before = scratch.table(ups, "ups-0"), 0, -1
        while (moved := ups.agg(F.sum("steps")).first()[0]) != before:
            before, k = moved, k + 1
            above = ups.toDF("c", "t", "up2", "steps2")
            ups = _join(ups, above, {"conv": "c", "up": "t"}, "left")
            ups = scratch.table(ups.select("conv", "turn", F.coalesce("up2", "up").alias("up"),
                                           (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps")), f"ups-{k}")
    tree = _join(parents, ups.toDF("c", "t", "root", "steps"), {"conv": "c", "turn": "t"}, "inner")
    tree = tree.toDF("c", "t", "parent", "n_linked", "root", "steps")
    out = _join(rows.drop("own"), tree, {"conv": "c", "turn": "t"}, "left").withColumn("root", F.coalesce("root", "turn"))

    # positions: range-partitioned and sorted, counted by part of a conversation, so that a
    # conversation of any length is spread over tasks
    keys = ["conv", "root", "turn", "role", "order"]
    out = out.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    out = scratch.table(out, "sorted").withColumn("part", F.shiftright("at", 33))
    parts = out.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    so_far = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # parts, not rows
    parts = parts.select(F.col("conv").alias("c"), F.col("part").alias("p"), "first",
                         F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    out = _join(out, parts, {"conv": "c", "part": "p"}, "inner")
    return out.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "own_text", "quote_depth",
        F.size("quoted").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"),
        F.coalesce("steps", F.lit(0)).cast("long").alias("thread_depth"),
        (F.col("before") + F.col("at") - F.col("first")).cast("long").alias("position"))
