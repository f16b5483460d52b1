"""Sharding by sampled splitters.

Records have a key (hash of the text, hash of the id, row number): equal texts are
neighbours in key order.  A size-weighted sample of keys gives quantile boundaries of many
small ranges; the exact bytes of each range are then counted, ranges that turn out overfull
are subdivided from a sample of their own, and shards are runs of neighbouring ranges.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch

#: Ranges per shard at least, and bytes of text per range at most (so ranges grow with the data).
RANGES_PER_SHARD, RANGE_BYTES = 128, 2 << 30
#: Sampled keys per range; a range of more than OVERFULL times its share is subdivided.
SAMPLES_PER_RANGE, OVERFULL = 16, 3
#: A cut moves to the nearest start of an equal-text group within this part of a shard's bytes.
WHOLE_GROUPS_WITHIN = 0.02
#: Sorts before every key part; the parts are longs above it.
LOWEST = np.iinfo(np.int64).min
KEY = ["k1", "k2", "k3"]


def lex_searchsorted(bounds: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """For each key (columns of equal length) the number of lexicographically sorted bounds <= it."""
    left, right = np.searchsorted(bounds[0], keys[0], "left"), np.searchsorted(bounds[0], keys[0], "right")
    if len(bounds) == 1:
        return right
    out = right.copy()
    tied = np.nonzero(left < right)[0]
    if len(tied):
        order = tied[np.argsort(left[tied], kind="stable")]
        for group in np.split(order, np.nonzero(np.diff(left[order]))[0] + 1):
            lo, hi = left[group[0]], right[group[0]]
            out[group] = lo + lex_searchsorted([b[lo:hi] for b in bounds[1:]], [k[group] for k in keys[1:]])
    return out


def _with_range(rows: DataFrame, bounds: np.ndarray, shard: np.ndarray | None = None,
                base: np.ndarray | None = None) -> DataFrame:
    """``rows`` with the number of their range; with its shard and its first slot if given."""
    columns = [np.ascontiguousarray(bounds[:, i]) for i in range(3)]
    shared = rows.sparkSession.sparkContext.broadcast((columns, shard, base))
    extra = "range int" + (", shard int, base long" if shard is not None else "")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", " + extra

    def assign(batches):
        parts, shards, bases = shared.value
        for batch in batches:
            at = lex_searchsorted(parts, [batch.column(k).to_numpy(zero_copy_only=False) for k in KEY])
            more = [pa.array(at, pa.int32())]
            if shards is not None:
                more += [pa.array(shards[at], pa.int32()), pa.array(bases[at], pa.int64())]
            names = [*batch.schema.names, "range", "shard", "base"][: len(batch.schema.names) + len(more)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)

    return rows.mapInArrow(assign, schema)


def _sample(rows: DataFrame, per_byte: dict[int, float] | float, seed: int) -> np.ndarray:
    """Keys drawn with probability size x rate, with the weight each stands for: rows (k1, k2, k3, weight, range).

    The draw is a hash of the key, so a rerun draws the same; with rates by range the expected
    number of rows is SAMPLES_PER_RANGE for each range asked for, whatever the table's size.
    """
    if isinstance(per_byte, dict):
        rate = F.lit(0.0)
        rates = sorted(per_byte.items())
        rate = F.element_at(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in rates]),
                                              F.array(*[F.lit(float(v)) for _, v in rates])), F.col("range"))
        rows = rows.filter(F.col("range").isin([k for k, _ in rates]))
    else:
        rate = F.lit(float(per_byte))
        rows = rows.withColumn("range", F.lit(0))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *KEY), 11) / F.lit(float(1 << 53))
    picked = rows.withColumn("p", F.col("size") * rate).filter(draw < F.col("p"))
    got = picked.select(*KEY, F.greatest(F.col("p"), F.lit(1.0)).alias("w"), "range").toPandas()
    got = got.sort_values([*KEY]).reset_index(drop=True)
    return got


def sampled_splitter_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                            ranges_per_shard: int = RANGES_PER_SHARD, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per input row: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    A record's size is the UTF-8 bytes of its text plus 1 (null texts: 1, crc32 0).  Shards
    hold nearly equal bytes; equal texts share a shard unless a cut falls into a group of
    copies too large to move it.  Repeated rows are told apart by a row number, so even a
    row repeated in a third of the table is split.  Slots are 0, 1, 2 … within a shard.  An
    empty table gives no rows.  Only keys and sizes move, never texts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = scratch.table(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(raw).alias("crc"), F.xxhash64(raw).alias("k1"), F.xxhash64(F.col(id_col).cast("string")).alias("k2"),
        F.monotonically_increasing_id().alias("k3")), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_ranges = max(n_shards * ranges_per_shard, math.ceil(total / range_bytes))
    share = max(total / n_ranges, 1.0)

    sample = _sample(rows, SAMPLES_PER_RANGE / share, 1)
    marks = np.searchsorted(np.cumsum(sample["w"].to_numpy()), np.arange(1, n_ranges) * SAMPLES_PER_RANGE)
    starts = np.unique(sample["k1"].to_numpy()[marks[marks < len(sample)]])  # ranges begin with a group of equal texts
    bounds = np.column_stack([starts, np.full(len(starts), LOWEST), np.full(len(starts), LOWEST)]).astype(np.int64)
    tried: set[bytes] = set()
    for turn in range(2, 8):
        counted = _with_range(rows, bounds).groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        held, n_in = np.zeros(len(bounds) + 1), np.zeros(len(bounds) + 1, np.int64)
        for r in counted.toLocalIterator():
            held[r["range"]], n_in[r["range"]] = r["bytes"], r["n"]
        first = lambda i: bounds[i - 1].tobytes() if i else b""
        overfull = [i for i in np.nonzero((held > OVERFULL * share) & (n_in > 1))[0] if (first(i), int(n_in[i])) not in tried]
        if not overfull or turn == 7:
            break
        tried |= {(first(i), int(n_in[i])) for i in overfull}
        more = _sample(_with_range(rows, bounds), {int(i): SAMPLES_PER_RANGE / share for i in overfull}, turn)
        added = []
        for i, part in more.groupby("range"):
            cuts = np.arange(1, math.ceil(held[i] / share)) * SAMPLES_PER_RANGE
            at = np.searchsorted(np.cumsum(part["w"].to_numpy()), cuts)
            added.append(part[KEY].to_numpy(np.int64)[np.unique(at[at < len(part)])])
        bounds = np.unique(np.concatenate([bounds, *added]), axis=0)

    # shards: runs of ranges whose ends are nearest to equal parts, at whole groups where one is near
    ends = np.cumsum(held)
    whole = np.append(bounds[:, 1] == LOWEST, True)
    cuts = []
    for j in range(1, n_shards):
        far = np.abs(ends - j * total / n_shards)
        near = whole & (far <= WHOLE_GROUPS_WITHIN * total / n_shards)
        cuts.append(int(np.argmin(np.where(near, far, np.inf) if near.any() else far)) + 1)
    shard = np.searchsorted(np.maximum.accumulate(cuts), np.arange(len(held)), "right").astype(np.int32)
    before = np.cumsum(n_in) - n_in
    first_of = np.full(n_shards, 0, np.int64)
    for s in range(n_shards):
        own = np.nonzero(shard == s)[0]
        first_of[s] = before[own[0]] if len(own) else 0
    placed = _with_range(rows, bounds, shard, before - first_of[shard])
    slot = F.col("base") + F.row_number().over(Window.partitionBy("range").orderBy(*KEY)) - 1
    return placed.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", slot.cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
