"""Approximate nearest neighbours by cosine: multi-index hashing of learned rotated binary codes.

A code is the signs of a vector after rotations that are learned on a bounded sample so that
rotated vectors lie near the corners of a cube (Procrustes steps).  Each part of the table
keeps one index per substring of the code: its distinct values and the rows of each.  A query
with Hamming radius r probes, in the first r mod m + 1 of the m substrings, the values within
r // m bits of its own, and one bit less in the others: by the pigeonhole principle no code
within r is missed.  Codes that the probes find are compared in full, and those within r are
reranked by their vectors, in double precision.

The radius belongs to the query: its k-th best cosine in the sample is a lower bound of the
k-th best in the table, and rows at that angle or nearer have codes within a number of bits
that follows from the angle, with a margin measured on the sample.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch, pieces
from riskloom.llm.whitening import matrix, usable_vectors, usual_dimension

#: Rows on which rotations and margins are learned (the bound of what the driver fits on); learning steps of a rotation.
SAMPLE, STEPS = 4096, 30
#: Bits of a code and of a substring.
BITS, PART = 256, 16
#: Least margin of a radius, in standard deviations of a random code; share of the sample's neighbours it must hold.
MARGIN, HELD = 2.0, 0.99
#: Rows of one part of the table (and the least worth a part), queries of one block, queries probed at once.
INDEX_ROWS, LEAST_ROWS, QUERY_ROWS, PROBED = 16_384, 1024, 8192, 32


def learn_rotations(sample: np.ndarray, bits: int = BITS, steps: int = STEPS) -> np.ndarray:
    """(dimension, bits): orthogonal rotations side by side, each turned towards the signs of the rotated sample."""
    rng, dimension, parts = np.random.default_rng(7), sample.shape[1], []
    for _ in range(math.ceil(bits / dimension)):
        turn, _ = np.linalg.qr(rng.standard_normal((dimension, dimension)))
        for _ in range(steps):
            left, _, right = np.linalg.svd(sample.T @ np.sign(sample @ turn))
            turn = left @ right
        parts.append(turn)
    return np.hstack(parts)[:, :bits]


def encode(unit: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """(rows, bits / 8) bytes; entry by entry in a fixed order, so equal vectors have equal codes."""
    rotated = np.zeros((len(unit), rotations.shape[1]))
    for k in range(rotations.shape[0]):
        rotated += unit[:, k:k + 1] * rotations[k]
    return np.packbits(rotated >= 0, axis=1)


def even_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest entries near 1: cosines stay, and no square overflows."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))[1])


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1."""
    vectors = even_rows(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; sums run over the entries in order, so equal pairs have equal scores."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        x, y = a[:, k], b[:, k]
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _within(cosine: np.ndarray, bits: int, margin: float) -> np.ndarray:
    """Bits by which codes at such an angle differ, with a margin."""
    p = np.arccos(np.clip(cosine, -1, 1)) / math.pi
    return bits * p + margin * np.sqrt(bits * p * (1 - p)) + 1


class HashModel:
    """Rotations, the sample they were learned on (unit rows, codes, row numbers) and the margin of a radius."""

    def __init__(self, vectors: np.ndarray, rids: np.ndarray, k: int, bits: int = BITS):
        self.k, self.bits, self.rids = k, bits, rids
        self.unit = unit_rows(vectors)
        self.rotations = learn_rotations(self.unit, bits)
        codes, self.margin = encode(self.unit, self.rotations), MARGIN
        scores, at = [], []
        for s in range(0, len(vectors), 512):
            cosine = self.unit[s:s + 512] @ self.unit.T
            cosine[np.arange(len(cosine)), s + np.arange(len(cosine))] = -2
            near = np.argsort(-cosine, axis=1)[:, :k]
            near = near[:, :max(0, len(vectors) - 1)]
            scores.append(np.take_along_axis(cosine, near, axis=1))
            differ = np.bitwise_count(codes[s:s + 512, None] ^ codes[near]).sum(axis=2)
            p = np.arccos(np.clip(scores[-1], -1, 1)) / math.pi
            at.append(((differ - bits * p - 1) / np.sqrt(np.maximum(bits * p * (1 - p), 1))).ravel())
        if sum(map(len, at)):
            self.margin = max(MARGIN, float(np.quantile(np.concatenate(at), HELD)))

    def radius(self, unit: np.ndarray, rids: np.ndarray) -> np.ndarray:
        """Hamming radius of each query; all bits if the sample has fewer than k other rows."""
        out = np.full(len(unit), self.bits, np.int64)
        others = len(self.rids) - np.isin(rids, self.rids)
        for s in range(0, len(unit), 512):
            cosine = unit[s:s + 512] @ self.unit.T
            cosine[rids[s:s + 512, None] == self.rids] = -2
            if cosine.shape[1] >= self.k:
                bound = np.partition(cosine, -self.k, axis=1)[:, -self.k]
                out[s:s + 512] = np.minimum(self.bits, np.ceil(_within(bound, self.bits, self.margin)))
        out[others < self.k] = self.bits
        return out


class CodeIndex:
    """One index per substring over some codes: its distinct values, and for each row the number of its value."""

    def __init__(self, codes: np.ndarray):
        self.whole = codes.view(np.uint64)
        self.values, self.of = [], []
        for part in np.ascontiguousarray(codes).view(f"u{PART // 8}").T:
            values, of = np.unique(part, return_inverse=True)
            self.values.append(values)
            self.of.append(of)

    def search(self, codes: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of every code within each query's radius."""
        parts, own = len(self.values), codes.view(np.uint64)
        substrings = np.ascontiguousarray(codes).view(f"u{PART // 8}")
        found = np.zeros((len(codes), len(self.whole)), bool)
        for i in range(parts):
            reach = radius // parts - (i > radius % parts)
            probed = np.bitwise_count(substrings[:, i:i + 1] ^ self.values[i]) <= reach[:, None]
            some = probed.any(axis=1)
            found[some] |= probed[some][:, self.of[i]]
        query, row = np.nonzero(found)
        near = np.zeros(len(query), np.int64)
        for w in range(self.whole.shape[1]):
            near += np.bitwise_count(own[query, w] ^ self.whole[row, w])
        near = near <= radius[query]
        return query[near], row[near]


def best_of(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each query's k best rows, by score, then by id."""
    order = np.lexsort((vec, -score, query))
    ordered = query[order]
    first = np.searchsorted(ordered, ordered, "left")
    return order[np.arange(len(order)) - first < k]


def _searched(key: tuple, table: pa.Table, asked: pa.Table, dimension: int, k: int) -> pa.Table:
    """(query_rid, query_id, vec_id, rid, score): the k best rows of one part of the table for each query of one block."""
    own, queries = table.combine_chunks(), asked.combine_chunks()
    codes, vectors = _codes(own), even_rows(_vectors(own, dimension))
    query_codes, query_vectors = _codes(queries), even_rows(_vectors(queries, dimension))
    radius, rids, query_rids = (t.column(c).to_numpy() for t, c in ((queries, "radius"), (own, "rid"), (queries, "rid")))
    ids = own.column("id")
    order_id = np.where(ids.is_null().to_numpy(), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())
    index, found = CodeIndex(codes), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for s in range(0, len(query_codes), PROBED):
        query, row = index.search(query_codes[s:s + PROBED], radius[s:s + PROBED])
        query += s
        other = query_rids[query] != rids[row]
        query, row = query[other], row[other]
        score = cosines(query_vectors[query], vectors[row])
        best = best_of(query, score, order_id[row], k)
        found.append((query[best], row[best], score[best]))
    query, row, score = (np.concatenate(x) for x in zip(*found))
    query, row = pa.array(query), pa.array(row)
    return pa.table({"query_rid": queries.column("rid").take(query), "query_id": queries.column("id").take(query),
                     "vec_id": ids.take(row), "rid": own.column("rid").take(row), "score": pa.array(score)})


def _codes(rows: pa.Table) -> np.ndarray:
    """(rows, bytes of a code)."""
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8)
    return codes.reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, BITS // 8), np.uint8)


def _vectors(rows: pa.Table, dimension: int) -> np.ndarray:
    return np.vstack([matrix(c, dimension) for c in rows.column("v").chunks] or [np.zeros((0, dimension))])


RESULT = "query_id long, rank int, vec_id long, score double"


def hashed_neighbours(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                      queries: Column | None = None, bits: int = BITS, sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest cosine found for each query, nearest first.

    Queries are the rows for which ``queries`` (a condition on ``id_col``; by default: divisible by
    50) holds; candidates are all rows but the query's own.  Rows whose vector is null, empty, zero
    or holds null or non-finite entries take no part, nor do those of other than the most frequent
    length.  Ties go to the smaller id (null last).  Rows that repeat an id are
    queries and candidates of their own.  With fewer than k other rows all are returned; an
    empty table gives no rows; other columns are ignored, whatever their names.  The search is
    approximate only in the radius: every code within it is found, and no list is cut.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hash-search")
    vectors = usable_vectors(rows, id_col, vector_col, math.inf).filter(F.exists("v", lambda c: c != 0))
    vectors = vectors.select(F.col("id").cast("bigint").alias("id"), "v", F.monotonically_increasing_id().alias("rid"))
    dimension = usual_dimension(vectors)
    if not dimension:
        return spark.createDataFrame([], RESULT)
    vectors = scratch.table(vectors.filter(F.size("v") == dimension), "vectors")

    # the sample: the rows of smallest hash, sample_rows at most
    picked = vectors.orderBy(F.xxhash64("rid"), "rid").limit(sample_rows).toArrow().combine_chunks()
    given = spark.sparkContext.broadcast(HashModel(_vectors(picked, dimension), picked.column("rid").to_numpy(), k, bits))

    def coded(batches):
        for batch in pieces(batches, 1 << 20):
            codes = encode(unit_rows(matrix(batch.column("v"), dimension)), given.value.rotations)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())],
                                             names=[*batch.schema.names, "code"])

    def with_radius(batches):
        for batch in pieces(batches, 1 << 20):
            radius = given.value.radius(unit_rows(matrix(batch.column("v"), dimension)), batch.column("rid").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(radius)], names=[*batch.schema.names, "radius"])

    row = "id long, v array<double>, rid long, code binary"
    table = scratch.table(vectors.mapInArrow(coded, row), "codes")
    condition = F.col("id") % 50 == 0 if queries is None else queries
    asked = scratch.table(table.filter(condition).mapInArrow(with_radius, f"{row}, radius long"), "queries")

    # parts of the table meet blocks of queries; both have a bounded number of rows
    n, n_asked = table.count(), asked.count()
    parts = max(math.ceil(n / INDEX_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / LEAST_ROWS)))
    blocks = max(1, math.ceil(n_asked / QUERY_ROWS))
    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    number = lambda size: F.pmod(F.xxhash64("rid"), F.lit(size)).cast("int")
    left = table.withColumns({"part": number(parts), "block": every(blocks)}).groupBy("part", "block")
    right = asked.withColumns({"block": number(blocks), "part": every(parts)}).groupBy("part", "block")

    def meet(key, own, queries):
        return _searched(key, own, queries, dimension, k)

    found = left.cogroup(right).applyInArrow(meet, "query_rid long, query_id long, vec_id long, rid long, score double")
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
