"""N-gram Jaccard join with a count-vector R-tree.

A document is its set of distinct word 4-shingles.  Shingles are hashed into groups; the
group counts of a document are a point, and the overlap of two sets is at most the sum of
the coordinates' minima - for a tree node, the minima with its upper corner.

Sets meet by group content: two sets that link differ in at most ``d`` shingles, so of any
``d + 1`` groups one holds the same shingles in both, and the first ``d + 1`` non-empty
groups in a common order share one.  Sets that meet are first held against the smallest of
their cells, a pair or two for each set; what is linked by then needs no further look.  Cells
in which unlinked sets remain are searched by R-tree, and every surviving pair is verified
on the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import NO_SPACE, Scratch, cut_words, pieces, with_fields, word_hashes
from riskloom.llm.components import connected_components

SHINGLE, PERCENT = 4, 85
#: Coordinates of a count vector, entries of a tree node, and sets of a cell searched in one piece.
COORDINATES, FAN_OUT, CELL = 256, 16, 4096
#: Rounds in which every set tries one candidate, and bits of the map that tells which texts to read again.
BEST_FIRST, MAP_BITS = 2, 23
#: Sets of fewer than 2**SMALL shingles are grouped so finely that nearly every shingle is a group.
SMALL, FINE_BITS = 7, 16
_K = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _K
    return h ^ (h >> np.uint64(32))


def _chain(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for w in columns:
        h = _mix(h ^ w)
    return h


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    words, text = cut_words(texts, NO_SPACE)
    flat, size = word_hashes(words), np.bincount(text, minlength=len(texts))
    last = max(0, len(flat) - SHINGLE + 1)
    every = _chain([flat[k:k + last] for k in range(SHINGLE)])
    for n, end in zip(size.tolist(), np.cumsum(size).tolist()):
        if n >= SHINGLE:
            yield np.unique(every[end - n:end - SHINGLE + 1])
        else:
            yield _chain([flat[k:k + 1] for k in range(end - n, end)]) if n else np.zeros(0, np.uint64)


def most_different(n: int, percent: int) -> int:
    """Shingles by which a set of n can differ at most from a set that it links with."""
    return n * (100 - percent) // percent


def cell_keys(u: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two linked sets share one; u: sorted distinct hashes, not empty.

    The size class (power of two) fixes the groups; a set that may link with one of the next
    class has keys of that class, too.
    """
    n = len(u)
    own = n.bit_length() - 1
    top = own + 1 if n * 100 // percent >= 1 << (own + 1) else own
    keys, need = [], most_different(n, percent) + 1
    mixed = _mix(u)
    for size_class in range(own, top + 1):
        bits = size_class - 1 if size_class >= SMALL else FINE_BITS
        group = u >> np.uint64(64 - bits)
        starts = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1])
        counts = np.diff(np.append(starts, n))
        content = _mix(np.add.reduceat(mixed, starts) ^ _mix(group[starts] + np.uint64(size_class << 40)))
        order = np.lexsort((content, -counts))[:need]  # fuller groups first: fewer sets share them by chance
        keys.append(content[order])
    return np.concatenate(keys)


def _needed(a, b, percent: int):
    """Least overlap with which sets of a and b shingles link."""
    return -(-percent * (a + b) // (100 + percent))


class RTree:
    """Packed tree over count vectors; each node has its upper corner, sizes, and component if it has one only."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, component: np.ndarray, percent: int):
        self.percent, order = percent, np.lexsort((vectors[:, 0], sizes))
        self.order = order
        self.vectors, self.sizes, self.component = vectors[order], sizes[order], component[order]
        self.levels = [(self.vectors, self.sizes, self.sizes, self.component)]
        while len(self.levels[-1][1]) > FAN_OUT:
            upper, low, high, comp = self.levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            first, last = np.minimum.reduceat(comp, at), np.maximum.reduceat(comp, at)
            self.levels.append((np.maximum.reduceat(upper, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.where(first == last, first, -1)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, bound) of different components whose overlap may be enough, i before j in the tree's order."""
        found = []
        for block in range(0, len(self.sizes), 256):
            q = np.arange(block, min(block + 256, len(self.sizes)))
            nodes = np.arange(len(self.levels[-1][1]))
            who, node = np.repeat(q, len(nodes)), np.tile(nodes, len(q))
            for depth in range(len(self.levels) - 1, -1, -1):
                upper, low, high, comp = self.levels[depth]
                span = FAN_OUT ** depth
                size = self.sizes[who]
                # a later entry has at least the size of an earlier one
                ok = ((node + 1) * span > who + 1) & (low[node] * self.percent <= size * 100) & (comp[node] != self.component[who])
                who, node = who[ok], node[ok]
                bound = [np.minimum(self.vectors[who[k:k + 16384]], upper[node[k:k + 16384]]).sum(axis=1, dtype=np.int64)
                         for k in range(0, len(who), 16384)]
                bound = np.concatenate(bound) if bound else np.zeros(0, np.int64)
                keep = bound >= _needed(self.sizes[who], np.maximum(low[node], self.sizes[who]), self.percent)
                who, node, bound = who[keep], node[keep], bound[keep]
                if depth:
                    below = len(self.levels[depth - 1][1])
                    who, node = np.repeat(who, FAN_OUT), (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                    ok = node < below
                    who, node = who[ok], node[ok]
            later = node > who
            found.append((who[later], node[later], bound[later]))
        i, j, bound = (np.concatenate(x) for x in zip(*found))
        return self.order[i], self.order[j], bound


def _vector(u: np.ndarray) -> bytes:
    """Counts of a set's shingles by group, two bytes each, or four if the set is that large."""
    counts = np.bincount((u & np.uint64(COORDINATES - 1)).astype(np.int64), minlength=COORDINATES)
    return counts.astype("<u2" if len(u) < 1 << 16 else "<u4").tobytes()


def _vectors(column) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(v) == 2 * COORDINATES for v in raw):
        return np.frombuffer(b"".join(raw), "<u2").reshape(-1, COORDINATES)
    return np.stack([np.frombuffer(v, "<u2" if len(v) == 2 * COORDINATES else "<u4").astype(np.uint32) for v in raw])


class NgramJaccard:
    """One join: ``sets`` (id, n, digest) by row, and ``classes`` (digest, component, component_id)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT):
        self.percent = percent
        self.scratch = Scratch(docs.sparkSession, "ngram-join")
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        table = self.scratch.table
        described = table(self._describe(), "sets")
        self.sets = described.select("id", "n", "digest")
        # distinct sets: copies meet here, whatever their number, and go on as one
        nodes = described.filter("n > 0").groupBy("digest").agg(
            F.min("id").alias("rep_id"), F.first("n").alias("n"), F.first("vector").alias("vector"), F.first("keys").alias("keys"))
        nodes = table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        self.nodes = nodes.drop("keys")
        keys = nodes.select("node", F.explode("keys").alias("key"))
        cells = keys.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("held")).filter("held > 1")
        cells = table(keys.join(cells, "key"), "cells")
        # one pair for each set: with the smallest set of all its cells
        others = cells.filter("node != center")
        tried = table(others.groupBy(F.col("node").alias("b")).agg(F.min("center").alias("a")), "first-pairs")
        links = self._links(tried, "first")
        component = connected_components(links, self.scratch, "first-joined")
        # another for each component of a cell's smallest set that a set is not in yet
        placed = self._placed(others.select("key", "node", "center"), component, "center", "at_center")
        placed = self._placed(placed, component, "node", "at_node").filter("at_node != at_center")
        more = placed.groupBy(F.col("node").alias("b"), "at_center").agg(F.min("center").alias("a")).select("a", "b")
        more = table(more.join(tried, ["a", "b"], "left_anti"), "second-pairs")
        links = links.unionByName(self._links(more, "second"))
        component = connected_components(links, self.scratch, "second-joined")
        tried = tried.unionByName(more)
        # where sets of several components share a cell, each tries its best candidate by the tree before all are listed
        for turn in range(BEST_FIRST):
            best = self._unlinked(cells, component, f"best-{turn}", best=True).join(tried, ["a", "b"], "left_anti")
            best = table(best, f"best-pairs-{turn}")
            self.scratch.remove(f"best-{turn}-cells")
            found = self._links(best, f"best-{turn}")
            links, tried = links.unionByName(found), tried.unionByName(best)
            if found.isEmpty():
                break
            component = connected_components(links, self.scratch, f"best-joined-{turn}")
        rest = table(self._unlinked(cells, component, "rest").join(tried, ["a", "b"], "left_anti"), "rest-pairs")
        self.scratch.remove("rest-cells", "cells")
        links = links.unionByName(self._links(rest, "rest"))
        component = connected_components(links, self.scratch, "joined")
        nodes = self.nodes.select("node", "digest", "rep_id").join(component, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        least = nodes.groupBy("component").agg(F.min("rep_id").alias("component_id"))
        self.classes = table(nodes.join(least, "component").select("digest", "component", "component_id"), "classes")

    def _describe(self) -> DataFrame:
        percent = self.percent
        kind = self.docs.schema["id"].dataType.simpleString()

        def describe(batches):
            for batch in pieces(batches, 1 << 19):
                n, digest, vector, keys = [], [], [], []
                for u in shingle_sets(batch.column("text")):
                    n.append(len(u))
                    digest.append(xxhash.xxh128_digest(u.tobytes()) if len(u) else None)
                    vector.append(_vector(u) if len(u) else None)
                    keys.append(cell_keys(u, percent).view(np.int64) if len(u) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(vector, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "vector", "keys"])

        return self.docs.mapInArrow(describe, f"id {kind}, n long, digest binary, vector binary, keys array<long>")

    @staticmethod
    def _placed(rows: DataFrame, component: DataFrame, node: str, name: str) -> DataFrame:
        """``rows`` with the component of their column ``node`` (itself if it has no link yet)."""
        known = component.select(F.col("node").alias(node), F.col("component").alias(name))
        return rows.join(known, node, "left").withColumn(name, F.coalesce(name, node))

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose summed coordinate minima allow the overlap that a link needs."""
        percent = self.percent
        for side in "ab":
            point = self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("vector").alias(f"v_{side}"))
            pairs = pairs.join(point, side)

        def bound(batches):
            for batch in pieces(batches):
                most = np.minimum(_vectors(batch.column("v_a")), _vectors(batch.column("v_b"))).sum(axis=1, dtype=np.int64)
                need = _needed(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(most >= need))

        return pairs.mapInArrow(bound, "a long, b long")

    def _links(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b) of the pairs that link, by their shingles."""
        percent = self.percent
        pairs = self.scratch.table(self._bounded(pairs), f"{name}-bounded")
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = self.scratch.table(wanted.join(self.nodes.select("node", "digest", "rep_id"), "node"), f"{name}-wanted")
        # the map (1 MB, whatever the corpus) spares an exchange of all texts; what it lets through in vain, the join drops
        place = F.xxhash64("rep_id").bitwiseAND((1 << MAP_BITS) - 1)
        words = wanted.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr("1L").alias("one"), place.alias("place"))
        words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, cast(place & 63 as int))")).alias("bits"))
        bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
        for row in words.toLocalIterator():
            bits[row["word"]] = row["bits"]
        shared = self.docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

        def shingles(batches):
            bits = shared.value
            for batch in pieces(batches, 1 << 19):
                h = batch.column("h").to_numpy().astype(np.int64)
                use = (bits[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1
                texts = batch.column("text").filter(pa.array(use))
                found = [u.tobytes() for u in shingle_sets(texts)] if len(texts) else []
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(u) for u in found], pa.binary()),
                                                  pa.array(found, pa.binary())], names=["digest", "shingles"])

        place = F.xxhash64("id").bitwiseAND((1 << MAP_BITS) - 1).alias("h")
        sets = self.docs.select(place, "text").mapInArrow(shingles, "digest binary, shingles binary")
        # copies have the same shingles: one of them is enough
        sets = wanted.select("node", "digest").join(sets.groupBy("digest").agg(F.first("shingles").alias("shingles")), "digest")
        sets = self.scratch.table(sets.select("node", "shingles"), f"{name}-shingles")
        for side in "ba":
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s_{side}")), side)

        def verify(batches):
            for batch in pieces(batches):
                same = []
                for a, b in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist()):
                    common = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                    same.append(100 * common >= percent * ((len(a) + len(b)) // 8 - common))
                yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

        found = self.scratch.table(pairs.select("a", "b", "s_a", "s_b").mapInArrow(verify, "a long, b long"), name)
        self.scratch.remove(f"{name}-bounded", f"{name}-wanted", f"{name}-shingles")
        shared.unpersist()
        del pairs, wanted, sets
        self.scratch.settle()
        return found

    def _unlinked(self, cells: DataFrame, joined: DataFrame, name: str, best: bool = False) -> DataFrame:
        """(a, b) of different components that share a cell and survive its tree; for each b only the best if asked."""
        percent = self.percent
        rows = self.scratch.table(self._placed(cells.select("key", "node"), joined, "node", "component"), f"{name}-cells")
        mixed = rows.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("held"))
        mixed = mixed.filter("c0 != c1").select("key", F.ceil(F.col("held") / CELL).cast("int").alias("blocks"))
        rows = rows.join(mixed, "key").join(self.nodes.select("node", "n", "vector"), "node")
        # a large cell is searched block against block, each pair of blocks a task of its own
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own",
                           "node", "component", "n", "vector")
        rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

        def search(batches):
            held = None
            for batch in pieces(batches):
                held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                cell = np.stack([held.column(c).to_numpy() for c in ("key", "lo", "hi")])
                ends = np.nonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0))[0] + 1
                if len(ends):
                    yield from found(held.slice(0, ends[-1]), [0, *ends])
                    held = held.slice(ends[-1])
            if held is not None and held.num_rows:
                yield from found(held, [0, held.num_rows])

        def found(batch, ends):
            node, component, own = (batch.column(c).to_numpy() for c in ("node", "component", "own"))
            n, v = batch.column("n").to_numpy(), _vectors(batch.column("vector"))
            lo, hi = batch.column("lo").to_numpy(), batch.column("hi").to_numpy()
            for s, e in zip(ends, ends[1:]):
                i, j, bound = RTree(v[s:e], n[s:e], component[s:e], percent).pairs()
                i, j = i + s, j + s
                if lo[s] != hi[s]:
                    across = own[i] != own[j]
                    i, j, bound = i[across], j[across], bound[across]
                if len(i):
                    yield grouped(np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), bound)

        def grouped(a, b, bound):
            """The candidates found in one piece of a cell; for each b the one with the highest bound only, if asked."""
            order = np.lexsort((a, -bound, b))
            a, b, bound = a[order], b[order], bound[order]
            if best:
                start = np.concatenate([[0], np.nonzero(np.diff(b))[0] + 1])
                a, b, bound = a[start], b[start], bound[start]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(bound)], names=["a", "b", "bound"])

        found_ = rows.mapInArrow(search, "a long, b long, bound long")
        if best:
            top = F.max(F.struct("bound", (-F.col("a")).alias("a"))).alias("top")
            return found_.groupBy("b").agg(top).select((-F.col("top.a")).alias("a"), "b")
        return found_.select("a", "b").distinct()  # a pair shares many cells


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    component_id is the smallest id that links reach, the row's own included (null ids count
    only where a component has no other).  A text of fewer than four words is one shingle; null and
    wordless texts have none, link with nothing and keep their own id.  Repeated rows link.
    An empty table gives no rows.
    """
    join = NgramJaccard(docs, id_col, text_col, percent)
    out = join.sets.join(join.classes, "digest", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, whatever their names: of each component the one with the smallest id, and
    rows without words.

    Where that id is repeated within its component, one of its rows stays.
    """
    names = [f"column {i}" for i in range(len(docs.columns))]
    of, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    renamed = docs.toDF(*names)
    join = NgramJaccard(renamed, of, text, percent)
    held = join.sets.filter("n > 0").groupBy("id", "digest").agg(F.count("*").alias("rows")).join(join.classes, "digest")
    held = join.scratch.table(held, "held")
    first = held.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest")).alias("best"))
    held = held.join(first, "component")
    gone = held.filter(~(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))))
    gone = gone.select(F.col("id").alias("gone id"), F.col("digest").alias("gone digest"))
    schema = with_fields(renamed.schema, "`set digest` binary")

    def digests(batches):
        for batch in pieces(batches, 1 << 19):
            found = [xxhash.xxh128_digest(u.tobytes()) if len(u) else None
                     for u in shingle_sets(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=schema.names)

    rows = renamed.mapInArrow(digests, schema)
    kept = rows.join(gone, rows[of].eqNullSafe(F.col("gone id")) & (F.col("set digest") == F.col("gone digest")), "left_anti")
    if not held.filter("rows > 1").isEmpty():
        # repeated rows: one of each that has words
        once = kept.filter(F.col("set digest").isNotNull()).dropDuplicates([of, "set digest"])
        kept = once.unionByName(kept.filter(F.col("set digest").isNull()))
    return kept.select(*names).toDF(*docs.columns)
