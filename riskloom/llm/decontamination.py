"""Benchmark decontamination with suffix arrays over the training texts.

Every task turns its documents into shards: the words of a run of whole documents and their
suffix array.  The suffixes of the benchmark items are binary-searched in it: the place where a
suffix belongs gives its longest verbatim match and a location, and the stretch of the array
whose suffixes begin with a window (10 consecutive item words) gives all its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, cut_words, pieces, with_fields

WINDOW = 10
#: Bytes of text of a shard (a longer document is a shard of its own), and of benchmark text shipped to tasks at once.
SHARD_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: Digits, letters and every byte of other than ASCII characters are word bytes.
WORD_BYTES = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127 for c in range(256)])


def packed(ids: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """For every position the next words in one integer of 63 bits (0 behind the end), and their number."""
    length = max(1, 63 // bits)
    padded = np.concatenate([ids.astype(np.int64), np.zeros(length, np.int64)])
    key = np.zeros(len(ids) + 1, np.int64)
    for k in range(length):
        key = (key << bits) | padded[k:k + len(ids) + 1]
    return key, length


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` (positive ints) in the order of their suffixes' first ``depth`` words.

    Words are packed into one integer as far as they fit; groups of equal prefixes are then
    sorted again by the rank of what follows, doubling the compared length each time.
    """
    n = len(ids)
    key, length = packed(ids, max(1, int(ids.max(initial=0)).bit_length()))
    key = key[:n]
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = first, -1  # the slot at which a suffix's group begins
    while length < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.nonzero(tied)[0]
        if not len(slots):
            break
        at = order[slots]
        key = rank[at] * (n + 2) + rank[np.minimum(at + length, n)] + 1
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[slots] = at
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[slots] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        length *= 2
    return order


class Benchmark:
    """The items' words as one flat array (0 behind each item), all their suffixes, and which suffix begins a window."""

    def __init__(self, items: Iterable[tuple[str, bytes | None]], window: int):
        names, texts = [], []
        for item, text in items:
            names.append(item)
            texts.append(text or b"")
        words, item_of = cut_words(pa.array(texts, pa.large_binary()), WORD_BYTES)
        lengths = np.bincount(item_of, minlength=len(names))
        self.items = [n for n, k in zip(names, lengths.tolist()) if k]
        lengths = lengths[lengths > 0]
        words = words.dictionary_encode()
        self.vocabulary = words.dictionary.to_pylist()
        self.ids = flat_ids(words.indices.to_numpy(zero_copy_only=False), lengths)
        self.longest = int(lengths.max(initial=0))
        self.suffix_at = np.nonzero(self.ids)[0]
        self.suffix_item, whole = np.repeat(np.arange(len(lengths)), lengths), np.repeat(lengths, lengths)
        self.suffix_start = np.arange(len(whole)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.suffix_length = whole - self.suffix_start
        # a window begins at a suffix of at least `window` words, or at the start of a shorter item
        wanted = np.minimum(window, whole)
        self.window_length = np.where(self.suffix_length >= wanted, wanted, 0)


def flat_ids(numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Word numbers from 1 on, with a 0 behind the words of each text."""
    ids = np.zeros(len(numbers) + len(lengths), np.int64)
    ids[np.arange(len(numbers)) + np.repeat(np.arange(len(lengths)), lengths)] = numbers + 1
    return ids


class Shard:
    """Words of whole documents, with 0 between them, and their suffix array to a depth of so many words.

    The items' suffixes are searched in it, 63 bits' worth of words at a time: a step narrows the
    stretch of the array that agrees so far.  All arrays grow with the shard's and the items' words.
    """

    def __init__(self, words: pa.Array, lengths: np.ndarray, bench: Benchmark, depth: int):
        words = words.dictionary_encode()
        self.starts = np.cumsum(np.append(0, lengths + 1))
        self.ids = flat_ids(words.indices.to_numpy(zero_copy_only=False), lengths)
        self.n = len(self.ids)
        self.order = suffix_array(self.ids, depth)
        self.bits = max(1, int(self.ids.max(initial=0)).bit_length())
        self.keys, self.length = packed(self.ids, self.bits)
        self.first_keys = self.keys[self.order]
        number = {w: i + 1 for i, w in enumerate(words.dictionary.to_pylist())}
        known = np.fromiter((number.get(w, 0) for w in bench.vocabulary), np.int64, len(bench.vocabulary))
        asked = np.append(0, known)[bench.ids]  # the items in the shard's numbers, 0 for words that it hasn't
        self.item_keys = packed(asked, self.bits)[0]
        ends = np.append(np.nonzero(asked == 0)[0], len(asked))
        at = bench.suffix_at
        self.known = ends[np.searchsorted(ends, at)] - at  # words of each suffix before the first that the shard hasn't

    def _bisect(self, low: np.ndarray, high: np.ndarray, step: int, key: np.ndarray, right: bool) -> np.ndarray:
        """Within each stretch, whose suffixes agree before word ``step``, the place of a key for what follows."""
        if not step:
            return np.searchsorted(self.first_keys, key, "right" if right else "left")
        low, high = low.copy(), high.copy()
        open_ = np.nonzero(low < high)[0]
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            there = self.keys[np.minimum(self.order[middle] + step, self.n)]
            up = there <= key[open_] if right else there < key[open_]
            low[open_[up]], high[open_[~up]] = middle[up] + 1, middle[~up]
            open_ = open_[low[open_] < high[open_]]
        return low

    def _narrowed(self, low, high, step, at, words):
        """(low, high) of the suffixes that agree with ``words`` more words of the items at positions ``at``."""
        rest = self.bits * (self.length - np.minimum(words, self.length))
        key = (self.item_keys[np.minimum(at + step, len(self.item_keys) - 1)] >> rest) << rest
        return (self._bisect(low, high, step, key, right=False), self._bisect(low, high, step, key | ((np.int64(1) << rest) - 1), right=True)), key

    def longest_matches(self, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """For every suffix its longest verbatim match in words, and a location of it (document words)."""
        longest, where = np.zeros(len(bench.suffix_at), np.int64), np.zeros(len(bench.suffix_at), np.int64)
        open_, step = np.nonzero(self.known > 0)[0] if self.n else np.zeros(0, np.int64), 0
        low, high = np.zeros(len(open_), np.int64), np.full(len(open_), self.n)
        while len(open_):
            at, words = bench.suffix_at[open_], self.known[open_] - step
            (new_low, new_high), key = self._narrowed(low, high, step, at, words)
            found = new_low < new_high
            longest[open_[found]] = step + np.minimum(words, self.length)[found]
            where[open_[found]] = self.order[new_low[found]]
            # no suffix has all of these words: the neighbours of their place have most of them
            lost = np.nonzero(~found)[0]
            for slot in (new_low[lost] - 1, new_low[lost]):
                inside = (slot >= low[lost]) & (slot < high[lost])
                who, slot = lost[inside], slot[inside]
                differ = self.keys[np.minimum(self.order[slot] + step, self.n)] ^ key[who]
                common, same = np.zeros(len(who), np.int64), np.ones(len(who), bool)
                for k in range(self.length):
                    same &= (differ >> (self.bits * (self.length - 1 - k))) == 0
                    common += same
                common = step + np.minimum(common, words[who])
                better = common > longest[open_[who]]
                longest[open_[who[better]]], where[open_[who[better]]] = common[better], self.order[slot[better]]
            more = found & (words > self.length)
            open_, low, high, step = open_[more], new_low[more], new_high[more], step + self.length
        return longest, where

    def occurrences(self, bench: Benchmark):
        """(positions, length, suffixes) of every window that occurs."""
        found = np.nonzero((bench.window_length > 0) & (self.known >= bench.window_length))[0]
        low, high, step = np.zeros(len(found), np.int64), np.full(len(found), self.n), 0
        while True:
            words = bench.window_length[found] - step
            more = np.nonzero((words > 0) & (low < high))[0]
            if not len(more):
                break
            (low[more], high[more]), _ = self._narrowed(low[more], high[more], step, bench.suffix_at[found[more]], words[more])
            step += self.length
        some = low < high
        found, low, high = found[some], low[some], high[some]
        if len(found):
            # windows with the same words have the same stretch
            length = bench.window_length[found]
            by = np.lexsort((length, high, low))
            found, low, high, length = found[by], low[by], high[by], length[by]
            new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (length[1:] != length[:-1])])
            heads = np.append(np.nonzero(new)[0], len(found))
            for s, e in zip(heads, heads[1:]):
                yield np.sort(self.order[low[s]:high[s]]), int(length[s]), found[s:e]


def _hits(shard: Shard, bench: Benchmark, n_docs: int):
    """By document with a hit: (item numbers, start and end of the merged hit stretches)."""
    covered = np.zeros(shard.n + 1, np.int64)
    items = [set() for _ in range(n_docs)]
    for at, length, suffixes in shard.occurrences(bench):
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length, -1)
        owners = np.unique(bench.suffix_item[suffixes]).tolist()
        for d in np.unique(np.searchsorted(shard.starts, at, "right") - 1):
            items[d].update(owners)
    hit = np.cumsum(covered) > 0
    for d in range(n_docs):
        if items[d]:
            own = hit[shard.starts[d]:shard.starts[d + 1]].astype(np.int8)
            edges = np.diff(np.concatenate([[0], own, [0]]))
            yield d, items[d], np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


def _blocks(items: DataFrame, block_bytes: int):
    """The items in blocks of bounded bytes; one item is never cut."""
    block, size = [], 0
    for r in items.toLocalIterator():
        text = r["text"].encode() if r["text"] is not None else b""
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item"] if r["item"] is not None else "null", text))
        size += len(text)
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans.

    ``items`` are the ids (as strings, sorted; null ids count as 'null') of the items with a
    window in the document and ``spans`` the merged stretches of hit words (start, end exclusive).
    A null or wordless text has no words; an item of fewer than ``window`` words is one window
    and an item without words none.  Repeated documents and items each count.  An empty
    benchmark contaminates nothing; empty documents give no rows.  The benchmark is a query
    set: it is held against all documents in blocks of at most ``block_bytes``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _search(rows, ["id"], benchmark.select(F.col(item_id_col).cast("string").alias("item"),
                                                   F.col(item_text_col).alias("text")), window, block_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        "items", "spans")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of the benchmark occurs."""
    names = docs.columns
    rows = docs.select(*[F.col(c).alias("text" if c == text_col else f"column {i}") for i, c in enumerate(names)])
    found = _search(rows, rows.columns, benchmark.select(F.col(item_id_col).cast("string").alias("item"),
                                                         F.col(item_text_col).alias("text")), window, block_bytes)
    return found.filter(F.size("items") == 0).select(*[F.col(c).alias(n) for c, n in zip(rows.columns, names)])


def _search(rows: DataFrame, kept: list[str], items: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """The ``kept`` columns of ``rows`` with n_words, items and spans."""
    spark = rows.sparkSession
    blocks = _blocks(items, block_bytes)  # one at a time; whether there is a second one decides the plan
    first, second = next(blocks, []), next(blocks, None)
    if second is not None:  # a row number, fixed by the write, under which the blocks' findings meet
        rows = Scratch(spark, "decontamination").table(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    carried = [c for c in rows.columns if c in kept or c == "row"]
    schema = with_fields(rows.select(*carried).schema,
                         "n_words long, items array<string>, spans array<struct<start:long,end:long>>")

    def searcher(block):
        given = spark.sparkContext.broadcast(Benchmark(block, window))

        def search(batches):
            bench = given.value
            depth = int(bench.window_length.max(initial=1))
            for own, words, lengths in _shards(batches, carried):
                shard = Shard(words, lengths, bench, depth)
                found, spans = [[] for _ in lengths], [[] for _ in lengths]
                for d, numbers, start, end in _hits(shard, bench, len(lengths)):
                    found[d] = sorted(bench.items[i] for i in numbers)
                    spans[d] = [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())]
                more = [pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                yield pa.RecordBatch.from_arrays([*own.columns, *more], names=schema.names)

        return rows.mapInArrow(search, schema)

    found = searcher(first)
    if second is None:
        return found
    # only rows with findings meet; texts stay where they are
    numbers = ["row", "items", "spans"]
    parts = found.select(*numbers)
    for block in chain([second], blocks):
        parts = parts.unionByName(searcher(block).select(*numbers))
    parts = parts.filter(F.size("items") > 0).groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list("items"))).alias("items"),
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"))
    none = {"items": F.array().cast("array<string>"), "spans": F.array().cast("array<struct<start:long,end:long>>")}
    return found.drop("items", "spans").join(parts, "row", "left").select(
        *kept, "n_words", *[F.coalesce(F.col(c), v).alias(c) for c, v in none.items()])


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every suffix of every item (item, start): words of its longest verbatim match and one location (doc, position).

    Suffixes whose first word occurs nowhere have length 0 and no location.  Of equally long
    matches the one with the smallest document id, then position, is reported per suffix.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    schema = "item string, start long, length long, position long"
    kind = rows.schema["id"].dataType.simpleString()
    parts = []
    blocks = _blocks(items, block_bytes)
    for block in chain([next(blocks, [])], blocks):
        given = spark.sparkContext.broadcast(Benchmark(block, 1))

        def match(batches, given=given):
            bench = given.value
            names = pa.array([bench.items[i] for i in bench.suffix_item], pa.string())
            for own, words, lengths in _shards(batches, ["id"]):
                shard = Shard(words, lengths, bench, bench.longest)
                length, where = shard.longest_matches(bench)
                at = np.searchsorted(shard.starts, where, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(bench.suffix_start), pa.array(length), pa.array(where - shard.starts[at]),
                     own.column("id").take(pa.array(at))], names=["item", "start", "length", "position", "id"])

        parts.append(rows.mapInArrow(match, f"{schema}, id {kind}"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("length")).alias("less"), "id", "position")).alias("best")
    some = F.col("best.less") < 0
    return found.groupBy("item", "start").agg(best).select(
        "item", "start", (-F.col("best.less")).alias("length"), F.when(some, F.col("best.id")).alias(id_col),
        F.when(some, F.col("best.position")).alias("position"))


def _merged(spans):
    """Stretches sorted and united where they overlap or touch."""
    kind = "array<struct<start:long,end:long>>"

    def step(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), joined).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), step)


def _shards(batches, carried: Sequence[str]):
    """(carried columns, words in turn, words of each document) of runs of whole documents, about SHARD_BYTES each."""
    for batch in pieces(batches, SHARD_BYTES):
        texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
        words, doc = cut_words(texts, WORD_BYTES)
        yield batch.select(list(carried)), words, np.bincount(doc, minlength=batch.num_rows)
