"""Phrase collocation mining with mergeable Misra-Gries summaries.

N-grams are hashed (with their language) and dealt by hash range to partitions.  Every task
hands over one run of (hash, count) per partition; a partition's runs are merged into one
Misra-Gries summary whose capacity exceeds the partition's mass divided by the threshold,
so that every n-gram with the threshold's frequency survives.  Survivors become a bit map of
bounded size, and a last pass counts the n-grams it lets through, exactly and by their text.
Words come first, then pairs of surviving words, then longer phrases of surviving pairs: a
phrase is never more frequent than its parts, so nothing frequent is lost on the way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import Scratch, pieces, text_bytes

#: Occurrences that make a phrase a candidate; words of a candidate; rows returned for a language.
THRESHOLD, LONGEST, TOP = 100, 5, 2000
#: A summary's capacity is ROOM times the least that serves: what survives by error alone is then 1 / ROOM rarer than wanted.
ROOM = 8
#: Text of one step of a task, (hash, count) entries and counted phrases a task holds before it hands them over.
STEP_BYTES, HELD, HELD_PHRASES = 4 << 20, 1 << 20, 1 << 19
#: Bits of a bit map: at most 2^26 (8 MB); above some millions of survivors it only lets more through.
LEAST_BITS, MOST_BITS = 16, 26
UNDETERMINED = "und"

_bytes = np.arange(256, dtype=np.uint8)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
WORD, SPACE, END = 0, 1, 2
KIND = np.full(256, WORD, np.uint8)
KIND[[0x20, 0x09]] = SPACE
KIND[list(b".,;:!?\n\x0b\x0c\r")] = END


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: piece, language and number of each; equal words of a language have one hash."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        texts = texts.cast(pa.large_binary())
        ends_at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[ends_at[0]:ends_at[-1]] if data is not None else np.zeros(0, np.uint8)
        ends_at = ends_at - ends_at[0]
        kind = KIND[raw]
        in_word, first = kind == WORD, np.zeros(len(raw) + 1, bool)
        first[ends_at[:-1]] = True  # a text's first byte begins a piece
        before, behind = np.append(False, in_word[:-1]), np.append(in_word[1:], False)
        starts = np.flatnonzero(in_word & (~before | first[:-1]))
        ends = np.flatnonzero(in_word & (~behind | first[1:])) + 1
        self.piece = np.searchsorted(np.flatnonzero((kind == END) | first[:-1]), starts, "right")
        doc = np.searchsorted(ends_at[1:], starts, "right")
        offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                      [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[in_word]])]).dictionary_encode()
        self.number = words.indices.to_numpy(zero_copy_only=False)
        self.spelled = words.dictionary.to_pylist()
        self.langs = sorted(set(langs))
        of = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.fromiter((of[x] for x in langs), np.int32, len(langs))[doc]
        digests = np.fromiter(map(xxhash.xxh3_64_intdigest, self.spelled), np.uint64, len(self.spelled))
        seeds = np.fromiter((xxhash.xxh3_64_intdigest(x.encode(), 1) for x in self.langs), np.uint64, len(self.langs))
        self.hashes = _mix(digests[self.number] ^ seeds[self.lang])

    def grams(self, least: int, most: int, maps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, first words, hashes) of the k-grams that can be frequent, for k from least to most.

        ``maps``: bit maps of the survivors among words, pairs and longer phrases, as far as they are known.
        """
        ok, h = np.ones(len(self.hashes), bool), self.hashes
        if maps:
            ok = holds(maps[0], h)
        at = np.flatnonzero(ok)
        if least == 1:
            yield 1, at, h[at]
        h = h[at]
        for k in range(2, most + 1):
            last = at + k - 1
            inside = last < len(ok)
            at, last, h = at[inside], last[inside], h[inside]
            fits = ok[last] if k == 2 else ok[last - 1]  # the word, or the pair that ends here
            fits &= self.piece[at] == self.piece[last]
            at, last, h = at[fits], last[fits], h[fits]
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + self.hashes[last])
            if len(maps) > min(k, 3) - 1:
                fits = holds(maps[min(k, 3) - 1], h)
                at, h = at[fits], h[fits]
            if k == 2:
                ok = np.zeros(len(ok), bool)
                ok[at] = True
            if k >= least:
                yield k, at, h


def holds(bit_map: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash is in a bit map (uint64 words, a power of 2 of them)."""
    slot = h >> np.uint64(64 - (len(bit_map) * 64).bit_length() + 1)
    return (bit_map[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sums of their counts."""
    order = np.argsort(h)
    h, n = h[order], n[order]
    heads = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[heads], np.add.reduceat(n, heads) if len(h) else n


class MisraGries:
    """A summary of counts: what occurs more often than mass / capacity is never lost.

    ``error`` is what has been taken off every counter; a true count is at most its counter
    (0 if it has none) plus ``error``.  Adding runs or other summaries in any order keeps
    error < mass / capacity.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.h, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, runs: list[tuple[np.ndarray, np.ndarray]], error: int = 0) -> None:
        """Add the counters of runs, or of summaries whose errors sum to ``error``."""
        self.error += error
        self.h, self.n = summed(np.concatenate([self.h, *(h for h, _ in runs)]), np.concatenate([self.n, *(n for _, n in runs)]))
        over = len(self.n) - self.capacity
        if over > 0:
            least = int(np.partition(self.n, over - 1)[over - 1])  # the largest counter that has no place
            self.error += least
            kept = self.n > least
            self.h, self.n = self.h[kept], self.n[kept] - least

    def at_least(self, threshold: int) -> np.ndarray:
        """Hashes that may occur ``threshold`` times; all that do, if threshold > error."""
        return self.h[self.n + self.error >= threshold]


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in pieces(batches, STEP_BYTES):
        yield Words(batch.column("text"), batch.column("lang").to_pylist())


def _survivors(texts: DataFrame, least: int, most: int, maps: list[np.ndarray], threshold: int, scratch: Scratch) -> np.ndarray:
    """Bit map of the hashes of all k-grams, least <= k <= most, that occur ``threshold`` times in a language."""
    spark = texts.sparkSession
    part_bits = min(LEAST_BITS - 6, max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()))
    given = spark.sparkContext.broadcast(maps)

    def runs(batches):
        held, entries = [], 0

        def combined():
            return summed(np.concatenate([x for x, _ in held]), np.concatenate([n for _, n in held]))

        def handed_over():
            h, n = combined()
            cuts = np.searchsorted(h, np.arange(1, 1 << part_bits, dtype=np.uint64) << np.uint64(64 - part_bits))
            starts, ends = np.append(0, cuts), np.append(cuts, len(h))
            own = np.flatnonzero(ends > starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array([int(n[s:e].sum()) for s, e in zip(starts[own], ends[own])], pa.int64()),
                 pa.array([h[s:e].tobytes() for s, e in zip(starts[own], ends[own])], pa.binary()),
                 pa.array([n[s:e].tobytes() for s, e in zip(starts[own], ends[own])], pa.binary())],
                names=["part", "mass", "hashes", "counts"])

        for words in _words(batches):
            for _, _, h in words.grams(least, most, given.value):
                run = summed(h, np.ones(len(h), np.int64))
                held.append(run)
                entries += len(run[0])
            if entries > HELD:
                held = [combined()]
                entries = len(held[0][0])
                if entries > HELD // 2:
                    yield from handed_over()
                    held, entries = [], 0
        if entries:
            yield from handed_over()

    name = f"grams-{least}-{most}"
    written = scratch.table(texts.mapInArrow(runs, "part int, mass long, hashes binary, counts binary"), name)
    # one row per partition: at most 2^part_bits of them
    capacity = {r["part"]: ROOM * r["mass"] // threshold + 1 for r in written.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}

    def merged(batches):
        part, summary, waiting, entries = None, None, [], 0
        for batch in batches:
            for row_part, h, n in zip(batch.column("part").to_pylist(), text_bytes(batch.column("hashes")), text_bytes(batch.column("counts"))):
                if row_part != part:
                    if summary is not None:
                        summary.merge(waiting)
                        yield done(part, summary)
                    part, summary, waiting, entries = row_part, MisraGries(capacity[row_part]), [], 0
                waiting.append((np.frombuffer(h, np.uint64), np.frombuffer(n, np.int64)))
                entries += len(waiting[-1][0])
                if entries > max(summary.capacity, 1 << 16):
                    summary.merge(waiting)
                    waiting, entries = [], 0
        if summary is not None:
            summary.merge(waiting)
            yield done(part, summary)

    def done(part, summary):
        h = summary.at_least(threshold)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(h)], pa.int64()), pa.array([h.tobytes()], pa.binary())],
                                          names=["part", "n", "hashes"])

    dealt = written.repartition(F.col("part")).sortWithinPartitions("part").drop("mass")
    survivors = scratch.table(dealt.mapInArrow(merged, "part int, n long, hashes binary"), f"survivors-{least}-{most}")
    scratch.remove(name)
    total = survivors.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * total).bit_length()))

    def mapped(batches):
        for batch in batches:
            rows = []
            for h in text_bytes(batch.column("hashes")):
                slots = (np.frombuffer(h, np.uint64) >> np.uint64(64 - bits)) & np.uint64((1 << bits - part_bits) - 1)
                own = np.zeros(1 << bits - part_bits, bool)
                own[slots.astype(np.int64)] = True
                rows.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(rows, pa.binary())], names=["part", "bits"])

    # a partition is a range of hashes, so it has a stretch of the bit map (8 MB in all) to itself
    bit_map, stretch = np.zeros(1 << bits - 3, np.uint8), 1 << bits - part_bits - 3
    for row in survivors.filter("n > 0").select("part", "hashes").mapInArrow(mapped, "part int, bits binary").collect():
        bit_map[row["part"] * stretch:(row["part"] + 1) * stretch] = np.frombuffer(row["bits"], np.uint8)
    return bit_map.view(np.uint64)


def _grouped(words: Words, k: int, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of one occurrence of each different k-gram, and its number of occurrences."""
    if not len(at):
        return at, at
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    n = np.diff(np.append(heads, len(at)))
    first = np.repeat(at[heads], n)
    same = words.lang[at] == words.lang[first]
    for j in range(k):
        same &= words.number[at + j] == words.number[first + j]
    if same.all():
        return at[heads], n
    keys = np.column_stack([words.lang[at], *(words.number[at + j] for j in range(k))])  # two phrases of one hash
    _, heads, n = np.unique(keys, axis=0, return_index=True, return_counts=True)
    return at[heads], n


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                     threshold: int = THRESHOLD) -> DataFrame:
    """(lang, k, phrase, f): every phrase of 1 to ``longest`` words with f >= ``threshold`` in its language; and a row
    with k = 0, phrase '' and the number of all words of each language that has any.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    texts, maps = _texts(docs, text_col, lang_col), []
    for least, most in ((1, 1), (2, 2), (3, longest)):
        if least <= longest:
            maps.append(_survivors(texts, least, most, maps, threshold, scratch))
    given = spark.sparkContext.broadcast(maps)

    def counted(batches):
        held: Counter = Counter()
        for words in _words(batches):
            for lang, n in zip(words.langs, np.bincount(words.lang, minlength=len(words.langs)).tolist()):
                held[lang, 0, b""] += n
            for k, at, h in words.grams(1, longest, given.value):
                first, n = _grouped(words, k, at, h)
                numbers = [words.number[first + j].tolist() for j in range(k)]
                langs = [words.langs[i] for i in words.lang[first].tolist()]
                for lang, own, c in zip(langs, zip(*numbers), n.tolist()):
                    held[lang, k, b" ".join([words.spelled[i] for i in own])] += c
            if len(held) > HELD_PHRASES:
                yield rows(held)
                held.clear()
        if held:
            yield rows(held)

    def rows(held):
        langs, ks, phrases = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(ks, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()),
             pa.array(list(held.values()), pa.int64())], names=["lang", "k", "phrase", "f"])

    counts = texts.mapInArrow(counted, "lang string, k int, phrase string, f long").groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
    return scratch.table(counts.filter((F.col("f") >= threshold) | ((F.col("k") == 0) & (F.col("f") > 0))), "counts")


def _exact(c: Column, digits: int) -> Column:
    return c.cast(f"decimal({digits},0)")


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                      threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` collocations of each language.

    Texts are lower-cased in A-Z and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at blanks and
    tabs into words.  A candidate has 2 to ``longest`` words and a >= ``threshold`` occurrences within
    pieces; its score is that of its worst cut, floor(1000 * a * n / (l * r)), of equal cuts the
    first.  Candidates inside a longer one that is as frequent are dropped.  Null texts are empty,
    a null language is 'und', repeated rows count each time; texts without words and empty tables
    give no rows; other columns are ignored, whatever their names.  Ranks go by score and a,
    falling, then by the phrase's bytes.
    """
    counts = frequent_phrases(docs, text_col, lang_col, longest, threshold)
    n = counts.filter("k = 0").select("lang", F.col("f").alias("n"))
    parts = counts.filter("k > 0").select("lang", "phrase", "f")
    found = counts.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    # a longer phrase as frequent implies one of a single word more that is: only those need a look
    words = F.split("phrase", " ")
    longer = found.filter("k > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " "))).alias("phrase"))
    found = found.join(longer.distinct(), ["lang", "phrase", "a"], "left_anti")

    cuts = found.withColumn("words", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ")).withColumn(
        "right", F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ")).drop("words")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(n, "lang")
    above = _exact(F.lit(1000) * _exact(F.col("a"), 18), 21) * _exact(F.col("n"), 17)
    below = _exact(F.col("l"), 19) * _exact(F.col("r"), 19)
    cuts = cuts.withColumn("score", F.call_function("div", above, below).cast("bigint"))
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    worst = worst.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
