"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_path

#: ASCII white space: the characters [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


class Scratch:
    """Intermediate tables of one operator call, written below ``spark.checkpoint.dir``.

    A written table cuts the lineage: executors lost later cost a re-read of Parquet,
    not a recomputation, and row ids drawn before the write stay fixed after it.
    ``drop`` deletes the folder once nothing reads it any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        self._delete(self.root)

    def remove(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.root}/{name}")

    def settle(self) -> None:
        """Have Spark's cleaner drop shuffle files of finished jobs: it does when the driver collects their plans."""
        gc.collect()
        self.spark._jvm.System.gc()

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def strip_spaces(text: Column) -> Column:
    """The text without any character of ``SPACES``."""
    for ch in SPACES:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (null ids are never held out)."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """The schema with the fields of a DDL string behind its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def pieces(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` at most (a longer row comes alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


#: Bits of the map that tells which rows may be wanted: 1 MB, whatever the tables.
MAP_BITS = 23


def with_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among ``ids`` (one column): a join needs to exchange no others."""
    place = lambda c: F.xxhash64(c).bitwiseAND((1 << MAP_BITS) - 1)
    words = ids.select(place(ids[0]).alias("place")).select(F.shiftright("place", 6).cast("int").alias("word"), F.expr(
        "shiftleft(1L, cast(place & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in words.toLocalIterator():
        bits[row["word"]] = row["bits"]
    shared = df.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def among(batches):
        bits = shared.value
        for batch in batches:
            h = batch.column("place of id").to_numpy()
            yield batch.drop_columns(["place of id"]).filter(pa.array((bits[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1))

    return df.withColumn("place of id", place(F.col(column))).mapInArrow(among, df.schema)


_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def cut_words(texts: pa.Array, word_bytes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts (large_binary, no nulls) in turn, A-Z lower-cased, and the number of each word's text.

    A word is a run of bytes that ``word_bytes`` (256 flags) allows; it ends with its text.
    """
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    inside, edge = np.take(word_bytes, raw), at[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edge[edge < len(raw)]] = inside[edge[edge < len(raw)]]
    last[edge[edge > 0] - 1] = inside[edge[edge > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]])])
    return words, np.searchsorted(at[1:], starts, "right")


#: Words of up to so many bytes are hashed by a table of random numbers for every byte at every place; longer ones one by one.
TABLED = 64
_TABLE = np.frombuffer(b"".join(xxhash.xxh64_digest(bytes([k, b])) for k in range(TABLED) for b in range(256)), "<u8")
#: Bytes that are not ASCII white space.
NO_SPACE = np.array([chr(b) not in SPACES for b in range(256)])


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hash of each word that ``cut_words`` cut: the sum of a random number for each byte at its place in the word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    at = np.frombuffer(words.buffers()[1], np.int64)[:len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)
    size = np.diff(at)
    place = np.arange(len(raw), dtype=np.int32 if len(raw) < 1 << 31 else np.int64)  # half the memory to move, nearly always
    place -= np.repeat(at[:-1].astype(place.dtype), size)
    place %= TABLED
    place <<= 8
    place |= raw
    found = np.add.reduceat(np.take(_TABLE, place), at[:-1])
    for k in np.flatnonzero(size > TABLED):
        found[k] = xxhash.xxh64_intdigest(raw[at[k]:at[k + 1]].tobytes())
    return found
