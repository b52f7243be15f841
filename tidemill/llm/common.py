"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.scratch import scratch_folder

CHUNK_CHARS = 4_000_000


def documents_of(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` alone, a null text read as an empty one. Any further column is left behind, so that none
    can clash with a name used inside an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def kept_table(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written to the shared folder and read back: work that several later steps need runs once, and its
    result survives the loss of an executor."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(name: str) -> str:
    """A column name that no input has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def fold(column: Column | str) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(column: Column | str, divisor: int) -> Column:
    """crc32 of a number's text, modulo `divisor`; null stays null."""
    return F.pmod(F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")),
                  F.lit(divisor))


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of about `limit` bytes of text, a document always whole."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), dtype=np.int64)
    if not len(sizes):
        return
    group = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for begin, end in zip(starts, np.r_[starts[1:], len(sizes)], strict=True):
        yield batch.slice(begin, end - begin)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values and the offset of each (one more than values); null reads as empty."""
    array = pa.compute.fill_null(array.cast(pa.large_string()), "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a public 64-bit mixing generator)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end (bytes) of every word `[^\\x20\\x09-\\x0D]+` of many texts, and the index of its text."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = np.zeros(size + 2, dtype=bool)
    solid[1:-1] = ~_SPACE[data]
    inner = offsets[(offsets > 0) & (offsets < size)]
    cut = np.zeros(size + 2, dtype=bool)
    cut[inner + 1] = solid[inner + 1] & solid[inner]
    edge = solid[1:] != solid[:-1]
    begin = np.flatnonzero((edge & solid[1:]) | cut[1:])
    end = np.flatnonzero((edge & ~solid[1:]) | cut[1:])
    return begin, end, np.searchsorted(offsets, begin, side="right") - 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of many texts, A-Z in lower case, and the index of its text."""
    begin, end, owner = word_spans(data, offsets)
    return hash_spans(data, begin, end), owner


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of stretches of bytes, A-Z in lower case: the sum of the stretch's eight-byte blocks, each mixed with
    its place, so that equal words have equal hashes wherever they stand."""
    padded = np.zeros(len(data) + 16, dtype=np.uint8)
    padded[:len(data)] = _FOLD[data]
    length = end - begin
    total = mix(length.astype(np.uint64) + _BASE)
    block, rows = 0, np.arange(len(begin))
    view = np.lib.stride_tricks.as_strided(padded.view(), shape=(len(data) + 8, 8), strides=(1, 1))
    while len(rows):
        at = begin[rows] + 8 * block
        left = np.minimum(length[rows] - 8 * block, 8)
        value = np.ascontiguousarray(view[at]).view(np.uint64).ravel()
        value &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - left.astype(np.uint64)) * np.uint64(8))
        total[rows] += mix(value + np.uint64((block + 1) * int(_BASE) % 2**64))
        block += 1
        rows = rows[length[rows] > 8 * block]
    return mix(total)
