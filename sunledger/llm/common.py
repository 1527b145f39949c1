"""Text helpers shared by the operators: Arrow buffers, words, hashes and n-grams.

Words are found on the UTF-8 bytes of a whole Arrow batch at once. That is exact
because every separator is ASCII and no byte of a longer character is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch. A task and its Python worker hold a batch several times over, so
#: that the 64 MB which Spark allows by itself are hundreds of MB of an executor.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_bytes(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for first, last in separators:
        table[first : last + 1] = False
    return table


#: Words between ASCII white space.
SPACED = _word_bytes([(0x20, 0x20), (0x09, 0x0D)])
#: Words of letters, digits and anything outside ASCII (upper case is lowered first).
LETTERS = _word_bytes([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: The same words as a Java pattern on lower-cased text.
LETTERS_PATTERN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    content = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return content, at.astype(np.int64)


def is_text(column: pa.Array) -> bool:
    return pa.types.is_string(column.type) or pa.types.is_large_string(column.type)


def release_memory() -> None:
    """Give freed Arrow buffers and arrays back to the system; Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed arrays
    if trim is not None:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside it passes at most about ``BATCH_BYTES`` to Python at once, or one row.

    A limit that the session has already is left as it is.
    """
    if spark.conf.get(_BATCH_KEY, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_KEY)


def tidy(run):
    """``run``, a function of batches, giving freed memory back when its task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return tidied


def slices(offsets: np.ndarray, limit: int = 0) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    low, count = 0, len(offsets) - 1
    while low < count:
        fit = int(np.searchsorted(offsets, offsets[low] + (limit or SLICE_BYTES), "right")) - 1
        high = min(count, max(low + 1, fit))
        yield low, high
        low = high


def text_slices(column: pa.Array, lower: bool = True):
    """(first row, bytes, offsets from 0) of each slice of a string column."""
    data, offsets = utf8(column)
    for low, high in slices(offsets):
        part = data[offsets[low] : offsets[high]]
        yield low, (_LOWER[part] if lower else part), offsets[low : high + 1] - offsets[low]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(number: int) -> np.uint64:
    return mix(np.array([number * 0x9E3779B97F4A7C15 & (2**64 - 1)], dtype=np.uint64))[0]


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, count: int) -> np.ndarray:
    """Powers of the hash base, or of its inverse modulo 2**64."""
    have = _powers[kind]
    if len(have) < count:
        base = _BASE if kind == "up" else pow(_BASE, -1, 2**64)
        size = max(count, SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[kind] = have if size <= 4 * SLICE_BYTES else _powers[kind]
    return have[:count]


@dataclass
class Words:
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # of each row, the index of its first word; one more at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of each row, none of them across rows."""
    inside = is_word[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    before[rows] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, in bounded memory."""
    out = np.empty(len(words.starts), dtype=np.uint64)
    low = 0
    while low < len(out):
        begin = words.starts[low]
        high = max(low + 1, int(np.searchsorted(words.ends, begin + SLICE_BYTES, "right")))
        part = data[begin : words.ends[high - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[part] * _power("up", len(part)), out=sums[1:])
        starts, ends = words.starts[low:high] - begin, words.ends[low:high] - begin
        shifted = (sums[ends] - sums[starts]) * _power("down", len(part))[starts]
        out[low:high] = mix(shifted + (ends - starts).astype(np.uint64))
        low = high
    return out


_STEP = np.uint64(0xA0761D6478BD642F)


def gram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on, also across rows."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:count].copy()
    for j in range(1, width):
        total *= _STEP
        total += hashes[j : j + count]
    return mix(total + salt(width))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def labelled_ids(labels: DataFrame, size: int):
    """At most ``size`` rows (doc_id, quality 0 or 1) to learn from, as a pandas frame.

    The first by a hash of doc_id, so the choice is the same on every run. Null labels and
    held-out documents are left out; of several labels the mean is rounded.
    """
    return (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((2 * F.avg("quality") >= 1).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
        .toPandas()
    )


def of_ids(docs: DataFrame, chosen) -> DataFrame:
    """(doc_id, text) of a bounded sample from ``labelled_ids``, a row per doc_id.

    Of several texts of a doc_id the one with the least digest, however the rows are dealt.
    """
    ids = docs.sparkSession.createDataFrame(chosen[["doc_id"]], "doc_id long")
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    least = F.min(F.struct(F.md5(F.coalesce("text", F.lit(""))), F.col("text").alias("text"))).alias("least")
    return found.groupBy("doc_id").agg(least).select("doc_id", "least.text")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now.

    It acts when the driver collects garbage, which a driver that only plans may
    not do for half an hour.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
