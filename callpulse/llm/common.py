"""Helpers the operators share: stored steps, folds, and words of Arrow text as arrays.

Words are hashed with numpy over the bytes of many texts at once. A word's hash
is a prefix sum of per-byte values times powers of an odd number, so every word
of a block comes out of a handful of array operations, whatever its length.
"""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.session import shared_folder

#: Bytes of text that are worked on at once, unless one text is longer.
BLOCK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that they
    need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(os.path.realpath(tempfile.mkdtemp())) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    It cuts the lineage: a lost executor repeats its part of the later steps only.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key's text, modulo ``parts``; null keys are in fold 0."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % parts


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row.

    Gives the slice, the bytes of its texts and where each text starts; the last
    entry is the end. A null text has no bytes.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
        buffers = texts.buffers()
        starts = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.empty(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            yield (
                batch.slice(first, last - first),
                raw[starts[first] : starts[last]],
                starts[first : last + 1] - starts[first],
            )
            first = last
        del batch, texts, buffers, starts, raw
        give_back()


def give_back() -> None:
    """Returns freed memory to the system. Python workers outlive their tasks, and what
    they keep counts against their executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def fold_case(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return data + ((data - np.uint8(65) < 26).astype(np.uint8) << np.uint8(5))


class Powers:
    """Powers of the base and of its inverse, grown as longer blocks come."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < size:
            room = max(size, BLOCK_BYTES + 1)
            with np.errstate(over="ignore"):
                steps = np.full(room, _BASE, np.uint64)
                steps[0] = 1
                cls.up = np.cumprod(steps)
                steps[1:] = _BASE_INVERSE
                cls.down = np.cumprod(steps)
        return cls.up[:size], cls.down[:size]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """The words of a block: where they start and end, their text, their hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, folded=True):
        self.data = fold_case(data) if folded else data
        inside = is_word[self.data]
        if not len(inside):
            inside = np.zeros(1, bool)
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        borders = offsets[:-1][offsets[:-1] < len(data)]
        begins[borders] = inside[borders]
        ends[borders[borders > 0] - 1] = inside[borders[borders > 0] - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: index of the first word of each text, and the number of words at last
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        up, self._down = Powers.get(len(self.data) + 1)
        self._sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.data] * up[:-1], out=self._sums[1:])
        self.hash = self.hash_of(self.start, self.end)

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from each start to before its end."""
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` words in a row, and whether one text holds them all."""
        count = len(self.hash) - size + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        return gram_hashes(self.hash, size), self.text[:count] == self.text[size - 1 :]

    def spelled(self, first: int, last: int) -> bytes:
        """The words from ``first`` to before ``last``, with one blank between."""
        return b" ".join(
            self.data[s:e].tobytes()
            for s, e in zip(self.start[first:last], self.end[first:last], strict=True)
        )


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    count = len(words) - size + 1
    total = np.zeros(max(count, 0), np.uint64)
    factor = int(_BASE)
    for place in range(size):
        total += words[place : place + count] * np.uint64(factor)
        factor = factor * int(_BASE) % (1 << 64) | 1
    return mix(total)


def bytes_where(accept) -> np.ndarray:
    return np.array([accept(b) for b in range(256)])


def bloom_filter(ids: DataFrame, column: str, bits: int = 1 << 26) -> np.ndarray:
    """A Bloom filter of the ids: ``bits`` bits whatever their number.

    Spark sets the bits; at most bits / 64 numbers of 64 bits reach the driver
    (8 MB as given). More ids only make it let more rows pass.
    """
    place = F.explode(
        F.array(*(F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(bits)) for seed in (1, 2)))
    )
    found = (
        ids.select(place.alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits"))
        .toPandas()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return words


def may_contain(words, column: str) -> Column:
    """True for every id in the filter, and for few others."""
    bits = len(words.value) * 64

    @F.pandas_udf("boolean")
    def hit(one, two):
        seen = True
        for place in (one.to_numpy(np.int64), two.to_numpy(np.int64)):
            seen &= (words.value[place >> 6] >> (place & 63)) & 1 == 1
        return pd.Series(seen)

    return hit(*(F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(bits)) for seed in (1, 2)))
