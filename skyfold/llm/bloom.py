"""Bloom filters that Spark builds and tasks read.

A filter has a fixed number of 64-bit words, so what is collected and
broadcast is bounded by that size, never by the number of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.text import U64, mix64

HASHES = 6


def positions(h: np.ndarray, salt: int, n_bits: int, hashes: int = HASHES) -> list[np.ndarray]:
    a = mix64(h ^ U64((salt * 0x9E3779B97F4A7C15) % (1 << 64)))
    b = mix64(a + U64(0x632BE59BD9B4E019)) | U64(1)
    return [((a + U64(i) * b) % U64(n_bits)).astype(np.int64) for i in range(hashes)]


def contains(words: np.ndarray, h: np.ndarray, salt: int = 0, hashes: int = HASHES) -> np.ndarray:
    found = np.ones(len(h), dtype=bool)
    for p in positions(h, salt, len(words) * 64, hashes):
        found &= (words[p >> 6] >> (p & 63).astype(U64) & U64(1)).astype(bool)
    return found


def build(keys: DataFrame, column: str, n_words: int, salt: int = 0, hashes: int = HASHES) -> np.ndarray:
    """The filter's words over a long column of ``keys`` (nulls are left out)."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            p = np.concatenate(positions(h, salt, n_words * 64, hashes))
            at, inverse = np.unique(p >> 6, return_inverse=True)
            bits = np.zeros(len(at), dtype=U64)
            np.bitwise_or.at(bits, inverse, U64(1) << (p & 63).astype(U64))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], ["at", "bits"])

    rows = keys.select(column).where(F.col(column).isNotNull()).mapInArrow(words, "at long, bits long")
    got = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most n_words rows
    out = np.zeros(n_words, dtype=U64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(U64)
    return out
