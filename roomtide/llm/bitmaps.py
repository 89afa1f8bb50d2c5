"""Bit maps of a fixed size over 64-bit keys: a filter without false negatives for tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24


def slots(keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bit of every key, as ``bitmap`` sets it."""
    return (keys.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)


def bitmap(df: DataFrame, key: str, bits: int = BITS) -> bytes:
    """Packed bits (little-endian) of the keys' low bits; ``bits`` is a power of two.

    The result has bits / 8 bytes whatever the table's size, and comes in 4 KB rows.
    """
    position = F.col(key).bitwiseAND(F.lit(bits - 1))
    made = df.select((position + 1).alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("m"))
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for b, m in made.collect():
        out[(b - 1) * 4096:b * 4096] = np.frombuffer(bytes(m), np.uint8)
    return out.tobytes()


def unpacked(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").view(bool)
