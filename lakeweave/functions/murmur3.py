"""32-bit murmur3 with seed 0, by which bucket partitions are numbered."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import clock

#: Hashing this int first leaves Spark's seed-42 hash in state 0 (fixed value).
_TO_SEED_0 = -1693959553
_U = np.uint32


def _scrambled(k: np.ndarray) -> np.ndarray:
    k = k * _U(0xCC9E2D51)
    return (k << _U(15) | k >> _U(17)) * _U(0x1B873593)


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """murmur3_x86_32 (seed 0, signed) of the spans of a byte array: four bytes of all spans at a time."""
    lanes = np.ndarray(len(data) + 1, "<u4", np.concatenate([data, np.zeros(4, np.uint8)]), strides=(1,))
    h, whole, rest = np.zeros(len(start), _U), length // 4, length % 4
    order = np.argsort(-whole, kind="stable")
    long = np.searchsorted(-whole[order], -np.arange(int(whole.max(initial=0))), "left")  # how many have more than j
    with np.errstate(over="ignore"):
        for j, n in enumerate(long.tolist()):
            own = order[:n]
            x = h[own] ^ _scrambled(lanes[start[own] + 4 * j])
            h[own] = (x << _U(13) | x >> _U(19)) * _U(5) + _U(0xE6546B64)
        tail = np.flatnonzero(rest)
        h[tail] ^= _scrambled(lanes[start[tail] + 4 * whole[tail]] & ((_U(1) << (8 * rest[tail]).astype(_U)) - _U(1)))
        h ^= length.astype(_U)
        h = (h ^ h >> _U(16)) * _U(0x85EBCA6B)
        h = (h ^ h >> _U(13)) * _U(0xC2B2AE35)
        return (h ^ h >> _U(16)).view(np.int32)


def hash_bytes(data: bytes) -> int:
    return int(hash_spans(np.frombuffer(data, np.uint8), np.zeros(1, np.int64), np.array([len(data)]))[0])


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = values.cast(pa.large_binary())
    ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    data = values.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends[:-1], np.diff(ends)


def _unscaled(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two's complement of decimals' unscaled values, big end first, in the fewest bytes."""
    n = len(values)
    big = np.frombuffer(values.buffers()[1], np.uint8, 16 * n, 16 * values.offset).reshape(n, 16)[:, ::-1]
    fill = np.where(big[:, 0] >= 128, 255, 0).astype(np.uint8)
    other = np.append(big != fill[:, None], np.ones((n, 1), bool), axis=1).argmax(axis=1)  # the first byte that isn't sign
    first = np.minimum(other, 15)
    lost = (big[np.arange(n), first] >= 128) != (fill == 255)  # a sign byte must stay before it
    first = np.where(lost, first - 1, first)
    return np.ascontiguousarray(big).reshape(-1), np.arange(n) * 16 + first, 16 - first


def hash_array(values: pa.Array) -> pa.Array:
    data, start, length = _unscaled(values) if pa.types.is_decimal(values.type) else _bytes_of(values)
    if not len(values):
        return pa.array([], pa.int32())
    gone = values.is_null().to_numpy(zero_copy_only=False)
    return pa.array(hash_spans(data, start, np.where(gone, 0, length)), pa.int32(), mask=gone)


@F.arrow_udf(T.IntegerType())
def _hash(values: pa.Array) -> pa.Array:
    return hash_array(values)


def murmur3(value: Column, kind: T.DataType) -> Column:
    """Null stays null. Whole numbers, dates and timestamps are hashed in the JVM; strings, binary and decimals (whose tail bytes
    Spark's hash takes differently) batch by batch on Arrow's buffers. Wall-clock times count as UTC."""
    if isinstance(kind, (T.StringType, T.BinaryType, T.DecimalType)):
        return _hash(value)
    if isinstance(kind, T.DateType):
        n = F.unix_date(value).cast("long")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        n = clock.micros(value, kind)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        n = value.cast("double")
    else:
        n = value.cast("long")
    return F.when(value.isNotNull(), F.hash(F.lit(_TO_SEED_0), n))
