"""Synthetic vectors, one per row of a table.

Every value is a hash of (row key, position, seed), so a retried task or a second
run draws the same vectors, and generation needs no state and no shuffle. Keys are
hashed by Spark; the draws of a whole batch are then made at once in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectable.functions.half import BYTES, FLOATS, list_column, to_bf16_bits

SPARSE = T.MapType(T.LongType(), T.FloatType(), valueContainsNull=False)

# Shape of a synthetic sparse vector.
SPARSE_MIN_DRAWS = 10
SPARSE_DRAW_SPREAD = 10
SPARSE_KEY_LIMIT = 1_000_000

# The published constants of the splitmix64 generator.
_GAMMA = 0x9E3779B97F4A7C15
_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(state: np.ndarray) -> np.ndarray:
    """splitmix64's output function."""
    state = (state ^ (state >> np.uint64(30))) * np.uint64(_MULTIPLIERS[0])
    state = (state ^ (state >> np.uint64(27))) * np.uint64(_MULTIPLIERS[1])
    return state ^ (state >> np.uint64(31))


def _draws(keys: np.ndarray, positions: np.ndarray, seed: int) -> np.ndarray:
    """64 random bits for each key and position; the two broadcast against each other."""
    start = _mixed(keys.astype(np.int64).view(np.uint64) + np.uint64((seed * _GAMMA) % 2**64))
    return _mixed(start + (positions.astype(np.uint64) + np.uint64(1)) * np.uint64(_GAMMA))


def _unit_floats(draws: np.ndarray) -> np.ndarray:
    """Top 24 bits as floats in [0, 1): every such value is exact."""
    return (draws >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)


def _grid(keys: pa.Array, width: int, seed: int) -> np.ndarray:
    return _draws(keys.to_numpy(zero_copy_only=False)[:, None], np.arange(width), seed)


def _require_dim(dim: int, step: int = 1) -> None:
    if dim <= 0 or dim % step:
        raise ValueError(f"dim must be a positive multiple of {step}: {dim}")


def _rows(values: np.ndarray) -> pa.Array:
    return list_column(np.full(len(values), values.shape[1]), values.reshape(-1))


def random_float_vector(key: Column, dim: int, seed: int = 0) -> Column:
    """``array<float>`` of ``dim`` uniform values in [0, 1)."""
    _require_dim(dim)

    @F.arrow_udf(FLOATS)
    def drawn(keys: pa.Array) -> pa.Array:
        return _rows(_unit_floats(_grid(keys, dim, seed)))

    return drawn(F.xxhash64(key))


def constant_float_vector(value: float, dim: int) -> Column:
    """``array<float>`` of ``dim`` equal values."""
    _require_dim(dim)
    return F.array_repeat(F.lit(value).cast("float"), dim)


def random_binary_vector(key: Column, dim: int, seed: int = 0) -> Column:
    """``array<tinyint>`` of ``dim / 8`` bytes, each of all 256 values."""
    _require_dim(dim, 8)

    @F.arrow_udf(BYTES)
    def drawn(keys: pa.Array) -> pa.Array:
        return _rows((_grid(keys, dim // 8, seed) >> np.uint64(56)).astype(np.uint8).view(np.int8))

    return drawn(F.xxhash64(key))


def random_half_vector(key: Column, dim: int, bf16: bool, seed: int = 0) -> Column:
    """``array<tinyint>``: a random float vector encoded as fp16 or bf16."""
    _require_dim(dim)

    @F.arrow_udf(BYTES)
    def drawn(keys: pa.Array) -> pa.Array:
        floats = _unit_floats(_grid(keys, dim, seed))
        return _rows((to_bf16_bits(floats).astype("<u2") if bf16 else floats.astype("<f2")).view(np.int8))

    return drawn(F.xxhash64(key))


def random_sparse_vector(key: Column, seed: int = 0) -> Column:
    """``map<bigint,float>`` from 10 to 19 draws of keys below a million, in key order.

    A key drawn twice counts once, so a vector may have fewer entries than draws.
    """

    @F.arrow_udf(SPARSE)
    def drawn(keys: pa.Array) -> pa.Array:
        most = SPARSE_MIN_DRAWS + SPARSE_DRAW_SPREAD - 1
        grid = _grid(keys, most + 1, seed)
        counts = SPARSE_MIN_DRAWS + grid[:, 0] % np.uint64(SPARSE_DRAW_SPREAD)
        dims = (grid[:, 1:] % np.uint64(SPARSE_KEY_LIMIT)).astype(np.int64)
        # Draws past the count sort behind every real key and drop out below.
        dims[np.arange(most) >= counts[:, None]] = SPARSE_KEY_LIMIT
        dims.sort(axis=1)
        kept = dims < SPARSE_KEY_LIMIT
        kept[:, 1:] &= dims[:, 1:] != dims[:, :-1]
        owners = np.repeat(keys.to_numpy(zero_copy_only=False), kept.sum(axis=1))
        weights = _unit_floats(_draws(owners, dims[kept], seed + 1))
        offsets = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)
        return pa.MapArray.from_arrays(pa.array(offsets), pa.array(dims[kept]), pa.array(weights))

    return drawn(F.xxhash64(key))
