"""Image pixels: channel choice and down-sampling, one NumPy call per Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def interpolation_matrix(source: int, target: int) -> np.ndarray:
    """target x source matrix that samples a line linearly, first and last points kept."""
    matrix = np.zeros((target, source))
    if source == 1:
        matrix[:, 0] = 1.0
        return matrix
    place = np.linspace(0.0, source - 1.0, target)
    left = np.minimum(place.astype(int), source - 2)
    weight = place - left
    rows = np.arange(target)
    matrix[rows, left] = 1.0 - weight
    matrix[rows, left + 1] = weight
    return matrix


def resample(images: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resampling of a stack of images (n, h, w) to (n, height, width)."""
    down = interpolation_matrix(images.shape[1], height)
    across = interpolation_matrix(images.shape[2], width)
    return down @ images @ across.T


def to_matrix(column: pa.Array) -> np.ndarray:
    """A list column as an n x d float matrix; nulls or unequal lengths are errors."""
    if column.null_count or column.flatten().null_count:
        raise ValueError("null feature vector or element")
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    lengths = pc.list_value_length(column)
    bounds = pc.min_max(lengths)
    if bounds["min"].as_py() != bounds["max"].as_py():
        raise ValueError("feature vectors differ in length")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(n, bounds["max"].as_py())


def to_list_array(matrix: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, d = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int64) * d, type=pa.int32())
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1), type=kind or pa.float64())
    return pa.ListArray.from_arrays(offsets, values)


def downsample(features: Column, source: tuple[int, int], target: tuple[int, int]) -> Column:
    """Row-major image vector of shape ``source`` to one of shape ``target``."""

    @F.arrow_udf("array<double>")
    def sample(column: pa.Array) -> pa.Array:
        stack = to_matrix(column)
        if stack.size == 0:
            return pa.array([], type=pa.list_(pa.float64()))
        small = resample(stack.reshape(-1, *source), *target)
        return to_list_array(small.reshape(len(stack), -1))

    return sample(features)


def select_channel(data: Column, channels: Column, layer: Column) -> Column:
    """Bytes of one interleaved channel: elements layer, layer + channels, ... of ``data``.

    Every whole pixel is kept; images of one batch may differ in size, those of one size are cut at once.
    """

    @F.arrow_udf("array<int>")
    def pick(raw: pa.Array, count: pa.Array, offset: pa.Array) -> pa.Array:
        sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
        counts, layers = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (count, offset))
        kinds, place = np.unique(np.column_stack((sizes, counts, layers)), axis=0, return_inverse=True)
        lengths = np.maximum(sizes // counts, 0) if len(sizes) else sizes
        ends = np.cumsum(lengths)
        values = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        for kind, (size, c, k) in enumerate(kinds.tolist()):
            rows, pixels = np.flatnonzero(place.reshape(-1) == kind), size // c
            whole = np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), size)
            reach = (ends[rows] - pixels)[:, None] + np.arange(pixels)
            values[reach] = whole[:, : pixels * c].reshape(len(rows), pixels, c)[:, :, k]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    return pick(data, channels.cast("int"), layer.cast("int"))
