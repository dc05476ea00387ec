"""Sums of vectors over all rows of a table, of which each task sends one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_sum(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``fn(batch)``, a vector of ``size`` doubles, over all batches.

    A task adds up its batches; the tasks' vectors are added by position, so what comes to the driver is one vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        some = False
        for b in batches:
            if len(b):
                total += fn(b)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "v"])

    out = np.zeros(size)
    for at, v in rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v")).collect():
        out[at] = v
    return out


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    """A column of packed 32-bit floats as a matrix of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), width).astype(np.float64)


def packed_rows(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as 32-bit floats, packed."""
    x = np.ascontiguousarray(x, np.float32)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * x.shape[1]), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())


def centre_and_scale(rows: DataFrame, column: str, width: int, least: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and standard deviation (and ``least`` more) of every feature over all rows, and how many these are."""

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = rows_of(b.column(0), width)
        return np.concatenate([x.sum(axis=0), (x**2).sum(axis=0), [len(x)]])

    s = vector_sum(rows.select(column), moments, 2 * width + 1)
    n = max(s[-1], 1)
    mean = s[:width] / n
    return steady(mean), steady(np.sqrt(np.maximum(s[width:-1] / n - mean**2, 0))) + least, int(s[-1])


def steady(x: np.ndarray, digits: int = 9) -> np.ndarray:
    """Without the last digits, which depend on the order in which sums were taken."""
    return np.round(x, digits)


def symmetric(upper: np.ndarray, width: int) -> np.ndarray:
    """A symmetric matrix from its upper triangle."""
    out = np.zeros((width, width))
    at = np.triu_indices(width)
    out[at] = upper
    return out + np.triu(out, 1).T


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
