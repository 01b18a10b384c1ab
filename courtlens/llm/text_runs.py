"""Runs of bytes inside texts, as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def find_runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the maximal runs of marked bytes that stay inside one text."""
    opens, closes = mask.copy(), mask.copy()
    if len(mask):
        opens[1:] &= ~mask[:-1]
        closes[:-1] &= ~mask[1:]
        nonempty = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][nonempty], offsets[1:][nonempty] - 1
        opens[heads], closes[tails] = mask[heads], mask[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of runs in ascending order that do not overlap, as strings."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    edges = np.zeros(len(data) + 1, np.int8)
    # A run may end where the next text begins with one, so both are added.
    edges[starts] += 1
    edges[ends] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    return pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[inside])
    )
