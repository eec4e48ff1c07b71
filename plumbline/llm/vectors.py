"""Vectors of a column as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length: the rows of a list column that have it, and their vectors as float64. Left out are NULL and empty vectors
    and those with an entry that is NULL or not finite."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL becomes NaN
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(there, np.diff(offsets), 0)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        found = values[offsets[rows][:, None] + np.arange(length)]
        good = np.isfinite(found).all(axis=1)
        if good.any():
            yield rows[good], found[good]
