"""Which vectors take part in comparisons, and their bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """An Arrow list column whose lists have one length, in double precision."""
    chunks = column.chunks if hasattr(column, "chunks") else [column]
    flat = [np.asarray(c.flatten().to_numpy(zero_copy_only=False), np.float64) for c in chunks]
    rows = sum(len(c) for c in chunks)
    return np.concatenate(flat).reshape(rows, -1) if rows else np.zeros((0, 0))
