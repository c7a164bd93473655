"""Keys along a Hilbert curve: points that are near each other in space get near keys."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_BITS = 60


def hilbert_keys(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid cells, given by one array of numbers below 2^bits for each axis.

    Skilling's method (2004), for all cells at once: undo the curve's rotations from the coarsest
    level to the finest, then turn the Gray code that is left into a number.
    """
    x = [np.asarray(c).astype(np.int64) for c in cells]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for k in range(len(x)):
            set_here = (x[k] & bit) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[k]) & below)
            x[k] = x[k] ^ swap
            x[0] = np.where(set_here, x[0] ^ below, x[0] ^ swap if k else x[0])
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ flips) >> level) & 1
    return key


def hilbert_key(points: DataFrame, columns: Sequence[str]) -> Column:
    """Key of each row over numeric columns, each cut into equal cells between its least and largest value.

    Reads the columns once for these two. Nulls and NaN count as the least value.
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("a curve takes one to four columns")
    bits = KEY_BITS // max(2, len(columns))
    number = {c: F.col(f"`{c}`").cast("double") for c in columns}
    ends = points.select(
        *[f(F.when(~F.isnan(n), n)).alias(f"{m}{k}") for k, n in enumerate(number.values()) for m, f in (("a", F.min), ("b", F.max))]
    ).first()
    cells = []
    for k, n in enumerate(number.values()):
        low, high = ends[f"a{k}"] or 0.0, ends[f"b{k}"] or 0.0
        step = (high - low) / ((1 << bits) - 1) or 1.0
        place = F.when(n.isNull() | F.isnan(n), F.lit(0.0)).otherwise((n - F.lit(low)) / F.lit(step))
        cells.append(F.least(F.greatest(place, F.lit(0.0)), F.lit(float((1 << bits) - 1))).cast("long"))

    def keys(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_keys([a.to_numpy() for a in axes], bits))

    return F.pandas_udf(keys, "long")(*cells)
