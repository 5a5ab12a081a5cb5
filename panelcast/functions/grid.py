"""Threshold grid: the points ``lo, lo+step, ... <= hi`` as exact doubles.

The k-th point is ``lo + k * ((lo + step) - lo)``, which is how an
``arange`` over doubles fills its buffer; using ``lo + k * step`` would give
different last bits for most points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    lo: float = 0.30
    hi: float = 0.70
    step: float = 0.01

    def __post_init__(self) -> None:
        if not (0.0 < self.lo < self.hi < 1.0):
            raise ValueError("threshold range must satisfy 0 < lo < hi < 1")
        if self.step <= 0.0:
            raise ValueError("threshold step must be positive")

    @property
    def size(self) -> int:
        return int(math.ceil(((self.hi + 1e-9) - self.lo) / self.step))

    @property
    def delta(self) -> float:
        return (self.lo + self.step) - self.lo

    def point(self, k: Column) -> Column:
        """Unrounded grid point for an integer column ``k``."""
        return F.lit(self.lo) + k.cast("double") * F.lit(self.delta)

    def count_at_or_below(self, p: Column) -> Column:
        """Number of grid points ``<= p`` (so ``p >= point(k)`` exactly when ``k < result``).

        A floor estimate, corrected by one step in either direction by comparing
        with the exact grid doubles, so grid-edge scores land on the right side.
        """
        n = self.size
        est = F.floor((p - F.lit(self.lo)) / F.lit(self.delta))
        k0 = F.least(F.greatest(est, F.lit(-1)), F.lit(n - 1)).cast("int")
        k1 = (
            F.when((k0 + 1 <= n - 1) & (self.point(k0 + 1) <= p), k0 + 1)
            .when((k0 >= 0) & (self.point(k0) > p), k0 - 1)
            .otherwise(k0)
        )
        return k1 + 1
