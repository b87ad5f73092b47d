"""Equi-joins on numbers that are nearly equal.

Two rows meet if each of their keys differs by no more than a tolerance. The
numbers are cut into cells as wide as the tolerance; a row of the right side is
also put in the neighbouring cells (three in each dimension), the sides are joined
on the cell, and the difference decides. Multiplicity is that of an inner join:
every pair within the tolerance, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.typed import ref


def join_near(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Inner join of all pairs whose ``keys`` differ by at most ``tolerance``
    each. The left side's keys are kept. A null or NaN key meets nothing. The
    right side, which is written out to its neighbouring cells, should be the
    smaller one; a cell that holds many rows is split by the skew join."""
    if not tolerance > 0:
        raise ValueError("the tolerance must be positive")
    cell = lambda c: F.floor(c / F.lit(float(tolerance)))
    real = lambda c: c.isNotNull() & ~F.isnan(c)
    for k in keys:
        left, right = left.filter(real(ref(k))), right.filter(real(ref(k)))
    own = left.withColumns({f"_cell{i}": cell(ref(k)) for i, k in enumerate(keys)})
    spread = right.select(*[ref(c).alias(f"_near_{c}" if c in keys else c) for c in right.columns])
    for i, k in enumerate(keys):
        at = cell(ref(f"_near_{k}"))
        spread = spread.withColumn(f"_cell{i}", F.explode(F.array(at - 1, at, at + 1)))
    near = [F.abs(ref(k) - ref(f"_near_{k}")) <= F.lit(float(tolerance)) for k in keys]
    met = own.join(spread, [f"_cell{i}" for i in range(len(keys))])
    for test in near:
        met = met.filter(test)
    return met.drop(*[f"_cell{i}" for i in range(len(keys))], *[f"_near_{k}" for k in keys])
