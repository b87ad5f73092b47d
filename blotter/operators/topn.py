"""Top-N per group and global top/bottom-k.

Both number rows in a window and keep ``rank <= n``, which the optimizer turns
into a partial ``WindowGroupLimit`` before the shuffle: each map task forwards
at most n rows per group (or per side of top/bottom-k), so neither a hot group
nor a table is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {
    "row_number": F.row_number,
    "rank": F.rank,
    "dense_rank": F.dense_rank,
}


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{c}`") if isinstance(c, str) else c for c in cols]


def top_n_per_group(
    df: DataFrame,
    group_by: Sequence[str | Column],
    order_by: Sequence[str | Column],
    n: int,
    rank: str = "row_number",
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order_by``.

    ``rank`` picks the numbering: ``row_number`` (exactly n rows; give a
    complete ``order_by`` so ties are broken deterministically), ``rank`` or
    ``dense_rank`` (tied rows share a number, so a group may keep more).
    The number is kept in ``rank_col``.
    """
    if rank not in _RANKERS:
        raise ValueError(f"rank must be one of {sorted(_RANKERS)}")
    window = Window.partitionBy(*_cols(group_by)).orderBy(*_cols(order_by))
    numbered = df.withColumn(rank_col, _RANKERS[rank]().over(window))
    return numbered.filter(F.col(f"`{rank_col}`") <= n)


def top_and_bottom_n(
    df: DataFrame,
    by: str,
    n: int,
    tie_break: Sequence[str] = (),
    distinct_rows: bool = False,
) -> DataFrame:
    """The ``n`` rows with the largest ``by`` UNION ALL the ``n`` with the smallest.

    Null values of ``by`` are ranked in neither list. Ties at the cut are
    broken by ``tie_break`` (ascending). With fewer than 2n rows a row can be
    in both lists and then appears twice, as UNION ALL does; pass
    ``distinct_rows=True`` to keep each row once.

    One pass over ``df``: every row is paired with both sides ("top",
    "bottom") and numbered within its side; the ``<= n`` filter becomes a
    partial ``WindowGroupLimit``, so each map task forwards at most n rows per
    side to the two-group shuffle.
    """
    key = F.col(f"`{by}`")
    side = F.col("_side")
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in tie_break]
    order = [
        F.when(side == "top", key).desc_nulls_last(),
        F.when(side == "bottom", key).asc_nulls_last(),
        *ties,
    ]
    paired = df.filter(key.isNotNull()).withColumn("_side", F.explode(F.array(F.lit("top"), F.lit("bottom"))))
    picked = top_n_per_group(paired, [side], order, n, rank="row_number", rank_col="_pick")
    out = picked.drop("_side", "_pick")
    return out.distinct() if distinct_rows else out
