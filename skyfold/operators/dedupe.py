"""Top-1 per key and duplicate finding.

``top1_per_key`` is ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY …) = 1``.
Spark plans it with a *partial* WindowGroupLimit before the shuffle: each
map task keeps only its best row per key, so a hot key (even a third of
all rows) arrives at the final window as one row per map task instead of
being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.operators.flatten import drop_variants


def top1_per_key(
    df: DataFrame,
    keys: Sequence[str],
    rank_by: Sequence[Column],
    total_order: bool = False,
) -> DataFrame:
    """Keep, per key, the row with the largest ``rank_by`` tuple.

    ``rank_by`` is compared left to right, larger wins (use ``c.isNotNull()``
    for "non-NULL first", a timestamp for "latest"); NULL ranks lowest. The
    caller gives a tie-breaking ``rank_by`` (D14, H8). ``total_order=True``
    adds a hash of the whole row as the last rank, so even full ties are
    decided the same way on every retry; it references every column, so
    Catalyst can no longer prune columns below the window: use it only
    where all columns are read anyway. VARIANT columns are dropped.
    """
    body = drop_variants(df)
    payload = [c for c in body.columns if c not in keys]
    order = [r.desc_nulls_last() for r in rank_by]
    if total_order:
        order.append(F.xxhash64(*payload).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    return body.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, *tie_breakers: Column, total_order: bool = False
) -> DataFrame:
    """Latest row per key by ``order_col``."""
    return top1_per_key(df, keys, [F.col(order_col), *tie_breakers], total_order=total_order)


def duplicate_groups(df: DataFrame, keys: Sequence[str | Column], count_name: str = "frequency", min_count: int = 2) -> DataFrame:
    """Groups with at least ``min_count`` rows (GROUP BY … HAVING, A17, F7)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) >= min_count)
