"""Zone maps: the range of a column in every partition of a stored table.

A table partitioned by one date is often filtered on another one that moves
with it (the day a flight operated against the day it was scheduled). Its
directory names do not help there. A zone map keeps, for every partition, the
smallest and the largest value of that column; a reader asks it which
partitions can hold a row, and filters on the partition column by name, so
that Spark lists and reads only those. The rows that the partitions hold
besides are still filtered, so the result is the same without a map.

A map has one row for each partition (and writer), a few bytes each, and is
written with the partitions it describes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zone_map(df: DataFrame, partition_col: str, columns: Sequence[str]) -> DataFrame:
    """(partition_col, <c>_lo, <c>_hi) of every column: one partial
    aggregation that reads the named columns. NULLs do not count; a partition
    without any value has NULL bounds."""
    bounds = [f(c).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "lo"), (F.max, "hi"))]
    return df.groupBy(partition_col).agg(*bounds)


def replace_partitions(old: DataFrame, new: DataFrame, partition_col: str) -> DataFrame:
    """A table kept by partition (a map, partial counts) after the partitions
    that ``new`` describes were rewritten."""
    same = F.col(f"o.{partition_col}").eqNullSafe(F.col(f"n.{partition_col}"))
    gone = new.select(partition_col).distinct().alias("n")
    return old.alias("o").join(gone, same, "left_anti").unionByName(new)


def partitions_since(zones: DataFrame, partition_col: str, column: str, since: Column) -> list:
    """Names of the partitions that can hold ``column >= since``: at most one
    value for each partition of the table."""
    reach = zones.where(F.col(f"{column}_hi") >= since)
    return [r[0] for r in reach.select(partition_col).distinct().collect()]


def in_partitions(df: DataFrame, partition_col: str, names: Sequence) -> DataFrame:
    """Rows of the named partitions (None: the NULL partition)."""
    known = [n for n in names if n is not None]
    keep = F.col(partition_col).isin(known)
    if len(known) < len(names):
        keep = keep | F.col(partition_col).isNull()
    return df.where(keep)
