"""Table maintenance: merge (upsert), delete+insert, look-back, first build,
schema guard (S13-S18, F4, A12, J6, J7).

The state transitions are pure DataFrame functions. Persisting is a
separate step that writes a *new* location or overwrites only touched
partitions of a date-partitioned table, never the path the same plan reads
(H4).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class SchemaChangeError(ValueError):
    """Raised by the ``fail`` schema-change guard."""


def check_schema(new: DataFrame, target: DataFrame) -> None:
    """``on_schema_change='fail'``: names and types must match exactly."""
    a = [(f.name, f.dataType.simpleString()) for f in new.schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in target.schema.fields]
    if a != b:
        raise SchemaChangeError(f"schema changed: new={a} target={b}")


def high_water_mark(target: DataFrame, col: str) -> Column:
    """``(SELECT MAX(col) FROM target)`` as a scalar subquery (A12). NULL
    when the target is empty."""
    return target.select(F.max(col)).scalar()


def lookback_filter(df: DataFrame, col: str, target: DataFrame, days: int, target_col: str | None = None) -> DataFrame:
    """``col >= MAX(target.col) - INTERVAL days`` (F4), inclusive.

    The bound is a scalar subquery, so a date-partitioned source prunes
    partitions at run time. An empty target gives NULL → no rows; callers
    treat an empty target as a first build instead (D21).
    """
    hw = high_water_mark(target, target_col or col)
    return df.where(F.col(col) >= F.date_sub(hw, days))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """MERGE: matched keys update only ``update_cols`` (all non-key columns
    when None); unmatched source rows are inserted; other target rows are
    kept (S14). ``source`` must be unique on ``keys``.

    One full outer join on the keys with presence markers; a stored NULL in
    a column that is not updated stays NULL (no COALESCE). NULL keys never
    match (SQL MERGE semantics) and are inserted.
    """
    cols = target.columns
    upd = set(cols) - set(keys) if update_cols is None else set(update_cols)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.select(*cols).withColumn("_in_s", F.lit(True)).alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t = F.col("t._in_t").isNotNull()
    in_s = F.col("s._in_s").isNotNull()
    out = []
    for c in cols:
        tc, sc = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in upd:
            out.append(F.when(in_s, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
    return j.select(*out)


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DELETE target rows whose key tuple occurs in ``batch``, then INSERT
    the batch (S15, J7). Target rows with a NULL key never match and stay
    (H10), as in SQL."""
    batch_keys = batch.select(*keys).distinct()
    kept = target.join(batch_keys, list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def delete_insert_window(target: DataFrame, batch: DataFrame, key: str, lower_bound: Column) -> DataFrame:
    """Variant that replaces the whole look-back range ``key >= lower_bound``
    (D22 ``replace_window``), so a day that lost all its rows is emptied."""
    kept = target.where(~(F.col(key) >= lower_bound) | F.col(key).isNull())
    return kept.unionByName(batch.select(*target.columns))


def is_empty(df: DataFrame) -> bool:
    """True when ``df`` has no row (reads at most one row)."""
    return len(df.limit(1).take(1)) == 0


def table_exists(spark: SparkSession, path: str) -> bool:
    """False if nothing is stored at ``path``; other read failures are raised."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Write a table version (S13). ``path`` must not be read by ``df``.

    ``sort_by`` stores the table ordered (O1): range-partitioned on the sort
    keys (sampled boundaries, so a hot key does not land in one task more
    than its share) and sorted within each file, so readers get pruning
    min/max statistics and an ordered scan without a global sort at read.
    """
    if sort_by:
        df = df.repartitionByRange(files, *sort_by) if files else df.repartitionByRange(*sort_by)
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are
    replaced (S15 when key = partition column). Cut the lineage of ``df``
    from ``path`` first (checkpoint), or Spark refuses / loses data (H4)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def incremental_state(
    target: DataFrame | None,
    build: Callable[[DataFrame | None], DataFrame],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    full_refresh: bool = False,
) -> DataFrame:
    """First build vs incremental switch.

    ``build(target_or_None)`` gives the new rows (filtered by look-back when
    a target is given); ``combine(target, rows)`` gives the new state. An
    absent or empty target, or ``full_refresh``, is a first build.
    """
    if full_refresh or target is None or is_empty(target):
        return build(None)
    rows = build(target)
    check_schema(rows, target)
    return combine(target, rows)
