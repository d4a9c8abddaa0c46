"""Comparison of two versions of a table.

Whole tables are compared by *order-free digests*: for every partition the
number of rows and sums and xors of the rows' hashes, one partial aggregation
over each version, nothing shuffled but one row for each partition and task.
Only partitions whose digests differ are compared row by row.

NULLs are values, rows may repeat (versions are compared as multisets).
Columns must be the same in both versions; VARIANT columns are left out.
Digests of equal rows agree in any order; different partitions agree with a
probability of about 2**-128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.operators.flatten import drop_variants
from skyfold.operators.zones import in_partitions
from skyfold.session import cut_lineage

#: Partitions that are named one by one in a filter; with more, a semi join picks them.
NAMED_PARTITIONS = 10_000


def row_hash(columns: Sequence[str], salt: int = 0) -> Column:
    """64-bit hash of a row. Spark's hash passes over NULLs, so their places
    are hashed as well."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(salt), nulls, *[F.col(c) for c in columns])


def partition_digests(df: DataFrame, partition_by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(partition, row_count, digest) with an order-free digest of the rows."""
    columns = list(columns or drop_variants(df).columns)
    hashed = df.select(*partition_by, row_hash(columns).alias("_h"), row_hash(columns, 1).alias("_g"))
    low = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))
    digest = F.struct(  # the sums of halves stay far from overflow
        F.bit_xor("_h").alias("x"), F.bit_xor("_g").alias("y"), F.sum(low).alias("lo"), F.sum(F.shiftrightunsigned("_h", 32)).alias("hi")
    )
    return hashed.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"), digest.alias("digest"))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def changed_partitions(before: DataFrame, after: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """(partition, rows_before, rows_after) of the partitions that differ."""
    b, a = (partition_digests(v, partition_by).alias(n) for v, n in ((before, "b"), (after, "a")))
    joined = b.join(a, _same("b", "a", partition_by), "full_outer")
    rows = [F.coalesce(F.col(f"{v}.row_count"), F.lit(0)).alias(f"rows_{n}") for v, n in (("b", "before"), ("a", "after"))]
    keys = [F.when(F.col("b.row_count").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in partition_by]
    return joined.where(~F.col("b.digest").eqNullSafe(F.col("a.digest"))).select(*keys, *rows)


def _restricted(df: DataFrame, changed: DataFrame, partition_by: Sequence[str], few: list | None) -> DataFrame:
    if few is not None:
        return in_partitions(df, partition_by[0], few)
    return df.alias("t").join(changed.alias("c"), _same("t", "c", partition_by), "left_semi")


def diff_tables(before: DataFrame, after: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """One row for each key whose rows differ: keys, ``change`` (added,
    removed or changed), rows_before, rows_after, and ``changed_columns``
    (names joined by commas, in the table's order; NULL unless one row
    replaced one other).

    ``partition_by`` only says how the tables are compared: a key may move
    from one partition to another."""
    before, after = drop_variants(before), drop_variants(after)
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {columns} and {after.columns}")
    after = after.select(*columns)
    changed = cut_lineage(changed_partitions(before, after, partition_by), "changed_partitions")
    few = None
    if len(partition_by) == 1 and changed.count() <= NAMED_PARTITIONS:
        few = [r[0] for r in changed.select(*partition_by).collect()]

    rest = [c for c in columns if c not in keys]
    sides = [
        _restricted(v, changed, partition_by, few).select(*keys, row_hash(columns).alias("_h"), row_hash(columns, 1).alias("_g"),
                                                          F.struct(*rest).alias("_row"), F.lit(n).alias("_n"))
        for v, n in ((before, -1), (after, 1))
    ]
    left_over = sides[0].unionByName(sides[1]).groupBy(*keys, "_h", "_g").agg(F.sum("_n").alias("_n"), F.any_value("_row").alias("_row"))
    left_over = left_over.where(F.col("_n") != 0)
    old, new = F.col("_n") < 0, F.col("_n") > 0
    by_key = left_over.groupBy(*keys).agg(
        F.sum(F.when(old, -F.col("_n")).otherwise(0)).alias("rows_before"),
        F.sum(F.when(new, F.col("_n")).otherwise(0)).alias("rows_after"),
        F.any_value(F.when(old, F.col("_row")), True).alias("_old"),
        F.any_value(F.when(new, F.col("_row")), True).alias("_new"),
    )
    names = F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in rest])
    replaced = (F.col("rows_before") == 1) & (F.col("rows_after") == 1)
    change = F.when(F.col("rows_before") == 0, "added").when(F.col("rows_after") == 0, "removed").otherwise("changed")
    return by_key.select(*keys, change.alias("change"), "rows_before", "rows_after", F.when(replaced, F.array_join(F.array_compact(names), ",")).alias("changed_columns"))
