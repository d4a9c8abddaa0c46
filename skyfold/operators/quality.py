"""Declarative data-quality checks.

A check returns the number of failing rows or groups (0 = pass). The checks
of one table are planned together:

* row-level checks (not_null, accepted_values, between, expression) are ONE
  aggregation of ``count_if`` columns;
* uniqueness checks are ONE aggregation over GROUPING SETS, one set for each
  key, so the table is read once for all of them;
* functional dependencies and validity checks keep a bounded state per group
  (smallest and largest value, two counts), so a hot group shrinks to one row
  in every task before the shuffle;
* cross-table checks compare distinct keys (anti join) or row counts.

Results are one row per check: ``(table_name, check_name, failing_rows)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.operators.joins import union_all

ROW_KINDS = ("not_null", "accepted_values", "between", "expression")
KEY_KINDS = ("unique", "unique_combination")
GROUP_KINDS = ("functional_dependency", "one_open_version")
TABLE_KINDS = ("referenced_in", "fewer_rows")


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    row_condition: str | None = None
    expression: str | None = None
    label: str | None = None
    table: str | None = None  # the other table of a cross-table check
    table_columns: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.label or f"{self.kind}__{'__'.join(self.columns)}"


def not_null(*cols: str) -> list[Check]:
    return [Check("not_null", (c,)) for c in cols]


def unique(col: str) -> Check:
    return Check("unique", (col,))


def accepted_values(col: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", (col,), tuple(values))


def between(col: str, lo: float, hi: float, row_condition: str | None = None) -> Check:
    return Check("between", (col,), min_value=lo, max_value=hi, row_condition=row_condition)


def unique_combination(*cols: str) -> Check:
    return Check("unique_combination", tuple(cols))


def expression_holds(label: str, expression: str, row_condition: str | None = None) -> Check:
    """Rows where the SQL ``expression`` is FALSE fail (T9-style row rules)."""
    return Check("expression", (), expression=expression, row_condition=row_condition, label=label)


def functional_dependency(determinant: Sequence[str], dependent: str, row_condition: str | None = None) -> Check:
    """Rows equal in ``determinant`` are equal in ``dependent`` (T7); NULL is
    a value of its own on both sides. Groups with more values fail."""
    return Check("functional_dependency", (*determinant, dependent), row_condition=row_condition)


def one_open_version(key: str, valid_to: str = "dbt_valid_to") -> Check:
    """Every key has exactly one version without an end (T8). Keys with none
    or several fail."""
    return Check("one_open_version", (key, valid_to))


def referenced_in(columns: Sequence[str], table: str, table_columns: Sequence[str] | None = None, row_condition: str | None = None) -> Check:
    """Every distinct key of the rows that meet ``row_condition`` occurs in
    ``table`` (T10); keys with a NULL part are not tested. Missing keys fail."""
    other = tuple(table_columns or columns)
    return Check("referenced_in", tuple(columns), row_condition=row_condition, table=table, table_columns=other,
                 label=f"referenced_in__{'__'.join(columns)}__{table}")


def fewer_rows(table: str) -> Check:
    """The table has fewer rows than ``table`` (T6). Rows too many fail."""
    return Check("fewer_rows", (), table=table, label=f"fewer_rows__{table}")


def failing_predicate(check: Check) -> Column:
    """Predicate that is TRUE exactly for the failing rows of a row check."""
    c = F.col(check.columns[0]) if check.columns else None
    if check.kind == "not_null":
        bad = c.isNull()
    elif check.kind == "accepted_values":
        bad = c.isNotNull() & ~c.isin(list(check.values))  # NULL passes
    elif check.kind == "between":
        bad = ~((c >= F.lit(check.min_value)) & (c <= F.lit(check.max_value)))
    elif check.kind == "expression":
        bad = ~F.expr(check.expression)
    else:
        raise ValueError(f"not a row check: {check.kind}")
    if check.row_condition:
        bad = F.expr(check.row_condition) & bad
    return bad


def _row_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame | None:
    if not checks:
        return None
    counts = df.agg(*[F.count_if(failing_predicate(ch)).alias(f"c{i}") for i, ch in enumerate(checks)])
    rows = F.array(
        *[F.struct(F.lit(ch.name).alias("check_name"), F.col(f"c{i}").alias("failing_rows")) for i, ch in enumerate(checks)]
    )
    return counts.select(F.inline(rows)).select(F.lit(table).alias("table_name"), "check_name", "failing_rows")


def _result(df: DataFrame, table: str, check: Check, failing: Column) -> DataFrame:
    return df.agg(failing.cast("long").alias("failing_rows")).select(
        F.lit(table).alias("table_name"), F.lit(check.name).alias("check_name"), "failing_rows"
    )


def _key_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame | None:
    """All uniqueness checks of a table in one aggregation.

    ``grouping_id`` tells the key sets apart: of the columns in order, it has
    a bit for each one that is *not* in the set. A NULL key of a ``unique``
    check is not tested; a NULL part of a combination is a value."""
    if not checks:
        return None
    columns = sorted({c for ch in checks for c in ch.columns})
    sets = sorted({tuple(sorted(ch.columns)) for ch in checks})
    grouped = df.select(*columns).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
    groups = grouped.agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))

    def doubles(check: Check) -> Column:
        outside = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in check.columns)
        bad = (F.col("_set") == outside) & (F.col("_n") > 1)
        return bad & F.col(check.columns[0]).isNotNull() if check.kind == "unique" else bad

    counts = groups.agg(*[F.count_if(doubles(ch)).alias(f"c{i}") for i, ch in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(ch.name).alias("check_name"), F.col(f"c{i}").alias("failing_rows")) for i, ch in enumerate(checks)])
    return counts.select(F.inline(rows)).select(F.lit(table).alias("table_name"), "check_name", "failing_rows")


def _group_check(df: DataFrame, table: str, check: Check) -> DataFrame:
    src = df.where(F.expr(check.row_condition)) if check.row_condition else df
    if check.kind == "functional_dependency":
        *determinant, dependent = check.columns
        groups = src.groupBy(*determinant).agg(
            F.min(dependent).alias("_lo"), F.max(dependent).alias("_hi"), F.count(dependent).alias("_known"), F.count(F.lit(1)).alias("_n")
        )
        mixed = (F.col("_known") > 0) & (F.col("_known") < F.col("_n"))
        return _result(groups, table, check, F.count_if((F.col("_lo") != F.col("_hi")) | mixed))
    key, valid_to = check.columns
    groups = src.groupBy(key).agg(F.count_if(F.col(valid_to).isNull()).alias("_open"))
    return _result(groups, table, check, F.count_if(F.col("_open") != 1))


def _table_check(df: DataFrame, table: str, check: Check, other: DataFrame) -> DataFrame:
    if check.kind == "fewer_rows":
        most = other.select(F.count(F.lit(1))).scalar()
        return _result(df, table, check, F.greatest(F.count(F.lit(1)) - F.first(most) + 1, F.lit(0)))
    src = df.where(F.expr(check.row_condition)) if check.row_condition else df
    keys = src.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(check.columns)]).na.drop().distinct()
    there = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(check.table_columns)]).na.drop().distinct()
    return _result(keys.join(there, keys.columns, "left_anti"), table, check, F.count(F.lit(1)))


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """All checks of one table → (table_name, check_name, failing_rows).
    ``frames``: the other tables, for cross-table checks."""
    parts = [_row_checks(df, table, [c for c in checks if c.kind in ROW_KINDS]), _key_checks(df, table, [c for c in checks if c.kind in KEY_KINDS])]
    parts += [_group_check(df, table, c) for c in checks if c.kind in GROUP_KINDS]
    parts += [_table_check(df, table, c, frames[c.table]) for c in checks if c.kind in TABLE_KINDS]
    return union_all([p for p in parts if p is not None])


def unexpected_values(df: DataFrame, col: str, accepted: Sequence[str]) -> DataFrame:
    """Distinct values outside ``accepted`` with their counts."""
    c = F.col(col)
    return df.where(c.isNotNull() & ~c.isin(list(accepted))).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def freshness(df: DataFrame, ts_col: str, as_of: str, max_age_hours: float) -> DataFrame:
    """Latest ``ts_col`` against ``as_of`` (T13): one row with the age in
    hours and a ``stale`` flag (an empty table is stale)."""
    latest = df.agg(F.max(ts_col).alias("latest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / 3.6e9
    return latest.select(
        "latest",
        age.alias("age_hours"),
        (F.col("latest").isNull() | (age > max_age_hours)).alias("stale"),
    )


@dataclass
class Suite:
    """Named tables and their checks."""

    tables: dict[str, list[Check]] = field(default_factory=dict)

    def run(self, frames: dict[str, DataFrame]) -> DataFrame:
        return union_all([run_checks(frames[t], t, checks, frames) for t, checks in self.tables.items()])
