"""Scalar expression helpers: JSON paths, flags, buckets, safe percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(variant: str | Column, path: str, type_: str = "string") -> Column:
    """Typed path extraction from a VARIANT (X1, X2). JSON null, a missing
    path and a value that does not cast all give SQL NULL."""
    return F.try_variant_get(_c(variant), path, type_)


def json_object_or_null(variant: str | Column, path: str) -> Column:
    """Sub-object kept as VARIANT (P2); an explicit JSON null is folded to
    SQL NULL so that it means the same as an absent key (D16)."""
    v = F.try_variant_get(_c(variant), path, "variant")
    return F.when(F.is_variant_null(v), F.lit(None).cast("variant")).otherwise(v)


def three_valued_flag(ok: Column, observed: Column) -> Column:
    """TRUE when observed and ``ok``; FALSE when observed and not ``ok``
    (also when ``ok`` is NULL); NULL when nothing was observed (P10, D7)."""
    return F.when(observed.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(ok, F.lit(False)))


def bucketize(
    value: str | Column,
    bounds: Sequence[float],
    labels: Sequence[str],
    else_label: str,
    null_when: Column | None = None,
) -> Column:
    """Chained CASE: ``value <= bounds[i]`` → ``labels[i]``; otherwise
    ``else_label`` (NULL values fall to ``else_label`` like SQL CASE);
    ``null_when`` short-circuits to NULL (P11)."""
    v = _c(value)
    expr = None
    if null_when is not None:
        expr = F.when(null_when, F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels, strict=True):
        expr = F.when(v <= bound, label) if expr is None else expr.when(v <= bound, label)
    return expr.otherwise(else_label)


def status_in(status: str | Column, values: Sequence[str], lower: bool = True) -> Column:
    """Membership test that is FALSE (not NULL) for a NULL status."""
    s = F.lower(_c(status)) if lower else _c(status)
    return F.coalesce(s.isin(list(values)), F.lit(False))


def conditional_count(predicate: Column) -> Column:
    """COUNT_IF: rows where the predicate is TRUE; NULL is not counted (A2)."""
    return F.count_if(predicate)


def safe_pct(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """ROUND(n * 100 / NULLIF(d, 0), digits) for non-negative counts, done in
    integer arithmetic (half-up) so that no binary-float tie can differ
    between engines (A3, H6). Result is DOUBLE; NULL when d = 0 or NULL."""
    n = _c(numerator).cast("long")
    d = F.nullif(_c(denominator).cast("long"), F.lit(0))
    scale = 10**digits
    # round_half_up(100 * n / d, digits) == floor((200 * scale * n + d) / (2 * d)) / scale
    q = F.call_function("div", n * F.lit(200 * scale) + d, d * F.lit(2))
    return q.cast("double") / F.lit(float(scale))


def sentinel_to_null(c: str | Column, sentinels: Sequence[str]) -> Column:
    """Trimmed value, or NULL when it is empty or one of ``sentinels``."""
    t = F.trim(_c(c))
    return F.when(t.isin(list(sentinels)) | (t == ""), F.lit(None).cast("string")).otherwise(_c(c))
