"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The surrogate-key convention of the public dbt_utils package
# (NULL parts are replaced by this sentinel, parts are joined with '-', the
# result is hashed with MD5). Keys must equal the ones the reference emits.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the ordered column list; NULL parts become the sentinel."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
