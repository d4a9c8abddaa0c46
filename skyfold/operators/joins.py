"""Join helpers: size-checked broadcast, dimension lookups, as-of lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a dimension of known size may have and still be broadcast to every task.
DEFAULT_BROADCAST_ROWS = 2_000_000


def checked_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only where ``known_rows`` proves the size (e.g. the
    days of a calendar span).

    Without that bound no hint is given: statistics and AQE choose a
    broadcast under ``spark.sql.autoBroadcastJoinThreshold`` (bytes, not
    rows), a shuffle join beyond it.
    """
    return F.broadcast(dim) if known_rows is not None and known_rows <= max_rows else dim


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, str],
) -> DataFrame:
    """LEFT equi-join adding ``columns`` (dim column → output name).

    The dimension must be unique on ``dim_key`` (one match at most), so the
    fact row count is unchanged.
    """
    d = dim.select(F.col(dim_key).alias("_lk"), *[F.col(src).alias(dst) for src, dst in columns.items()])
    joined = facts.join(d, facts[fact_key] == d["_lk"], "left")
    return joined.drop("_lk")


def asof_version_lookup(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_ts: str,
    columns: dict[str, str],
    valid_from: str = "dbt_valid_from",
    valid_to: str = "dbt_valid_to",
    bucket_days: int = 1,
) -> DataFrame:
    """LEFT join to the version valid at ``fact_ts`` (J11):
    ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``.

    Versions of one key do not overlap, so at most one matches. A key with
    many versions and many facts would pair each fact with all of them, so
    time is cut into buckets of days: a version stands in every bucket that
    it covers within the facts' own span, a fact joins by (key, bucket), and
    only versions of that bucket meet the interval test. Facts without a key
    or time keep NULLs.
    """

    def bucket(ts: Column) -> Column:
        return F.floor(F.unix_date(F.to_date(ts)) / bucket_days)

    first, last = (facts.select(f(fact_ts)).scalar() for f in (F.min, F.max))
    v = versions.select(
        F.col(dim_key).alias("_vk"),
        F.col(valid_from).alias("_vf"),
        F.col(valid_to).alias("_vt"),
        *[F.col(src).alias(dst) for src, dst in columns.items()],
        bucket(F.greatest(F.col(valid_from), first)).alias("_b0"),
        bucket(F.least(F.col(valid_to), last)).alias("_b1"),  # least() passes over NULL: an open version ends with the facts
    )
    v = v.where(F.col("_b0") <= F.col("_b1")).withColumn("_vb", F.explode(F.sequence("_b0", "_b1"))).drop("_b0", "_b1")
    f = facts.withColumn("_fb", bucket(F.col(fact_ts)))
    ts = F.col(fact_ts)
    inside = (ts >= F.col("_vf")) & (F.col("_vt").isNull() | (ts < F.col("_vt")))
    joined = f.join(v, (F.col(fact_key) == F.col("_vk")) & (F.col("_fb") == F.col("_vb")) & inside, "left")
    return joined.drop("_vk", "_vf", "_vt", "_vb", "_fb")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def canonical_airline_lookup(
    facts: DataFrame,
    reference: DataFrame,
    fact_key: str = "airline_iata",
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """LEFT join to the airline reference seed by IATA, active rows only.

    The reference can list several active airlines under one IATA code; the
    lowest ``airline_id`` is kept so the fact row count never changes.
    """
    from skyfold.operators.dedupe import top1_per_key

    cols = columns or {"airline_name": "ref_airline_name", "country": "ref_country"}
    active = reference.where((F.col("active") == "Y") & F.col("iata").isNotNull())
    one = top1_per_key(active.select("iata", "airline_id", *cols), ["iata"], [-F.col("airline_id")])
    return lookup(facts, one, fact_key, "iata", cols)
