"""Dimensions: date dimension, "best known row" airline / airport dims,
SCD2 snapshots (X16, W2, W3, U2, A14, S16, J8, F10)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.functions.dates import date_attributes
from skyfold.functions.keys import surrogate_key
from skyfold.operators.dedupe import top1_per_key

# Reference span of the date dimension: half-open [start, end).
DATE_DIM_START = "2024-01-01"
DATE_DIM_END = "2030-12-31"

SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _days(start: str, end: str) -> int:
    return (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in ``[start, end)`` as ``date_day``.

    Generated by ``spark.range`` so the rows are spread over partitions;
    the row count is known from the arguments.
    """
    n = max(_days(start, end), 0)
    return spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))


def date_dimension_of(spine: DataFrame) -> DataFrame:
    """Calendar attributes for every ``date_day`` of a spine."""
    attrs = date_attributes("date_day")
    return spine.select(F.col("date_day").alias("date_id"), "date_day", *[c.alias(n) for n, c in attrs.items()])


def date_dimension(spark: SparkSession, start: str = DATE_DIM_START, end: str = DATE_DIM_END) -> DataFrame:
    return date_dimension_of(date_spine(spark, start, end))


def date_dimension_rows(start: str = DATE_DIM_START, end: str = DATE_DIM_END) -> int:
    return max(_days(start, end), 0)


def date_spine_covering(df: DataFrame, *date_cols: str) -> DataFrame:
    """Spine over the days spanned by ``date_cols`` of ``df`` (inclusive).

    The bounds come from one aggregate; the spine has one row per calendar
    day of the span, which does not grow with the row count.
    """
    mins, maxs = [F.min(c) for c in date_cols], [F.max(c) for c in date_cols]
    lo = mins[0] if len(mins) == 1 else F.least(*mins)
    hi = maxs[0] if len(maxs) == 1 else F.greatest(*maxs)
    bounds = df.agg(lo.alias("lo"), hi.alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))


# Best-row rankings (D13): non-NULL first, then the latest extract, then the values.
def airline_rank() -> list[Column]:
    return [
        F.col("airline_name").isNotNull(),
        F.col("airline_icao").isNotNull(),
        F.col("extracted_at"),
        F.col("airline_name"),
        F.col("airline_icao"),
    ]


def airport_rank() -> list[Column]:
    return [F.col("airport_name").isNotNull(), F.col("extracted_at"), F.col("airport_name")]


def airline_best_rows(stg: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per airline IATA: non-NULL name first, then non-NULL ICAO, then
    the latest extract, then name and ICAO (W2 + D13)."""
    src = stg.where(F.col("airline_iata").isNotNull())
    if as_of is not None:
        src = src.where(F.col("extracted_at") <= F.lit(as_of).cast("timestamp_ntz"))
    src = src.select("airline_iata", "airline_name", "airline_icao", "extracted_at")
    best = top1_per_key(src, ["airline_iata"], airline_rank())
    return best.select("airline_iata", "airline_name", "airline_icao")


def airport_observations(stg: DataFrame) -> DataFrame:
    """Departure and arrival airports of every row in one scan (U2):
    ``explode(array(dep, arr))`` instead of two scans and a UNION."""
    pair = F.explode(
        F.array(
            F.struct(F.col("dep_iata").alias("airport_iata"), F.col("dep_airport_name").alias("airport_name")),
            F.struct(F.col("arr_iata").alias("airport_iata"), F.col("arr_airport_name").alias("airport_name")),
        )
    ).alias("_a")
    return (
        stg.select("extracted_at", pair)
        .select("_a.airport_iata", "_a.airport_name", "extracted_at")
        .where(F.col("airport_iata").isNotNull())
    )


def airport_best_rows(stg: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per airport IATA: non-NULL name first, latest extract, name (W3 + D13)."""
    src = stg
    if as_of is not None:
        src = src.where(F.col("extracted_at") <= F.lit(as_of).cast("timestamp_ntz"))
    obs = airport_observations(src)
    best = top1_per_key(obs, ["airport_iata"], airport_rank())
    return best.select("airport_iata", "airport_name")


def _changed(check_cols: Sequence[str]) -> Column:
    diff = [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check_cols]
    out = diff[0]
    for d in diff[1:]:
        out = out | d
    return out


def scd2_snapshot(
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """SCD2 snapshot with the *check* strategy.

    ``source`` has one row per ``key``. New key → new open version; a check
    column changed (NULL-safe compare) → the open version is closed at
    ``as_of`` and a new one opened; unchanged → kept; key absent from the
    source → kept open. A run dated before an open version began (late
    data) switches just after that beginning, so no interval is inverted.
    ``dbt_scd_id`` hashes key and ``valid_from`` (D19).
    One full outer join on the key; closed history passes through.
    """
    ts = F.lit(as_of).cast("timestamp_ntz")
    attrs = [c for c in source.columns if c != key]

    def _new_version(df: DataFrame, since: Column = ts) -> DataFrame:
        return df.select(
            key,
            *attrs,
            surrogate_key(F.col(key), since).alias("dbt_scd_id"),
            since.alias("dbt_updated_at"),
            since.alias("dbt_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
        )

    if existing is None:
        return _new_version(source)

    out_cols = [key, *attrs, *SCD_COLUMNS]
    history = existing.where(F.col("dbt_valid_to").isNotNull()).select(*out_cols)
    current = existing.where(F.col("dbt_valid_to").isNull()).select(*out_cols)
    t = current.alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_t = F.col(f"t.{key}").isNotNull()
    in_s = F.col("s._in_s").isNotNull()
    changed = in_t & in_s & _changed(check_cols)
    switch = F.greatest(ts, F.col("t.dbt_valid_from") + F.expr("INTERVAL 1 MICROSECOND"))  # ts for a new key

    kept_or_closed = j.where(in_t).select(
        *[F.col(f"t.{c}").alias(c) for c in [key, *attrs, "dbt_scd_id", "dbt_updated_at", "dbt_valid_from"]],
        F.when(changed, switch).otherwise(F.col("t.dbt_valid_to")).alias("dbt_valid_to"),
    )
    opened = _new_version(
        j.where((~in_t) | changed).select(*[F.col(f"s.{c}").alias(c) for c in [key, *attrs]], switch.alias("_since")),
        F.col("_since"),
    )
    return history.unionByName(kept_or_closed).unionByName(opened).select(*out_cols)


def day_end(ts: str) -> Column:
    """The first midnight at or after a time: daily runs."""
    return F.timestamp_add("DAY", F.lit(1), F.date_trunc("day", F.col(ts) - F.expr("INTERVAL 1 MICROSECOND"))).cast("timestamp_ntz")


def first_run(ts: str, runs: Sequence[str]) -> Column:
    """The first of the given run times that sees a record; NULL after the last."""
    times = F.array(*[F.lit(r).cast("timestamp_ntz") for r in sorted(runs)])
    return F.get(F.filter(times, lambda r: r >= F.col(ts)), 0)


def airline_step_rank() -> list[Column]:
    """``airline_rank`` as named parts."""
    return [c.alias(n) for n, c in zip(("named", "coded", "seen", "airline_name", "airline_icao"), airline_rank(), strict=True)]


def airport_step_rank() -> list[Column]:
    return [c.alias(n) for n, c in zip(("named", "seen", "airport_name"), airport_rank(), strict=True)]


def _steps(best: DataFrame, key: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy("run")
    running = best.groupBy(key, "run").agg(F.max("best").alias("best")).withColumn("best", F.max("best").over(order))
    risen = running.withColumn("_before", F.lag("best").over(order))
    return risen.where(~F.col("best").eqNullSafe(F.col("_before"))).drop("_before")


def snapshot_steps(observations: DataFrame, key: str, rank: Sequence[Column], run: Column) -> DataFrame:
    """(key, run, best): the best row known at each run at which it changed.

    ``rank``: named columns, compared in order, the largest wins; they hold
    the attributes. ``run``: the first run that sees a record (rows without
    one, and rows without a key, are seen by none). A hot key is reduced to
    one row for each run in every task."""
    seen = observations.withColumn("run", run).where(F.col(key).isNotNull() & F.col("run").isNotNull())
    return _steps(seen.select(key, "run", F.struct(*rank).alias("best")), key)


def merge_steps(steps: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Steps of two sets of records, in any order of arrival: a late record
    splits the interval it falls into, or changes nothing where something
    better was known. A row below the running maximum can never become a step
    later, so the steps alone are enough."""
    return _steps(steps.unionByName(more), key)


def scd2_history(steps: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """SCD2 versions that repeated snapshots (``scd2_snapshot`` at every run)
    would have made: islands of runs with equal check columns (NULL-safe)."""
    order = Window.partitionBy(key).orderBy("run")
    attrs = steps.select(key, "run", *[F.col(f"best.{c}").alias(c) for c in check_cols])
    changed = F.lag("run").over(order).isNull()
    for c in check_cols:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(order))
    islands = attrs.withColumn("_first", changed).where("_first")
    return islands.select(
        key, *check_cols, surrogate_key(F.col(key), F.col("run")).alias("dbt_scd_id"),
        F.col("run").alias("dbt_updated_at"), F.col("run").alias("dbt_valid_from"), F.lead("run").over(order).alias("dbt_valid_to"),
    )


def current_versions(snapshot: DataFrame) -> DataFrame:
    """Open versions only (F10): filter the dimension before joining it."""
    return snapshot.where(F.col("dbt_valid_to").isNull())
