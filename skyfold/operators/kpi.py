"""KPI roll-ups: conditional counts and safe percentages.

Every roll-up is one ``groupBy().agg()``: Spark computes the partial
aggregate map-side, so a hot day or airline never lands whole in one task.
Predicates are built on the input columns before any output alias (H7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions.exprs import conditional_count, safe_pct
from skyfold.operators.enrich import CANCELLED_STATUSES
from skyfold.operators.joins import lookup

KPI_COLUMNS = [
    "total_scheduled",
    "total_actual",
    "scheduled_dep",
    "scheduled_arr",
    "actual_dep",
    "actual_arr",
    "on_time_dep",
    "on_time_arr",
    "cancelled_count",
    "dep_otp_pct",
    "arr_otp_pct",
    "cancellation_rate_pct",
]

TILE_COLUMNS = ["total_scheduled", "total_actual", "dep_otp_pct", "arr_otp_pct", "cancellation_rate_pct"]


def kpi_counts() -> dict[str, Column]:
    """The daily counts as aggregate expressions (A2-A5), and the completed
    flights that the percentages are shares of.

    ``total_actual`` uses a case-sensitive NOT IN, so a NULL status counts as
    scheduled but not actual (D8, D9), exactly like the reference SQL.
    """
    dep = F.col("direction") == "DEPARTURE"
    arr = F.col("direction") == "ARRIVAL"
    not_cancelled = ~F.col("flight_status").isin(*CANCELLED_STATUSES)
    return {
        "total_scheduled": F.count(F.lit(1)),
        "total_actual": conditional_count(not_cancelled),
        "scheduled_dep": conditional_count(dep),
        "scheduled_arr": conditional_count(arr),
        "actual_dep": conditional_count(dep & not_cancelled),
        "actual_arr": conditional_count(arr & not_cancelled),
        "on_time_dep": conditional_count(dep & (F.col("is_on_time_dep") == True)),  # noqa: E712
        "on_time_arr": conditional_count(arr & (F.col("is_on_time_arr") == True)),  # noqa: E712
        "cancelled_count": conditional_count(F.col("is_cancelled") == True),  # noqa: E712
        "completed_dep": conditional_count(dep & F.col("actual_dep").isNotNull()),
        "completed_arr": conditional_count(arr & F.col("actual_arr").isNotNull()),
    }


def with_percentages(counts: dict[str, Column]) -> dict[str, Column]:
    """Counts and the percentages made of them."""
    return counts | {
        "dep_otp_pct": safe_pct(counts["on_time_dep"], counts["completed_dep"]),
        "arr_otp_pct": safe_pct(counts["on_time_arr"], counts["completed_arr"]),
        "cancellation_rate_pct": safe_pct(counts["cancelled_count"], counts["total_scheduled"]),
    }


def kpi_aggregates(columns: Sequence[str] = KPI_COLUMNS) -> list[Column]:
    """The daily flight KPIs as aggregate expressions."""
    exprs = with_percentages(kpi_counts())
    return [exprs[c].alias(c) for c in columns]


def partial_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive state of the KPIs: counts without percentages, by keys finer
    than a mart's."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in kpi_counts().items()])


def roll_up(partial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A mart from partial counts: the same rows and types as
    ``flight_kpis`` of the flights themselves."""
    sums = {name: F.sum(name) for name in kpi_counts()}
    exprs = with_percentages(sums)
    return partial.groupBy(*keys).agg(*[exprs[c].alias(c) for c in KPI_COLUMNS])


def flight_kpis(df: DataFrame, keys: Sequence[str], not_null_keys: bool = False) -> DataFrame:
    """KPI roll-up by ``keys`` (A7-A10). ``not_null_keys`` drops rows with a
    NULL key first (A8, A10: NULL dates / airlines are excluded)."""
    src = df
    if not_null_keys:
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    return src.groupBy(*keys).agg(*kpi_aggregates())


def kpi_tiles(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Whole-period KPI tiles (A18, Q1); per key when ``keys`` given (Q6)."""
    if keys:
        return df.groupBy(*keys).agg(*kpi_aggregates(TILE_COLUMNS))
    return df.agg(*kpi_aggregates(TILE_COLUMNS))


def gate_observations(enriched: DataFrame) -> DataFrame:
    """Departure and arrival gate uses of operating rows in one scan."""
    ops = enriched.where(F.col("carrier_role") == "operating")
    use = F.explode(
        F.array(
            F.struct(F.col("gate_dep").alias("gate"), F.lit("departure").alias("operation_type")),
            F.struct(F.col("gate_arr").alias("gate"), F.lit("arrival").alias("operation_type")),
        )
    ).alias("_g")
    return (
        ops.select(
            F.col("operating_airline_iata").alias("airline_iata"),
            F.col("dim_airline_name").alias("airline_name"),
            use,
        )
        .select("_g.gate", "airline_iata", "airline_name", "_g.operation_type")
        .where(F.col("gate").isNotNull())
    )


def gate_usage_summary(enriched: DataFrame) -> DataFrame:
    """Gate × airline affinity (A11): departures, arrivals, total."""
    obs = gate_observations(enriched)
    return obs.groupBy("gate", "airline_iata", "airline_name").agg(
        conditional_count(F.col("operation_type") == "departure").alias("departure_count"),
        conditional_count(F.col("operation_type") == "arrival").alias("arrival_count"),
        F.count(F.lit(1)).alias("total_flight_count"),
    )


def gate_share(fact: DataFrame, capacity: DataFrame, date_col: str = "flight_date") -> DataFrame:
    """Distinct gates used per day against the gate capacity seed.

    The seed's ``gate_count`` enters as a scalar subquery (no join, no
    driver round trip); the distinct count is planned as a partial
    aggregate on (day, gate) first, so a hot day is pre-reduced map-side.
    """
    pair = F.explode(F.array(F.col("gate_dep"), F.col("gate_arr"))).alias("gate")
    gates = fact.select(date_col, pair).where(F.col("gate").isNotNull())
    used = gates.groupBy(date_col).agg(F.count_distinct("gate").alias("gates_used"))
    gate_count = capacity.select(F.max(F.col("gate_count").cast("long"))).scalar()
    return used.select(
        date_col,
        "gates_used",
        gate_count.alias("gate_count"),
        safe_pct(F.col("gates_used"), gate_count).alias("pct_gates_used"),
    )


# -- distinct gates over any period ---------------------------------------------
# A distinct count cannot be added up over days. A bitmap of the gates used in
# a day can: bitmaps are combined with OR, and the bits are counted last. Gates
# get numbers from a dictionary that only grows.


def extend_dictionary(known: DataFrame | None, values: DataFrame, col: str) -> DataFrame:
    """(col, number): numbers of all values, without gaps from 1; those of
    ``known`` stay. One row for each distinct value passes one task, which
    numbers the new ones."""
    new = values.select(col).where(F.col(col).isNotNull()).distinct()
    last = F.lit(0)
    if known is not None:
        new = new.join(known.select(col), col, "left_anti")
        last = F.coalesce(known.select(F.max("number")).scalar(), F.lit(0))
    numbered = new.select(col, (F.row_number().over(Window.orderBy(col)) + last).cast("long").alias("number"))
    return numbered if known is None else known.unionByName(numbered)


def used_gates(fact: DataFrame, date_col: str = "flight_date") -> DataFrame:
    pair = F.explode(F.array(F.col("gate_dep"), F.col("gate_arr"))).alias("gate")
    return fact.select(date_col, pair).where(F.col("gate").isNotNull())


def gate_days(fact: DataFrame, dictionary: DataFrame, date_col: str = "flight_date") -> DataFrame:
    """(day, bucket, gates): the gates used on a day as bitmaps, one for each
    32,768 gate numbers; built by partial aggregation."""
    numbers = lookup(used_gates(fact, date_col), dictionary, "gate", "gate", {"number": "number"})
    bucket, bit = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return numbers.select(date_col, bucket.alias("bucket"), bit.alias("_bit")).groupBy(date_col, "bucket").agg(F.bitmap_construct_agg("_bit").alias("gates"))


def merge_gate_days(one: DataFrame, other: DataFrame, date_col: str = "flight_date") -> DataFrame:
    """State of two sets of flights; a gate in both counts once."""
    return one.unionByName(other).groupBy(date_col, "bucket").agg(F.bitmap_or_agg("gates").alias("gates"))


def gate_share_by(days: DataFrame, period: Column, capacity: DataFrame) -> DataFrame:
    """Distinct gates used in a period (a column of the day) against the gate
    capacity, from the daily bitmaps alone (A13)."""
    merged = days.groupBy(period, "bucket").agg(F.bitmap_or_agg("gates").alias("gates"))
    name = merged.columns[0]
    used = merged.groupBy(name).agg(F.sum(F.bitmap_count("gates")).alias("gates_used"))
    gate_count = capacity.select(F.max(F.col("gate_count").cast("long"))).scalar()
    return used.select(name, "gates_used", gate_count.alias("gate_count"), safe_pct(F.col("gates_used"), gate_count).alias("pct_gates_used"))


def top_gates(gate_usage: DataFrame, n: int = 5) -> DataFrame:
    """Top-``n`` gates by flights (O3, Q5); ties ordered by gate."""
    totals = gate_usage.groupBy("gate").agg(F.sum("total_flight_count").alias("total_flights"))
    return totals.orderBy(F.desc("total_flights"), F.asc("gate")).limit(n)


def gate_heatmap(gate_usage: DataFrame, airlines: Sequence[str] | None = None) -> DataFrame:
    """Gate × airline matrix of flight counts (Q7).

    Long form, one row per cell, so the schema does not depend on the data;
    with ``airlines`` one column for each of them."""
    src = gate_usage.where(F.col("airline_iata").isNotNull())
    if airlines is not None:
        return src.groupBy("gate").pivot("airline_iata", list(airlines)).agg(F.sum("total_flight_count"))
    return src.groupBy("gate", "airline_iata").agg(F.sum("total_flight_count").alias("flights"))
