"""Enrichment: dimension lookups and per-flight derived measures.

Star join of flights with small dimensions: each dimension is filtered to
its current version (F10) before the LEFT join and broadcast behind a size
check, so the flight rows are never shuffled for enrichment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.exprs import bucketize, status_in, three_valued_flag
from skyfold.operators.joins import lookup

# Fixed values of the flight model.
ON_TIME_MINUTES = 15
CANCELLED_STATUSES = ("cancelled", "canceled")
DELAY_BOUNDS = (15, 30, 60)
DELAY_LABELS = ("On Time", "15-30 min", "30-60 min")
DELAY_ELSE = "60+ min"

DATE_ATTRS = {"year": "year", "month": "month", "day_name": "day_name", "is_weekend": "is_weekend"}

ENRICHED_EXTRA = [
    "dim_airline_name",
    "dim_airline_icao",
    "dim_dep_airport_name",
    "dim_arr_airport_name",
    "sched_year",
    "sched_month",
    "sched_day_name",
    "sched_is_weekend",
    "actual_operation_date",
    "is_on_time_dep",
    "is_on_time_arr",
    "delay_bucket_dep",
    "delay_bucket_arr",
    "is_cancelled",
    "actual_year",
    "actual_month",
    "actual_day_name",
    "actual_is_weekend",
]


def flight_measures(df: DataFrame) -> DataFrame:
    """Per-row derived columns (P10-P13); needs actual_*/delay_*/flight_status."""
    return df.withColumns(
        {
            # COALESCE of the two local dates
            "actual_operation_date": F.coalesce(F.to_date("actual_dep"), F.to_date("actual_arr")),
            "is_on_time_dep": three_valued_flag(F.col("delay_dep") <= ON_TIME_MINUTES, F.col("actual_dep")),
            "is_on_time_arr": three_valued_flag(F.col("delay_arr") <= ON_TIME_MINUTES, F.col("actual_arr")),
            "delay_bucket_dep": bucketize(
                "delay_dep", DELAY_BOUNDS, DELAY_LABELS, DELAY_ELSE, null_when=F.col("actual_dep").isNull()
            ),
            "delay_bucket_arr": bucketize(
                "delay_arr", DELAY_BOUNDS, DELAY_LABELS, DELAY_ELSE, null_when=F.col("actual_arr").isNull()
            ),
            "is_cancelled": status_in("flight_status", CANCELLED_STATUSES),
        }
    )


def enrich_flights(
    stg: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Staging rows → enriched rows (``int_flights_enriched``).

    ``airlines`` (airline_iata, airline_name, airline_icao) and ``airports``
    (airport_iata, airport_name) are current versions, unique on the key;
    ``dates`` is the date dimension. Pass them already wrapped by
    ``checked_broadcast`` to keep the join map-side.
    """
    df = lookup(stg, airlines, "airline_iata", "airline_iata",
                {"airline_name": "dim_airline_name", "airline_icao": "dim_airline_icao"})
    df = lookup(df, airports, "dep_iata", "airport_iata", {"airport_name": "dim_dep_airport_name"})
    df = lookup(df, airports, "arr_iata", "airport_iata", {"airport_name": "dim_arr_airport_name"})
    df = lookup(df, dates, "flight_date", "date_id", {k: f"sched_{v}" for k, v in DATE_ATTRS.items()})
    df = flight_measures(df)
    # second stage: the computed date is the join key
    df = lookup(df, dates, "actual_operation_date", "date_id", {k: f"actual_{v}" for k, v in DATE_ATTRS.items()})
    return df.select(*stg.columns, *ENRICHED_EXTRA)
