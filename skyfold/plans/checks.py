"""The flight model's data tests as a declarative suite (§2.11): the column
tests of the schema files and the design's cross-table checks (T6-T10).

Status lists follow the staging contract everywhere (D17); the operations
OTP percentages are nullable (D18); snapshot ids are unique per version
(D19).
"""

from __future__ import annotations

from skyfold.operators.quality import (
    Suite,
    accepted_values,
    between,
    expression_holds,
    fewer_rows,
    functional_dependency,
    not_null,
    one_open_version,
    referenced_in,
    unique,
    unique_combination,
)

# Accepted values of the reference's tests.
DIRECTIONS = ["DEPARTURE", "ARRIVAL"]
STATUSES = ["scheduled", "active", "landed", "actual", "cancelled", "canceled", "incident", "diverted", ""]
ACTIVE_FLAGS = ["Y", "N"]
CARRIER_ROLES = ["operating", "marketing"]
DELAY_BUCKETS = ["On Time", "15-30 min", "30-60 min", "60+ min"]
DELAY_RANGE = (-60, 1440)
PCT_RANGE = (0, 100)

COUNTS = ["total_scheduled", "total_actual", "scheduled_dep", "scheduled_arr", "actual_dep", "actual_arr",
          "on_time_dep", "on_time_arr", "cancelled_count"]


def _pct_checks():
    """OTP percentages may be NULL (no completed flight that day, D18)."""
    out = not_null("cancellation_rate_pct")
    out += [between(c, *PCT_RANGE) for c in ("dep_otp_pct", "arr_otp_pct", "cancellation_rate_pct")]
    return out


def _planned_not_below_actual():
    """Cancellations explain the gap between the two counts of a day."""
    return expression_holds("scheduled_dep_not_below_actual_dep", "scheduled_dep >= actual_dep")


def flight_suite() -> Suite:
    s = Suite()
    s.tables["stg_flights"] = [
        *not_null("flight_id", "flight_date", "direction", "dep_iata", "carrier_role", "sched_dep", "sched_arr",
                  "extracted_at", "target_airport"),
        accepted_values("direction", DIRECTIONS),
        accepted_values("flight_status", STATUSES),
        accepted_values("carrier_role", CARRIER_ROLES),
        functional_dependency(("flight_date", "operating_flight_iata", "direction"), "flight_id"),
        referenced_in(("airline_iata",), "daily_airline_summary", row_condition="carrier_role = 'marketing'"),
    ]
    s.tables["dim_dates"] = [
        unique("date_id"),
        *not_null("date_id", "date_day", "year", "month", "day", "quarter", "day_of_week", "day_of_year",
                  "week_of_year", "month_name", "day_name", "is_weekend", "year_month"),
    ]
    s.tables["int_flights_enriched"] = [
        *not_null("flight_id", "flight_date", "direction", "dep_iata", "carrier_role", "sched_dep", "sched_arr",
                  "extracted_at", "target_airport", "sched_year", "sched_month", "sched_day_name",
                  "sched_is_weekend", "is_cancelled"),
        accepted_values("direction", DIRECTIONS),
        accepted_values("flight_status", STATUSES),
        accepted_values("carrier_role", CARRIER_ROLES),
        accepted_values("delay_bucket_dep", DELAY_BUCKETS),
        accepted_values("delay_bucket_arr", DELAY_BUCKETS),
    ]
    s.tables["fct_flights"] = [
        unique("flight_id"),
        *not_null("flight_id", "flight_date", "direction", "dep_iata", "sched_dep", "sched_arr", "extracted_at",
                  "target_airport", "sched_year", "sched_month", "sched_day_name", "sched_is_weekend", "is_cancelled"),
        accepted_values("direction", DIRECTIONS),
        accepted_values("flight_status", STATUSES),
        between("delay_dep", *DELAY_RANGE, row_condition="delay_dep IS NOT NULL"),
        between("delay_arr", *DELAY_RANGE, row_condition="delay_arr IS NOT NULL"),
        accepted_values("delay_bucket_dep", DELAY_BUCKETS),
        accepted_values("delay_bucket_arr", DELAY_BUCKETS),
        fewer_rows("stg_flights"),
    ]
    s.tables["gate_usage_summary"] = not_null("gate", "airline_iata", "departure_count", "arrival_count",
                                              "total_flight_count")
    s.tables["daily_airport_summary"] = [unique("flight_date"), *not_null("flight_date", *COUNTS), *_pct_checks(),
                                         _planned_not_below_actual()]
    s.tables["daily_airport_operations"] = [
        unique("actual_operation_date"), *not_null("actual_operation_date", *COUNTS), *_pct_checks(),
        _planned_not_below_actual(),
    ]
    s.tables["daily_airline_summary"] = [
        unique_combination("flight_date", "airline_iata"),
        *not_null("flight_date", "airline_iata", *COUNTS),
        *_pct_checks(),
    ]
    s.tables["daily_airline_operations"] = [
        unique_combination("actual_operation_date", "airline_iata"),
        *not_null("actual_operation_date", "airline_iata", *COUNTS),
        *_pct_checks(),
    ]
    s.tables["dim_airlines"] = [*not_null("airline_iata", "dbt_valid_from", "dbt_scd_id"), unique("dbt_scd_id"),
                                one_open_version("airline_iata")]
    s.tables["dim_airports"] = [*not_null("airport_iata", "dbt_valid_from", "dbt_scd_id"), unique("dbt_scd_id"),
                                one_open_version("airport_iata")]
    s.tables["gate_capacity"] = not_null("gate_count", "runway_count", "operating_hours_start", "operating_hours_end")
    s.tables["airline_reference"] = [unique("airline_id"), *not_null("airline_id", "airline_name"),
                                     accepted_values("active", ACTIVE_FLAGS)]
    return s
